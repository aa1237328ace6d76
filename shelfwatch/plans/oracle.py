"""DuckDB oracle SQL for the registered queries.

Written independently of the Spark code, straight from the binding rule in
``shelfwatch.sources.binding``. Rounded values are computed in exact integer or decimal
arithmetic, because DuckDB rounds doubles differently from Spark (e.g. 1.005).
"""

from __future__ import annotations

NUMERIC_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

RATING_INT = (
    "CAST(COALESCE("
    "CASE {r} WHEN 'One' THEN 1 WHEN 'Two' THEN 2 WHEN 'Three' THEN 3 "
    "WHEN 'Four' THEN 4 WHEN 'Five' THEN 5 END, "
    f"CASE WHEN regexp_matches({{r}}, '{NUMERIC_TEXT}') "
    "THEN trunc(TRY_CAST(trim({r}) AS DOUBLE)) END, 0) AS INTEGER)"
)


def rating_int(expr: str) -> str:
    return RATING_INT.replace("{r}", expr)


# Exact half-up average of a DECIMAL(10,2) column, returned as DOUBLE.
def avg2(col: str) -> str:
    cents = f"CAST({col} * 100 AS BIGINT)"
    return (f"CAST((2 * SUM({cents}) + COUNT({col})) // (2 * COUNT({col})) AS DOUBLE) / 100")


BASE = """
WITH raw_log AS (
  SELECT p.p_name AS title,
         CAST(CAST(floor(p.p_retailprice * (1 - l.l_discount) * 100) AS DECIMAL(12,0)) / 100
              AS DECIMAL(10,2)) AS price,
         CASE l.l_linenumber WHEN 1 THEN 'One' WHEN 2 THEN 'Two' WHEN 3 THEN 'Three'
              WHEN 4 THEN 'Four' WHEN 5 THEN 'Five' WHEN 6 THEN '4' ELSE 'N/A' END AS rating,
         'https://shop.example.com/p/' || CAST(p.p_partkey AS VARCHAR) AS product_url,
         CAST(date_trunc('quarter', l.l_shipdate) AS DATE) AS date_collected,
         CAST(p.p_partkey AS VARCHAR) AS upc,
         p.p_brand AS category,
         CAST(l.l_quantity AS INTEGER) - 1 AS stock_quantity,
         l.l_shipdate, l.l_orderkey, l.l_linenumber, l.l_suppkey, l.l_extendedprice,
         l.l_quantity
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
),
history AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY title, product_url, date_collected
      ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_suppkey DESC,
               l_extendedprice DESC, l_quantity DESC) AS rn
    FROM raw_log) t
  WHERE rn = 1
),
catalog AS (
  SELECT CAST(p_partkey AS VARCHAR) AS upc, p_name AS title, p_brand AS category,
         'https://shop.example.com/p/' || CAST(p_partkey AS VARCHAR) AS product_url
  FROM part
),
fact AS (
  SELECT upc, price, rating, stock_quantity, date_collected,
         l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_extendedprice, l_quantity
  FROM history
),
books AS (
  SELECT c.title, f.price, f.rating, c.product_url, f.date_collected, c.upc, c.category,
         f.stock_quantity,
         f.l_shipdate, f.l_orderkey, f.l_linenumber, f.l_suppkey, f.l_extendedprice,
         f.l_quantity
  FROM fact f JOIN catalog c ON f.upc = c.upc
),
snapshot AS (
  SELECT * FROM books WHERE date_collected = (SELECT max(date_collected) FROM fact)
),
dates AS (
  SELECT max(date_collected) AS latest_date,
         (SELECT max(date_collected) FROM fact
           WHERE date_collected < (SELECT max(date_collected) FROM fact)) AS previous_date
  FROM fact
)
"""


def q(body: str) -> str:
    return BASE + body


def more(ctes: str, body: str) -> str:
    """BASE plus further CTEs (``ctes`` starts with the CTE name, no leading comma)."""
    return BASE + ", " + ctes + "\n" + body


def pct_half_even(new: str, old: str) -> str:
    """Percent change of two DECIMAL(10,2) prices, half-even to 2 places, in integers."""
    num = f"(CAST(({new} - {old}) * 100 AS BIGINT) * 10000)"
    den = f"CAST({old} * 100 AS BIGINT)"
    qa = f"(abs({num}) // abs({den}))"
    r = f"(abs({num}) % abs({den}))"
    rounded = (f"({qa} + CASE WHEN 2 * {r} > abs({den}) OR (2 * {r} = abs({den}) "
               f"AND {qa} % 2 = 1) THEN 1 ELSE 0 END)")
    return (f"CASE WHEN {den} = 0 THEN NULL ELSE "
            f"CAST(sign({num}) * sign({den}) * {rounded} AS DOUBLE) / 100 END")


CHANGES = """
prev AS (SELECT * FROM books WHERE date_collected = (SELECT previous_date FROM dates)),
latest AS (SELECT * FROM books WHERE date_collected = (SELECT latest_date FROM dates)),
ch_upc AS (
  SELECT o.title, o.upc, o.product_url, o.category, o.price AS price_old,
         n.price AS price_new, n.price - o.price AS change
  FROM prev o JOIN latest n
    ON o.title IS NOT DISTINCT FROM n.title AND o.upc IS NOT DISTINCT FROM n.upc
),
ch_url AS (
  SELECT o.title, o.product_url, o.price AS price_old, n.price AS price_new,
         n.price - o.price AS change
  FROM prev o JOIN latest n
    ON o.title IS NOT DISTINCT FROM n.title
   AND o.product_url IS NOT DISTINCT FROM n.product_url
)
"""


def changes(body: str) -> str:
    return more(CHANGES, body)


def change_cols(prefix: str = "") -> str:
    return (f"CAST({prefix}price_old AS DOUBLE) AS price_old, "
            f"CAST({prefix}price_new AS DOUBLE) AS price_new, "
            f"CAST({prefix}change AS DOUBLE) AS change, "
            f"{pct_half_even(prefix + 'price_new', prefix + 'price_old')} AS pct")
