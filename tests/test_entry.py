import duckdb

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def test_contract(spark):
    qs, osql = E.queries(), E.oracle_sql()
    assert set(osql) <= set(qs)
    assert len(qs) >= 60
    df = E.entry(spark)
    assert df.columns == ["title", "upc", "product_url", "category", "pct", "price_old",
                          "price_new", "change"]
    assert df.count() > 0


def test_oracles_small(spark):
    """Every query with an oracle agrees with DuckDB at sf0.001 (row count and values)."""
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in ("part", "lineitem", "pages", "documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    qs, osql = E.queries(), E.oracle_sql()
    bad = []
    for name, sql in osql.items():
        sdf = qs[name](spark, SF)
        cols = sorted(sdf.columns)
        srows = sorted(repr(tuple(_n(r[c]) for c in cols)) for r in sdf.collect())
        cur = con.execute(sql)
        dcols = [d[0] for d in cur.description]
        idx = [dcols.index(c) for c in cols] if sorted(dcols) == cols else None
        if idx is None:
            bad.append((name, "columns", cols, sorted(dcols)))
            continue
        drows = sorted(repr(tuple(_n(r[i]) for i in idx)) for r in cur.fetchall())
        if srows != drows:
            bad.append((name, len(srows), len(drows)))
    assert bad == []


def _n(v):
    if isinstance(v, float):
        return round(v, 9)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v
