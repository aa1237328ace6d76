"""DuckDB SQL of the queries that SQL can express, written independently of the operators."""

from __future__ import annotations

from . import divergence, fim, quoting
from .quality import COMMON_WORDS

_WS = r"[\x20\x09-\x0D]+"

NEAR_DUPLICATES = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '{_WS}'), lambda x: x <> '') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS sh FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1
), both_have AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2
), link AS (
  SELECT a, b FROM both_have JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, min(reach.b) AS component_id, w.doc_id = min(reach.b) AS kept
FROM w JOIN reach ON reach.a = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id GROUP BY w.doc_id, n.n
"""

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), cell AS (SELECT vec_id, unnest(q) AS x, generate_subscripts(q, 1) AS d FROM v
), score AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(sum(a.x * b.x) AS BIGINT) AS score
  FROM cell a JOIN cell b ON a.d = b.d AND a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0 GROUP BY 1, 2
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM score
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


def _quality() -> str:
    words = "UNION ALL ".join(f"SELECT '{lang}' AS lang, {k} AS rank, unnest({ws!r}) AS word, unnest(range({len(ws)})) AS bin "
                              for k, (lang, ws) in enumerate(COMMON_WORDS.items()))
    return rf"""
WITH common AS ({words}),
t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, list_filter(string_split_regex(text, '{_WS}'), lambda x: x <> '') AS ws FROM t),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 7], chr(31)) AS g
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w)),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1),
repeats AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY 1),
base AS (
  SELECT w.doc_id, text, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
      - len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS n_dup_lines,
    coalesce(repeats.n, 0) AS n_repeat_words
  FROM w LEFT JOIN repeats ON repeats.doc_id = w.doc_id),
left_over AS (SELECT doc_id, text, n_words, [length(regexp_replace(text, p, '', 'g')) FOR p IN
  ['[a-z]', '[\x20\x09-\x0D]', '[^\x00-\x7F]', '[A-Z]', '[0-9]', '[#*$%&|<>]']] AS l FROM base),
class AS (SELECT doc_id, bin, n FROM (SELECT doc_id, unnest(range(7)) AS bin,
  unnest(list_append([length(text) - x FOR x IN l], length(text) - list_sum([length(text) - x FOR x IN l]))) AS n FROM left_over)),
bare AS (SELECT doc_id, unnest(string_split_regex(lower(regexp_replace(text, '[^\p{{L}}\x20\x09-\x0D]+', '', 'g')), '{_WS}')) AS word
         FROM t),
seen AS (SELECT b.doc_id, c.lang, c.rank, c.bin, count(*) AS n FROM bare b JOIN common c ON b.word = c.word GROUP BY ALL),
hist AS (
  SELECT d.doc_id, c.lang, c.rank, c.bin, coalesce(s.n, 0) AS n FROM (SELECT DISTINCT doc_id FROM t) d
  JOIN common c ON true LEFT JOIN seen s ON s.doc_id = d.doc_id AND s.lang = c.lang AND s.bin = c.bin),
own AS (SELECT doc_id, lang, rank, sum(n) AS n FROM hist GROUP BY ALL),
full_hist AS (SELECT doc_id, lang, bin, n FROM hist UNION ALL
  SELECT own.doc_id, lang, 99, greatest(n_words - n, 0) FROM own JOIN base ON base.doc_id = own.doc_id),
lang AS (SELECT own.doc_id, first(lang ORDER BY n DESC, rank) AS lang FROM own JOIN base ON base.doc_id = own.doc_id
         WHERE n_words >= 64 GROUP BY own.doc_id HAVING max(n) > 0),
rc AS (SELECT lang, bin, sum(n) AS n, sum(sum(n)) OVER (PARTITION BY lang) AS total FROM class JOIN lang USING (doc_id) GROUP BY lang, bin),
rw0 AS (SELECT h.lang, h.bin, sum(h.n) AS n FROM full_hist h JOIN lang ON lang.doc_id = h.doc_id AND lang.lang = h.lang
        GROUP BY h.lang, h.bin),
rw AS (SELECT *, sum(n) OVER (PARTITION BY lang) AS total FROM rw0),
pairs AS (
  SELECT 'c' AS kind, doc_id, rc.lang, class.n / greatest(sum(class.n) OVER (PARTITION BY doc_id, rc.lang), 1) AS p,
         rc.n / rc.total AS q FROM class JOIN rc USING (bin)
  UNION ALL
  SELECT 'w', doc_id, rw.lang, h.n / greatest(sum(h.n) OVER (PARTITION BY doc_id, rw.lang), 1), rw.n / rw.total
  FROM full_hist h JOIN rw ON rw.lang = h.lang AND rw.bin = h.bin),
far AS (SELECT kind, doc_id, lang, sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
          + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2, 0)) AS d FROM pairs GROUP BY ALL),
near AS (SELECT doc_id, min(d) FILTER (kind = 'c') AS c, min(d) FILTER (kind = 'w') AS w FROM far GROUP BY 1)
SELECT base.doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
    AND NOT (n_words >= 64 AND (coalesce(near.c, 0) > 0.3 OR coalesce(near.w, 0) > 0.3)) AS kept
FROM base LEFT JOIN near ON near.doc_id = base.doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_hyperminhash": NEAR_DUPLICATES, "op5_topk_bound": TOP_K,
            "op7_quote_linking": quoting.ORACLE_SQL, "op8_quality_rules": _quality(),
            "op12_fill_in_middle": fim.ORACLE_SQL, "op13_source_divergence": divergence.ORACLE_SQL}
