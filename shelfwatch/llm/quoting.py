"""Quotation linking: conversations in reply order, without the quotes.

Everything is built from DataFrame functions. A line's quote level is the number of ``>``
that lead it (blanks between them allowed). A passage is a run of non-blank lines of one
level; white space is collapsed and letters are lower-cased before it is hashed (128 bits).
The original of a quoted passage is the first message of the conversation that holds it as
its own (level 0) passage, if that stands before the quoting message. A message replies to
the original of its shallowest quotes; among several to the one that most characters are
quoted from, then to the latest. Own passages are reduced to their first message before the
join, so a quote meets one row however often a passage recurs.

Ancestors are found by pointer jumping, in rounds that follow the logarithm of the longest
chain of replies. ``root_turn``, ``depth``, ``turn`` put every message after the one it
replies to.

Defined results: null text counts as empty; rows with a null conversation or turn reply to
nothing and are their own root; repeated rows of one (conversation, turn) count as one
message and get the same links; an empty table gives an empty result; other columns are
carried along, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

_LEAD = r"^[ \t]*(?:>[ \t]*)+"
_BLANK_LINES = r"\n(?:[ \t]*\n)+"


def _level(line: Column) -> Column:
    lead = F.regexp_extract(line, _LEAD, 0)
    return F.length(lead) - F.length(F.replace(lead, F.lit(">"), F.lit("")))


def _lines(text: Column) -> Column:
    return F.transform(F.split(text, r"\r?\n"), lambda x: F.struct(
        _level(x).alias("level"), F.regexp_replace(x, _LEAD, "").alias("body")))


def passages(messages: DataFrame) -> DataFrame:
    """(conv, turn, level, h1, h2, chars): one row for each passage of ``messages`` (conv, turn, text)."""
    df = messages.withColumn("lines", _lines(F.col("text"))).drop("text")
    df = df.select("*", F.explode(F.array_distinct(F.col("lines.level"))).alias("level"))
    # the lines of one level; any other line ends the passage as a blank one does
    own = F.array_join(F.zip_with("lines", F.array_repeat("level", F.size("lines")), lambda x, level: (
        F.when(x["level"] == level, x["body"]).otherwise(F.lit("")))), "\n")
    df = df.withColumn("own", own).drop("lines")
    df = df.select("conv", "turn", "level", F.explode(F.split("own", _BLANK_LINES)).alias("passage"))
    df = df.withColumn("passage", F.lower(F.trim(F.regexp_replace("passage", r"\s+", " "))))
    return df.filter("passage <> ''").select(
        "conv", "turn", "level", F.xxhash64("passage").alias("h1"), F.xxhash64(F.lit(1), "passage").alias("h2"),
        F.length("passage").cast("long").alias("chars"))


def replies(messages: DataFrame) -> DataFrame:
    """(conv, turn, parent, n_linked) of the messages that quote an earlier one."""
    found = passages(messages.filter("conv IS NOT NULL AND turn IS NOT NULL"))
    quoting = found.filter("level > 0").select("conv", "turn", "level", "h1", "h2", "chars").distinct()
    first = found.filter("level = 0").groupBy("conv", "h1", "h2").agg(F.min("turn").alias("original"))
    links = quoting.join(first, ["conv", "h1", "h2"]).filter("original < turn")
    votes = links.groupBy("conv", "turn", "level", "original").agg(
        F.sum("chars").alias("chars"), F.count(F.lit(1)).alias("n"))
    return votes.groupBy("conv", "turn").agg(
        F.max(F.struct(-F.col("level"), "chars", "original")).getField("original").alias("parent"),
        F.sum("n").alias("n_linked"))


def ancestors(reply: DataFrame) -> DataFrame:
    """(conv, turn, parent, n_linked, root, depth) for the rows of ``replies``."""
    state = staged(reply.withColumns({"root": F.col("parent"), "depth": F.lit(1).cast("long")}), "replies")
    while True:
        up = state.select("conv", F.col("turn").alias("root"), F.col("root").alias("above"), F.col("depth").alias("more"))
        state = staged(state.join(up, ["conv", "root"], "left").select(
            "conv", "turn", "parent", "n_linked", F.coalesce("above", "root").alias("root"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("above").isNotNull().alias("moved")),
            "ancestors")
        if not state.filter("moved").limit(1).count():
            return state.drop("moved")
        state = state.drop("moved")


def reply_threads(messages: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn",
                  text_col: str = "text") -> DataFrame:
    """Columns ``message`` (the whole row), body, parent_turn, root_turn, depth, n_quoted_lines, n_linked."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = messages.select(F.struct("*").alias("message"), F.col(conv_col).alias("conv"),
                           F.col(turn_col).alias("turn"), text.alias("text"))
    thread = ancestors(replies(rows.select("conv", "turn", "text")))
    rows = rows.withColumn("lines", _lines(F.col("text")))
    own = F.filter("lines", lambda x: x["level"] == 0)
    quoted = F.size("lines") - F.size(own)
    # without its quotes a message also loses the blank lines around them at either end
    body = F.when(quoted == 0, F.col("text")).otherwise(
        F.regexp_replace(F.array_join(own["body"], "\n"), r"^(?:[ \t]*\n)+|(?:\n[ \t]*)+$", ""))
    rows = rows.select("message", "conv", "turn", body.alias("body"), quoted.cast("long").alias("n_quoted_lines"))
    return rows.join(thread, ["conv", "turn"], "left").select(
        "message", "body", F.col("parent").alias("parent_turn"), F.coalesce("root", "turn").alias("root_turn"),
        F.coalesce("depth", F.lit(0)).alias("depth"), "n_quoted_lines",
        F.coalesce("n_linked", F.lit(0)).alias("n_linked"))


ORACLE_SQL = r"""
WITH RECURSIVE line AS (
  SELECT conv_id, turn, i,
         len(regexp_extract(x, '^[ \t]*(?:>[ \t]*)+')) - len(replace(regexp_extract(x, '^[ \t]*(?:>[ \t]*)+'), '>', '')) AS level,
         regexp_replace(x, '^[ \t]*(?:>[ \t]*)+', '') AS body
  FROM (SELECT conv_id, turn, unnest(xs) AS x, generate_subscripts(xs, 1) AS i
        FROM (SELECT DISTINCT conv_id, turn, string_split_regex(coalesce(text, ''), '\r?\n') AS xs FROM conversations))
), run AS (
  SELECT *, sum(CASE WHEN trim(body, ' ' || chr(9)) = '' OR level IS DISTINCT FROM before THEN 1 ELSE 0 END)
              OVER (PARTITION BY conv_id, turn ORDER BY i) AS run
  FROM (SELECT *, lag(level) OVER (PARTITION BY conv_id, turn ORDER BY i) AS before FROM line)
), passage AS (
  SELECT conv_id, turn, level, lower(trim(regexp_replace(string_agg(body, chr(10) ORDER BY i), '\s+', ' ', 'g'))) AS p
  FROM run GROUP BY conv_id, turn, level, run
), first_seen AS (
  SELECT conv_id, p, min(turn) AS original FROM passage WHERE level = 0 AND p <> '' AND turn IS NOT NULL GROUP BY 1, 2
), vote AS (
  SELECT q.conv_id, q.turn, q.level, f.original, sum(length(q.p)) AS chars, count(*) AS n
  FROM (SELECT DISTINCT * FROM passage WHERE level > 0 AND p <> '') q
  JOIN first_seen f ON q.conv_id = f.conv_id AND q.p = f.p AND f.original < q.turn GROUP BY 1, 2, 3, 4
), reply AS (
  SELECT conv_id, turn, sum(n) AS n_linked,
         first(original ORDER BY level, chars DESC, original DESC) AS parent
  FROM vote GROUP BY 1, 2
), up AS (
  SELECT conv_id, turn, parent AS root, 1 AS depth FROM reply
  UNION ALL
  SELECT up.conv_id, up.turn, r.parent, up.depth + 1 FROM up JOIN reply r ON up.conv_id = r.conv_id AND up.root = r.turn
), top AS (
  SELECT conv_id, turn, min(root) AS root, max(depth) AS depth FROM up GROUP BY 1, 2
), quoted AS (
  SELECT conv_id, turn, count(*) FILTER (level > 0) AS n,
         string_agg(body, chr(10) ORDER BY i) FILTER (level = 0) AS own FROM line GROUP BY 1, 2
)
SELECT c.conv_id, c.turn, c.role,
       CASE WHEN coalesce(q.n, 0) = 0 THEN coalesce(c.text, '')
            ELSE regexp_replace(coalesce(q.own, ''), '^([ \t]*\n)+|(\n[ \t]*)+$', '', 'g') END AS body,
       r.parent AS parent_turn, coalesce(t.root, c.turn) AS root_turn, CAST(coalesce(t.depth, 0) AS BIGINT) AS depth,
       CAST(coalesce(q.n, 0) AS BIGINT) AS n_quoted_lines, CAST(coalesce(r.n_linked, 0) AS BIGINT) AS n_linked
FROM conversations c
LEFT JOIN quoted q ON q.conv_id IS NOT DISTINCT FROM c.conv_id AND q.turn IS NOT DISTINCT FROM c.turn
LEFT JOIN reply r ON r.conv_id = c.conv_id AND r.turn = c.turn
LEFT JOIN top t ON t.conv_id = c.conv_id AND t.turn = c.turn
"""
