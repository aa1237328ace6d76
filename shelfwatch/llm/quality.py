"""Quality rules: counts, repetition, and divergence from language references.

Everything is built from DataFrame functions. ``measure`` counts everything of each document
in one pass over the texts; its rows are staged. ``references`` sums, for each language of
``COMMON_WORDS``, the character classes and the common words of the measured documents that use
that language's words most; references of a clean corpus can be given instead. ``judge`` takes
each measured document by itself: the base rules, and the Jensen-Shannon distance (base 2, 0 to
1) of its two histograms to the nearest reference. References of the corpus itself stand for
its majority: where junk makes up so much of a language's running words that it moves the sums
by about the limits (0.3), junk passes and clean texts fail; give references then. A document is rejected if the base rules fail, or if it
has at least ``MIN_WORDS`` words and either distance is above its limit. Shorter documents,
and all documents while no reference exists, are judged by the base rules alone. A language
without reference is measured against the others; give its words to have it judged fairly.

Repetition: the 8-word windows of a text are hashed (64 bits); a word counts if any window
over it occurs twice or more in the text.

Defined results: null text counts as empty (no words, so the base rules fail); a null
``doc_id`` and repeated rows stay rows of their own; an empty table gives an empty result;
other columns are carried along unread, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

MIN_BASE_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
#: Fewest words for a document to shape a reference or to be judged by its distances.
MIN_WORDS = 64
MAX_CLASS_DISTANCE = 0.30
MAX_WORD_DISTANCE = 0.30

# Frequent function words of each language.
COMMON_WORDS = {
    "en": "the of and to in a is that for it with was".split(),
    "de": "der die und in den von zu das mit sich auf für".split(),
    "fr": "de la le et les des en un du une que pour".split(),
    "es": "de la que el en y a los se del las por".split(),
}
_ALL_WORDS = list(dict.fromkeys(w for words in COMMON_WORDS.values() for w in words))

_SPACE = r"[\x20\x09-\x0D]+"
# One class after the other, each counted on what the earlier ones left.
_CLASSES = ["[a-z]+", _SPACE, "[^\\x00-\\x7F]+", "[A-Z]+", "[0-9]+", r"[#*$%&|<>]+"]


def _words(text: Column) -> Column:
    return F.filter(F.split(text, _SPACE), lambda w: w != "")


def _add_histograms(df: DataFrame) -> DataFrame:
    """From ``text``: n_words, classes (character counts), common (counts of _ALL_WORDS)."""
    df = df.withColumn("words", _words(F.col("text"))).withColumn("n_words", F.size("words").cast("long"))
    left, counts = F.col("text"), []
    for k, pattern in enumerate(_CLASSES):
        df = df.withColumn(f"left{k}", F.regexp_replace(left, F.lit(pattern), F.lit("")))
        counts.append((F.length(left) - F.length(f"left{k}")).cast("long"))
        left = F.col(f"left{k}")
    df = df.withColumn("classes", F.array(*counts, F.length(left).cast("long")))
    # Words without their punctuation and digits; the common ones, each between two blanks.
    bare = F.split(F.lower(F.regexp_replace("text", r"[^\p{L}\x20\x09-\x0D]+", "")), _SPACE)
    df = df.withColumn("bare", F.concat(F.lit(" "), F.array_join(
        F.filter(bare, lambda w: w.isin(_ALL_WORDS)), "  "), F.lit(" ")))
    seen = [((F.length("bare") - F.length(F.replace("bare", F.lit(f" {w} "), F.lit("")))) / (len(w) + 2))
            .cast("long") for w in _ALL_WORDS]
    return (df.withColumn("common", F.array(*seen))
            .drop("bare", *[f"left{k}" for k in range(len(_CLASSES))]))


def _own_words(common: Column, words: list[str]) -> list[Column]:
    return [common[_ALL_WORDS.index(w)] for w in words]


def measure(docs: DataFrame, *, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``doc`` (the columns ``carry`` of the row; all by default), all counts, and both histograms."""
    kept = [docs[c] for c in (docs.columns if carry is None else carry)]
    df = docs.select(F.struct(*kept).alias("doc"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    df = _add_histograms(df)
    df = df.withColumn("word_chars", F.length(F.array_join("words", "")).cast("long"))
    df = df.withColumn("n_symbols", F.col("classes")[5])
    df = df.withColumn("lines", F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    df = df.withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
    # 64-bit hashes of the 8-word windows; most texts repeat none and stop here
    df = df.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w))).drop("lines", "words")
    # (named twice, so that the planner keeps the hashes as a column of their own)
    df = df.withColumn("windows", F.when(F.size("hashes") > WINDOW, F.transform(
        F.sequence(F.lit(1), F.size("hashes") - (WINDOW - 1)),
        lambda i: F.xxhash64(F.slice("hashes", i, F.lit(WINDOW))))).otherwise(F.array().cast("array<bigint>")))
    df = df.withColumn("repeats", F.size(F.array_distinct("windows")) < F.size("windows")).drop("hashes")
    df = df.withColumn("ordered", F.when(F.col("repeats"), F.sort_array(F.transform(
        "windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    df = df.withColumn("starts", F.sort_array(F.transform(F.filter("ordered", lambda x, k: (
        F.coalesce(F.get("ordered", k - 1)["h"] == x["h"], F.lit(False))
        | F.coalesce(F.get("ordered", k + 1)["h"] == x["h"], F.lit(False)))), lambda x: x["i"])))
    df = df.withColumn("n_repeat_words", F.coalesce(F.aggregate(F.transform("starts", lambda x, k: F.least(
        F.coalesce(F.get("starts", k + 1) - x, F.lit(WINDOW)), F.lit(WINDOW))),
        F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0).cast("long")))
    return df.select("doc", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "classes", "common")


def references(measured: DataFrame) -> dict[str, tuple[list[int], list[int]]]:
    """Per language: character-class counts, and counts of its common words plus all others.

    Sums of integers over all measured rows; one row per language comes to the driver.
    """
    hits = [sum(_own_words(F.col("common"), words), F.lit(0)) for words in COMMON_WORDS.values()]
    df = measured.drop("doc").withColumn("hits", F.array(*hits))
    df = df.withColumn("language", F.when((F.col("n_words") >= MIN_WORDS) & (F.array_max("hits") > 0),
                                          F.array_position("hits", F.array_max("hits"))))
    rows = df.groupBy("language").agg(
        F.sum("n_words").alias("n_words"),
        *[F.sum(F.col("classes")[k]).alias(f"c{k}") for k in range(len(_CLASSES) + 1)],
        *[F.sum(F.col("common")[k]).alias(f"w{k}") for k in range(len(_ALL_WORDS))]).collect()
    out = {}
    for r in rows:
        if r["language"] is None:
            continue
        name = list(COMMON_WORDS)[r["language"] - 1]
        own = [r[f"w{_ALL_WORDS.index(w)}"] for w in COMMON_WORDS[name]]
        out[name] = ([r[f"c{k}"] for k in range(len(_CLASSES) + 1)], [*own, max(0, r["n_words"] - sum(own))])
    return out


def _distance(counts: Column, reference: list[int]) -> Column:
    """Jensen-Shannon distance of a count array to reference counts."""
    total = max(1, sum(reference))
    size = F.greatest(F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(1).cast("long"))

    def term(x: Column, other: Column) -> Column:
        return F.when(x > 0, x * F.log2(2 * x / (x + other))).otherwise(0.0)

    # the total goes in as an array: inside a lambda it would be summed again for each item
    shares = F.zip_with(counts, F.array_repeat(size, len(reference)), lambda x, n: x / n)
    parts = F.zip_with(shares, F.lit([x / total for x in reference]), lambda p, q: term(p, q) + term(q, p))
    return F.sqrt(F.greatest(F.aggregate(parts, F.lit(0.0), lambda a, x: a + x) / 2, F.lit(0.0)))


def judge(measured: DataFrame, refs: dict[str, tuple[list[int], list[int]]]) -> DataFrame:
    """Columns ``doc``, the counts, base_failed, both distances and kept of measured rows."""
    df = measured
    df = df.withColumn("base_failed", (F.col("n_words") < MIN_BASE_WORDS)
                       | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    near = {"class_distance": F.lit(0.0), "word_distance": F.lit(0.0)}
    if refs:
        by_words = []
        for name, (_, words) in refs.items():
            own = F.array(*_own_words(F.col("common"), COMMON_WORDS[name]))
            rest = F.greatest(F.col("n_words") - sum(_own_words(F.col("common"), COMMON_WORDS[name]), F.lit(0)),
                              F.lit(0).cast("long"))
            by_words.append(_distance(F.concat(own, F.array(rest)), words))
        near["class_distance"] = F.array_min(F.array(*[_distance(F.col("classes"), c) for c, _ in refs.values()]))
        near["word_distance"] = F.array_min(F.array(*by_words))
    df = df.withColumns(near)
    far = (F.col("n_words") >= MIN_WORDS) & (
        (F.col("class_distance") > MAX_CLASS_DISTANCE) | (F.col("word_distance") > MAX_WORD_DISTANCE))
    df = df.withColumn("kept", ~F.col("base_failed") & ~far)
    return df.select("doc", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                     "class_distance", "word_distance", "kept")


def quality(docs: DataFrame, *, text_col: str = "text", carry: list[str] | None = None,
            refs: dict[str, tuple[list[int], list[int]]] | None = None) -> DataFrame:
    """``judge`` of every row against ``refs``, by default those of the same documents.

    The measured rows are written once, with the columns ``carry`` (all by default).
    """
    measured = staged(measure(docs, text_col=text_col, carry=carry), "measured")
    return judge(measured, references(measured) if refs is None else refs)
