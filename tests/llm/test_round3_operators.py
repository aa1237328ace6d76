"""Toxic spans, fill-in-middle and the source divergence audit, against brute force."""

import hashlib
import itertools
import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwatch.llm import divergence, fim, toxicity
from shelfwatch.llm.queries import op11_toxic_spans

from .conftest import DOCS, ODD, rows

# --- fill-in-middle ----------------------------------------------------------------------------

FIM_ODD = [*ODD, (20, "ab<P>cd"), (21, "<"), (22, "<M"), (23, "a<S" * 40), (24, "<<<>>>" * 3000), (25, "é🙂" * 5000)]


def _docs(spark, items, parts=3):
    return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in items], DOCS).repartition(parts)


def _fim_row(doc_id, text):
    text = text or ""
    form, prefix, middle, suffix = fim.cut(doc_id, text)
    assert prefix + middle + suffix == text
    out = {"plain": text, "psm": f"<P>{prefix}<S>{suffix}<M>{middle}",
           "spm": f"<S>{suffix}<P>{prefix}<M>{middle}"}[form]
    return (doc_id, len(text), form, *((None, None) if form == "plain" else (len(prefix), len(middle))),
            hashlib.sha256(out.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def _sorted(items):
    return sorted((tuple(x) for x in items), key=lambda r: [(x is not None, str(type(x)), x) for x in r])


def test_fim_digests_against_brute_force(spark):
    items = FIM_ODD + [(7, "same text in many rows " * 30)] * 40
    got = rows(fim.digests(fim.restored(fim.pieces(_docs(spark, items)))))
    assert got == _sorted(_fim_row(*x) for x in items)


def test_fim_pieces_are_bounded_and_texts_restore(spark):
    items = FIM_ODD + [(i, "word " * (i * 37)) for i in range(30, 60)]
    pieces = fim.pieces(_docs(spark, items), plain_percent=0, spm_percent=50)
    assert pieces.select(F.max(F.length("piece"))).first()[0] <= fim.UNIT
    texts = fim.texts(pieces).collect()
    assert {r["form"] for r in texts} == {"plain", "psm", "spm"}
    assert _sorted((r["doc_id"], fim.restore_text(r["form"], r["text"])) for r in texts) \
        == _sorted((i, t or "") for i, t in items)


def test_fim_reader_finds_sentinels_in_any_pieces():
    rng = random.Random(5)
    for k in range(300):
        text = "".join(rng.choice("<>PSMa") for _ in range(rng.randrange(1, 40)))
        form, *parts = fim.cut(k, text, plain_percent=0)
        whole = fim.output(form, *parts)
        reader, found, at = fim.Reader(form), Counter(), 0
        back = {s: "" for s in fim.SENTINELS}
        while at < len(whole):
            step = rng.randrange(1, 5)
            for s, run in reader.feed(whole[at:at + step]):
                back[s] += run
            at += step
        for s, run in reader.end():
            back[s] += run
        assert [back[fim.PREFIX], back[fim.MIDDLE], back[fim.SUFFIX]] == parts, (text, found)


def test_fim_odd_columns_and_empty_table(odd_docs, no_docs):
    assert rows(fim.digests(fim.restored(fim.pieces(odd_docs)))) == _sorted(_fim_row(*x) for x in ODD)
    assert fim.digests(fim.restored(fim.pieces(no_docs))).count() == 0


# --- source divergence -------------------------------------------------------------------------

def _audit(items, min_docs=3, top=200):
    """Plain version over (text, lang, source)."""
    items = [tuple(x or "" for x in r) for r in items]
    out = []
    for lang in {x[1] for x in items}:
        docs = [(divergence.terms(t.encode()), s) for t, lg, s in items if lg == lang]
        df = Counter(w for ws, _ in docs for w in set(ws) - {b""})
        kept = [w for w in df if df[w] >= min_docs]
        count = {s: Counter() for _, s in docs}
        for ws, s in docs:
            count[s].update(w for w in ws if df[w] >= min_docs and w)
        whole = sum(count.values(), Counter())

        def p(c, w):
            return 1 + 10 ** 9 * (c[w] + 1) // (sum(c.values()) + len(kept))

        def f(a, b):
            return (a - b) ** 2 // b

        for s in count:
            pair = [(-sum(f(p(count[s], w), p(count[o], w)) for w in kept), o.encode()) for o in count if o != s]
            term = [(-f(p(count[s], w), p(whole, w)), w) for w in kept
                    if count[s][w] and p(count[s], w) > p(whole, w)]
            for part, found, end in (("pair", pair, None), ("term", term, top)):
                out += [(lang, s, part, item.decode(), -v, k + 1) for k, (v, item) in enumerate(sorted(found)[:end])]
    return _sorted(out)


def _frame(spark, items):
    return spark.createDataFrame(items, "text string, lang string, source string").repartition(4)


def test_divergence_against_brute_force(spark):
    rng = random.Random(3)
    vocabulary = [f"{a}{b}" for a in ("Wort", "mot", "é", "palabra", "x") for b in "abcdefghijklmnopqrst"] + ["tie"]
    items = [(" ".join(rng.choice(vocabulary[:rng.randrange(5, 101)]) for _ in range(rng.randrange(0, 60))),
              rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "Ä", None, "s1"])) for _ in range(150)]
    items += [(None, "en", "empty"), ("12 -- 34", "xx", "a"), ("", "xx", "b"), (None, None, None), ("a1b_c", "en", "s2")]
    got = rows(divergence.audit(_frame(spark, items)))
    assert got == _audit(items)
    assert rows(divergence.audit(_frame(spark, items), top=7)) == _audit(items, top=7)


def test_divergence_ties_repeats_and_long_texts(spark):
    words = [f"w{a}{b}".replace("0", "q") for a in "abcdefghijklmnopqrstuvwxyz" for b in "abcdefghijklmnopqrstuvwxyz"]
    items = [(" ".join(words), "en", "same")] * 4 + [("other words entirely " * 20000, "en", "long")] * 3 + \
        [("other words", "en", "third")]
    got = rows(divergence.audit(_frame(spark, items)))
    assert got == _audit(items)
    assert sum(r[:3] == ("en", "same", "term") for r in got) == 200


def test_divergence_small_tables_of_a_task(spark, monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(divergence, "TABLE_ENTRIES", 3)
    batch = pa.RecordBatch.from_arrays([pa.array(["en", "en", None]), pa.array(["s", "t", None]),
                                        pa.array(["a b c d a", "b b x", "a"])], ["lang", "source", "text"])
    total = Counter()
    for b in divergence._count_task(iter([batch, batch])):
        for r in b.to_pylist():
            total[r["lang"], r["source"], r["term"], "n"] += r["n"]
            total[r["lang"], r["source"], r["term"], "docs"] += r["docs"]
    assert total["en", "s", "a", "n"] == 4 and total["en", "s", "a", "docs"] == 2 and total["en", "t", "b", "n"] == 4


def test_divergence_odd_columns_and_empty_table(odd_docs, no_docs):
    items = [(t, "en", "s") for _, t in ODD]
    assert rows(divergence.audit(odd_docs)) == _audit(items)
    assert divergence.audit(no_docs).count() == 0


# --- toxic spans -------------------------------------------------------------------------------

def _brute_chain(u, stay, leave):
    """log Z, marginals of 1, of (1, 1) and of (1, 0) by all tag sequences."""
    weights = {}
    for tags in itertools.product((0, 1), repeat=len(u)):
        w = sum(x for x, y in zip(u, tags) if y)
        for a, b in zip((0, *tags), tags):
            w += stay * (a and b) + leave * (a and not b)
        weights[tags] = np.exp(w)
    z = sum(weights.values())
    def share(test):
        return [sum(w for t, w in weights.items() if test((0, *t), k + 1)) / z for k in range(len(u))]
    return (np.log(z), share(lambda t, k: t[k] == 1), share(lambda t, k: t[k - 1] == 1 and t[k] == 1),
            share(lambda t, k: t[k - 1] == 1 and t[k] == 0))


def test_forward_backward_against_all_sequences(monkeypatch):
    monkeypatch.setattr(toxicity, "BLOCK", 3)                # several blocks a document
    rng = np.random.default_rng(1)
    lengths = np.array([0, 1, 9, 3, 7, 0, 4])
    u = rng.normal(-1, 2, lengths.sum())
    log_z, *marginals = toxicity.forward_backward(u, lengths, 0.7, -1.1)
    start = 0
    for i, n in enumerate(lengths):
        want = _brute_chain(u[start:start + n], 0.7, -1.1)
        assert np.isclose(log_z[i], want[0])
        for got, exact in zip(marginals, want[1:]):
            assert np.allclose(got[start:start + n], exact)
        start += n


@pytest.mark.parametrize("seeded", [True, False])
def test_gradient_is_the_slope_of_the_likelihood(seeded):
    rng = np.random.default_rng(2)
    data = dict(toxic=np.array([1, 0, 1, 0], np.int8), lengths=np.array([5, 4, 0, 6], np.int32),
                tokens=rng.integers(0, 4, 15).astype(np.int32), ends=np.array([0, 2, 3, 3, 5], np.int32),
                found=np.array([0, 1, 1, 0, 2], np.int32), seed=np.array([1, 0, 0, 0], np.int8))
    theta = rng.normal(0, 1, 6)

    def at(x):
        return toxicity.gradient(x, **data, weight=2.0, noise=0.05, seeded=seeded)
    g = at(theta)
    for k in range(6):
        step = np.zeros(6)
        step[k] = 1e-5
        assert np.isclose((at(theta + step)[-1] - at(theta - step)[-1]) / 2e-5, g[k], atol=1e-5)


def test_spans_and_scores_of_a_given_model():
    model = toxicity.Model({"=vile": 14.0, "<nas": 14.0}, -8.0, 1.0, -1.0)
    texts = ["a Vile nasty, thing", "", "all is well " * 4000, "vile", "ok " * 5000 + "vile"]
    scores, spans = toxicity.tag_texts(texts, model, {})
    assert [[(s, e) for s, e, _ in x] for x in spans] == [[(2, 12)], [], [], [(0, 4)], [(15000, 15004)]]
    assert scores[0] > 0.99 and scores[1] == 0 and scores[3] > 0.9 and scores[4] > 0.9


def test_learned_from_labels_and_held_out(spark):
    rng = random.Random(9)
    plain = [f"w{a}{b}" for a in "abcdefgh" for b in "klmnopqrst"]
    items, labels = [], []
    for i in range(600):
        toxic = i % 6 == 0
        words = [rng.choice(plain) for _ in range(rng.randrange(15, 60))]
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["grobian", "Schuft", "tölpel"]) + rng.choice(["", "en"]))
        items.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs, marks = _docs(spark, items), spark.createDataFrame(labels + [(None, 1), (5, None), (9999, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, marks, max_rows=200)
    got = {r["doc_id"]: r for r in toxicity.score(docs, model).withColumn(
        "held_out", toxicity.held_out(F.col("doc_id"))).collect()}
    assert all((got[i]["score"] >= 0.7) == bool(y) for i, y in labels)
    assert 100 < sum(r["held_out"] for r in got.values()) < 300
    hit = got[0]["spans"][0]
    assert items[0][1][hit["start"]:hit["end"]].lower()[:3] in ("gro", "sch", "töl")
    # Labels of held-out rows change nothing.
    flipped = spark.createDataFrame([(i, 1 - y if got[i]["held_out"] else y) for i, y in labels], "doc_id long, toxic int")
    again = {r["doc_id"]: r["score"] for r in toxicity.score(docs, toxicity.fit(docs, flipped, max_rows=200)).collect()}
    assert max(abs(again[i] - got[i]["score"]) for i in again) < 1e-6


def test_toxicity_odd_rows(spark, odd_docs, no_docs):
    marks = spark.createDataFrame([(i, int(i in (4, 9))) for i in range(1, 14)], "doc_id long, toxic int")
    model = toxicity.fit(odd_docs, marks)
    scored = toxicity.score(odd_docs, model)
    assert scored.count() == len(ODD) and scored.filter("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert toxicity.score(no_docs, model).count() == 0
    for empty in (toxicity.fit(no_docs, marks), toxicity.fit(odd_docs, marks.limit(0))):
        assert toxicity.score(odd_docs, empty).filter("score > 0.001").count() == 0


def test_op11_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = op11_toxic_spans(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic"), "doc_id")
    n = {(r["predicted"], r["toxic"]): r["n"] for r in got.filter("held_out AND toxic IS NOT NULL")
         .groupBy("predicted", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert n.get((1, 0), 0) <= 0.01 * n[0, 0]                 # clean documents are left alone
    assert n[1, 1] / (n[1, 1] + n[0, 1]) > 0.8                # a tenth of the labels marks texts without any toxic word


def test_round3_oracles_agree(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert rows(divergence.audit(docs)) == _sorted(con.execute(divergence.ORACLE_SQL).fetchall())
    assert rows(fim.digests(fim.restored(fim.pieces(docs)))) == _sorted(con.execute(fim.ORACLE_SQL).fetchall())
