"""Top-k, personal data, quotations, quality, licenses and the pipeline."""
import math
import random
import re
import time
from collections import Counter

import corpus_pipeline
import duckdb
import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from shelfwatch.llm import license, pii, quality, queries, quoting, topk

from .conftest import DOCS, ODD, rows

VECTORS = "vec_id long, embedding array<float>, score string, rank string"


def best(vectors, k=10):
    q = {i: [int(np.floor(1024 * float(np.float32(x)))) for x in v] for i, v in vectors}
    out = []
    for i, v in q.items():
        if i % 100 == 0:
            found = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in q.items() if j != i)[:k]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(found)]
    return sorted(out)


def test_op5_against_all_products(spark):
    vectors = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    assert rows(queries.op5_topk_bound(spark, SF_SMALL)) == best(vectors)


def test_topk_ties_nulls_lengths_and_large_values(spark):
    r, nan, inf = random.Random(3), float("nan"), float("inf")
    vectors = [(i, [r.choice([-1.0, 0.0, 1.0, 0.5]) for _ in range(r.choice([9, 20]))]) for i in range(330)]
    vectors += [(400 + i, [0.25] * 20) for i in range(50)] + [(500, [])]
    bad = [(None, [1.0]), (600, None), (700, [1.0, None]), (800, [nan]), (900, [inf, 0.0]), (901, [-inf])]
    df = spark.createDataFrame([(i, v, "z", "z") for i, v in vectors + bad + vectors[:3]], VECTORS).repartition(4)
    is_query = F.col("vec_id") % 100 == 0
    got = topk.top_k(df, is_query)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert rows(got) == best(vectors)
    assert topk.top_k(df.limit(0), is_query).count() == 0
    large = [(i, [float(2 ** 20 + 3 * i), -float(2 ** 19)]) for i in (0, 1, 2, 100)]
    assert rows(topk.top_k(spark.createDataFrame([(i, v, "", "") for i, v in large], VECTORS), is_query)) == best(large)


def test_topk_over_a_grid_of_slots(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_ROWS", 5)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 16)
    r = np.random.default_rng(8)
    vectors = [(i, r.normal(size=6).round(2).tolist()) for i in range(90)]
    df = spark.createDataFrame([(i, v, "", "") for i, v in vectors], VECTORS).repartition(3)
    got = {}
    for x in topk.top_k(df, F.col("vec_id") % 2 == 0).collect():                 # 4 rows of slots, 2 columns each or so
        got.setdefault(x.query_id, []).append((x.rank, x.vec_id, x.score))
    cells = {i: [math.floor(1024 * c) for c in v] for i, v in vectors}
    for q in range(0, 90, 2):
        best_of = sorted((-sum(a * b for a, b in zip(cells[q], cells[i])), i) for i in cells if i != q)[:10]
        assert sorted(got[q]) == [(k, i, -s) for k, (s, i) in enumerate(best_of, 1)]


def test_topk_of_rows_repeated_many_times(spark):
    """Copies of a best candidate, of a query, and of one id with several vectors of one score."""
    r = random.Random(11)
    vectors = [(i, [r.choice([-1.0, 0.0, 1.0, 0.5]) for _ in range(9)]) for i in range(301)]
    vectors += [(400 + i, [3.0 + i] * 9) for i in range(12)]
    copies = vectors[-1:] * 50 + [(411, [14.0] * 9 + [0.0] * j) for j in range(30)] + vectors[100:101] * 50
    df = spark.createDataFrame([(i, v, "z", "z") for i, v in vectors + copies], VECTORS).coalesce(1)
    assert rows(topk.top_k(df, F.col("vec_id") % 100 == 0)) == best(vectors)
    many = [(1, [9.0, float(i)]) for i in range(50)] + [(i, [float(10 - i % 7), 0.0]) for i in range(2, 30)] + [(0, [1.0])]
    df = spark.createDataFrame([(i, v, "z", "z") for i, v in many], VECTORS).coalesce(1)
    got = rows(topk.top_k(df, F.col("vec_id") == 0))
    expected = sorted({(-int(1024 * v[0]) * 1024, i) for i, v in many if i})[:10]
    assert got == [(0, n + 1, i, -s) for n, (s, i) in enumerate(expected)]


def test_topk_blocks_are_not_broadcast(spark):
    """Copies for the slots are unknown to Spark's estimates: a join broadcast them all."""
    df = spark.createDataFrame([(i, [float(i % 7), 1.0], "", "") for i in range(300)], VECTORS)
    got = topk.top_k(df, F.col("vec_id") % 100 == 0)
    assert len(got.collect()) == 30
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("decay, spread, rows_of_id", [(1.0, 300.0, 1), (0.7, 300.0, 3), (0.7, 2.0, 1), (0.5, 40_000.0, 400)])
def test_topk_keeps_the_best_of_many_blocks(decay, spread, rows_of_id):
    r = np.random.default_rng(5)
    blocks = [(r.integers(0, 400, 200) // rows_of_id, np.floor(r.normal(size=(n, 200)) * spread * decay ** np.arange(n)[:, None]))
              for n in [40, 21, 40, 0, 33]]
    q_ids, q = np.arange(70), np.floor(r.normal(size=(37, 70)) * spread * decay ** np.arange(37)[:, None])
    best = topk.Best(q_ids, q, 10)
    for ids, x in blocks:
        best.meet(topk.Candidates(ids, x))
    got = {}
    for i, j, score in zip(*(c.to_pylist() for c in best.result().columns)):
        got.setdefault(i, []).append((-score, j))
    for i in range(70):
        every = {(-int(sum(int(a) * int(b) for a, b in zip(q[:, i], col))), int(j)) for ids, x in blocks
                 for j, col in zip(ids, x.T) if j != i}
        assert got.get(i, []) == sorted(every)[:10]


PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
         "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
         "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    out = []
    for k, kind in enumerate(pii.KINDS):
        for m in re.finditer(PLAIN[kind], text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_spans_are_those_of_the_plain_patterns():
    r = random.Random(6)
    for _ in range(4000):
        t = "".join(r.choice(["a", "b.", "@", "_", "-", "1", "27", "255", "256", ".", "+", " ", "4111111111111111", "(", "é"])
                    for _ in range(r.randint(1, 25)))
        assert pii.base_spans(t) == plain_spans(t), t
    assert pii.base_spans("a" * 200_000 + "@b " + "1" * 200_000) == []            # in linear time


def test_op6_against_the_plain_patterns(spark):
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    for r in queries.op6_contextual_pii(spark, SF_SMALL).collect():
        base = plain_spans(text[r.doc_id])
        assert r.base_sha256 == pii.spans_sha256(base)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == n for _, k, _ in base) for n in range(4)]
        assert set(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in base) <= set(r.spans.split(",")) | {""}


def test_patterns_discover_unseen_identifiers(spark):
    """A context with several seeds finds a phone number without plus; a common one doesn't."""
    texts = [f"please dial hotline number: +1 (555) 010-99{i:02d} today {i}" for i in range(9)]
    texts += ["please dial hotline number: 555 010 7788 today", "of the 555 010 1234 of the day"]
    texts += ["of the +1 (555) 010-1111 and " + "more of the words " * 9] * 3 + ["of the day"] * 40
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS)
    found = {r.doc_id: r for r in pii.digests(pii.find(df)).collect()}
    assert found[9].n_phone == 0 and found[9].spans == "phone:28:40"
    assert found[10].spans == "" and found[0].spans == "phone:28:45"
    clean = {r.doc_id: r for r in pii.redact(df).collect()}
    assert clean[9].text == "please dial hotline number: [PHONE] today" and clean[9].n_chars == len(clean[9].text)


def test_a_context_copied_thousands_of_times_still_discovers(spark):
    texts = [f"please dial hotline number: +1 (555) 010-99{i:02d} today {i}" for i in range(9)]
    texts += [texts[0]] * 2000 + [f"note {i}: please dial hotline number: +1 (555) 010-9901 bye" for i in range(500)]
    texts += ["please dial hotline number: 555 010 7788 today"]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS)
    found = pii.digests(pii.find(df)).filter(F.col("doc_id") == len(texts) - 1).first()
    assert found.n_phone == 0 and found.spans == "phone:28:40"


def test_patterns_of_glued_labels_and_brackets_are_counted_as_they_are_taken(spark):
    import pyarrow as pa
    r, bits = random.Random(12), b"\xff" * 1024
    pieces = ["tel:", "<", "(", "a@b", "é", "x_", "%", " ", " ", "  ", "...", "5550101", "+1 (555) 010-9999", "a.b@c.de",
              "10.0.0.1", "word", "w" * 70, "="]
    for _ in range(3000):
        text = "".join(r.choice(pieces) for _ in range(r.randint(3, 30)))
        batch = pa.RecordBatch.from_pydict({"text": [text]})
        counts = {k: n for b in pii._count_task(bits)(iter([batch])) for k, n in zip(*b.to_pydict().values())}
        places = {(p, text.rfind(" ", 0, start)) for p, _, _, start, _, _ in pii.mentions(text, pii.base_spans(text))}
        for pattern in {p for p, _ in places}:
            assert sum(p == pattern for p, _ in places) <= counts.get(pattern, 0), (pattern, text)
    seeds = ["my tel:+1-555-010-99{:02d} ok", "his phone: (+1 555 010 99{:02d}) ok", "by mail <user{}@host.example> ok"]
    unseen = ["my tel:5550101 ok", "his phone: (555) 010-1234 ok", "by mail <someone@host> ok"]
    texts = [t.format(i) for t in seeds for i in range(12)] + unseen
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS)
    found = {x.doc_id: x.spans for x in pii.digests(pii.find(df)).collect()}
    assert [found[36 + i] for i in range(3)] == ["phone:7:14", "phone:12:25", "email:9:21"]


def test_discovered_identifiers_lead_to_further_patterns(spark):
    """Three generations: dial hotline, whose finds stand behind call desk, and those behind ring office."""
    number = "555 010 {:04d}".format
    texts = [f"dial hotline +1 555 010 {i:04d} now" for i in range(12)]
    texts += [f"dial hotline {number(i)} now" for i in range(100, 104)]
    texts += [f"call desk {number(i)} now" for i in [*range(100, 104), *range(200, 204)]]
    texts += [f"ring office {number(i)} now" for i in [*range(200, 204), 300]] + [f"some lot {number(i)} now" for i in range(400, 410)]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS)
    found = {x.doc_id: x.spans for x in pii.digests(pii.find(df)).collect()}
    assert [bool(found[i]) for i in range(len(texts))] == ["some lot" not in t for t in texts]


WS = r"[\x20\x09-\x0D]"


def plain_word(w):
    return re.sub("[0-9]", "0", w.lower().strip("\"'()[]<>.,;!?"))


def letter_runs(w):
    return re.findall(r"[a-z]+|[^\W\d_a-z]+", w.casefold())


def plain_pattern(text, start):
    *words, glued = re.split(WS, text[:start])
    got = [p for w in words if (p := plain_word(w))] + letter_runs(re.split("[0-9@]", glued)[-1])[-1:]
    return " ".join(got[-2:]) if len(got) > 1 else ""


def plain_mentions(text):
    """(pattern, kind, instance, start, end, seed), by trying every candidate against every span."""
    spans = plain_spans(text)
    all_of = [(s, e, k, True) for s, k, e in spans]
    for m in pii._CANDIDATE.finditer(text):
        if not any(s < m.end() and m.start() < e for s, _, e in spans):
            all_of += [(m.start(), m.end(), k, False) for k in pii._kinds_of(m.group())]
    out = []
    for s, e, k, seed in sorted(all_of):
        if p := plain_pattern(text, s):
            out.append((p, k, text[s:e].lower() if k == 0 else re.sub("[^0-9]", "", text[s:e]), s, e, seed))
    return out


def plain_discovery(texts):
    """Spans of every text: scoring and discovery in plain Python."""
    found = [plain_mentions(t) for t in texts]
    n = Counter()
    for t in texts:
        before = None
        for w in re.findall(r"[^\x20\x09-\x0D]+", t):
            whole = plain_word(w)
            if before:
                n.update(f"{before} {f}" for f in [*[x for x in letter_runs(w) if x != whole], whole] if f)
            before = whole or before
    times = Counter((p, k, i) for ms in found for p, k, i, *_ in ms)
    known = {(k, i) for ms in found for _, k, i, _, _, seed in ms if seed}
    open_ = {(p, k, i) for ms in found for p, k, i, _, _, seed in ms if not seed}
    while True:
        held = Counter((p, k) for p, k, i in times if (k, i) in known)
        strong = {x for x, c in held.items() if c >= pii.MIN_SEEDS}
        graph = [(x, t) for x, t in times.items() if any(x[0] == p for p, _ in strong)]
        score = {x[1:]: float(x[1:] in known) for x, _ in graph}
        for _ in range(pii.ROUNDS):
            total = Counter()
            for (p, k, i), t in graph:
                total[p, k] += score[k, i] * t
            trust = {x: v / (n[x[0]] + 1) for x, v in total.items()}
            doubt = {}
            for (p, k, i), _ in graph:
                doubt[k, i] = doubt.get((k, i), 1.0) * (1 - min(trust[p, k], 1 - 1e-9))
            score = {x: 1.0 if x in known else 1 - d for x, d in doubt.items()}
        good = {x: trust[x] for x in strong if x in trust and trust[x] >= pii.MIN_CONFIDENCE}
        new = {(k, i) for p, k, i in open_ if (p, k) in good} - known
        known |= new
        if not new:
            break
    out = []
    for t, ms in zip(texts, found):
        best = {}
        for p, k, _, s, e, seed in ms:
            if not seed and (p, k) in good:
                best[s, e] = max(best.get((s, e), (0, 0)), (round(good[p, k], 9), -k))
        out.append(sorted(plain_spans(t) + [(s, -k, e) for (s, e), (_, k) in best.items()]))
    return out


def test_patterns_of_a_long_text_against_plain_ones_and_in_linear_time():
    r = random.Random(3)
    pieces = ["tel:", "<", "(", "a@b", "é", "x_", "%", " ", " ", "\n", "...", "5550101", "+1 (555) 010-9999", "a.b@c.de",
              "10.0.0.1", "word", "w" * 300, "=", "Straße", "ΣΑΣ", " " * 200]
    for _ in range(1500):
        t = "".join(r.choice(pieces) for _ in range(r.randint(1, 40)))
        assert sorted(pii.mentions(t, pii.base_spans(t))) == sorted(plain_mentions(t)), t
    assert pii.mentions("call " + "x" * 5000 + " office " + "(" * 3000 + "5550101", [])[0][0] == "x" * 5000 + " office"
    for text in ("a@b.cd " * 40_000, "a@b.cd," * 40_000, "tel:5550101 " * 40_000, "a%" * 200_000, "x:5550101," * 30_000):
        start = time.perf_counter()
        pii.mentions(text, pii.base_spans(text))
        assert time.perf_counter() - start < 10


def test_scoring_and_discovery_against_brute_force(spark):
    """Contexts of all kinds, right and misleading ones, a hundred times over."""
    r = random.Random(11)
    number = lambda: f"555 010 {r.randrange(300):04d}"
    forms = {"phone": [lambda: "+1 " + number(), number], "email": [lambda: f"u{r.randrange(90)}@host.example",
             lambda: f"u{r.randrange(90)}@host"], "ip": [lambda: f"10.0.0.{r.randrange(99)}", lambda: f"10.0.{r.randrange(99)}"]}
    contexts = [(f"{a} {b}", r.choice(list(forms)), r.random()) for a in ("dial", "write", "see", "at") for b in (
        "desk", "home:", "(office)", "no.", "lot")]
    texts = []
    for k in range(1200):
        words = []
        for _ in range(r.randrange(1, 4)):
            c, kind, share = r.choice(contexts)
            full, part = forms[kind]
            words += [r.choice(["", "of the", "and so"]), c, full() if r.random() < share else part() if r.random() < 0.8 else ""]
        texts.append(" ".join(words) + r.choice([".", " now", "\n"]))
    texts += [texts[0]] * 300
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS).repartition(4)
    want = plain_discovery(texts)
    got = {x.doc_id: x.spans for x in pii.digests(pii.find(df)).collect()}
    assert sum(len(w) > len(plain_spans(t)) for w, t in zip(want, texts)) > 100       # discovery does run
    for i, spans in enumerate(want):
        assert got[i] == ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in spans), (i, texts[i])


def test_pii_of_odd_rows(odd_docs, no_docs):
    found = pii.digests(pii.find(odd_docs))
    assert found.count() == len(ODD)
    one = found.filter("doc_id = 11").first()
    assert [one.n_email, one.n_ip, one.n_card, one.n_phone] == [1, 1, 1, 1]
    clean = pii.redact(odd_docs)
    assert clean.columns == odd_docs.columns
    got = {r.doc_id: r for r in clean.collect()}
    assert got[11].text == "mail me at [EMAIL] or [PHONE], [CARD] and [IP] ok" and got[11].n_chars == len(got[11].text)
    assert got[1].text is None and got[2].text == "" and got[4].text == dict(ODD)[4] and got[11].row == "z"
    assert pii.find(no_docs).count() == 0 and pii.redact(no_docs).count() == 0


TALK = [(1, 0, "a", "Shall we meet on Monday?\n\nI bring cake."), (1, 1, "b", "> Shall we  meet on\n> monday?\n\nYes."),
        (1, 2, "a", ">> I bring cake.\n> Yes.\nGood\n"), (1, 3, "c", "> Something else\n\nWhat?"),
        (1, 4, "d", "  > > Shall we meet on Monday?\n> Good\n> Something\n\nI come too"), (2, 0, "a", "> Yes.\n"),
        (2, 1, "b", None), (2, 2, "c", ""), (None, 1, "x", "> Yes."), (3, None, "x", "Yes."), (4, 0, "a", "dup"),
        (4, 0, "a", "dup"), (4, 1, "b", "> dup\n> \n> dup\nok")]


def test_quotes_link_to_their_originals(spark):
    df = spark.createDataFrame([(*t, "z", "z") for t in TALK],
                               "conv_id long, turn int, role string, text string, level string, body string").repartition(3)
    got = quoting.reply_threads(df).select("message.conv_id", "message.turn", "message.role", "body", "parent_turn",
                                           "root_turn", "depth", "n_quoted_lines", "n_linked")
    by = {(r.conv_id, r.turn): r for r in got.collect()}
    assert got.count() == len(TALK)
    assert (by[1, 1].parent_turn, by[1, 1].depth, by[1, 1].body) == (0, 1, "Yes.")
    assert (by[1, 2].parent_turn, by[1, 2].root_turn, by[1, 2].depth, by[1, 2].body) == (1, 0, 2, "Good")
    assert (by[1, 3].parent_turn, by[1, 3].root_turn, by[1, 3].body) == (None, 3, "What?")
    assert (by[1, 4].parent_turn, by[1, 4].n_quoted_lines) == (0, 3)       # "Good Something" is nobody's passage
    assert by[2, 0].parent_turn is None and by[2, 1].body == "" and by[4, 1].parent_turn == 0
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn INTEGER, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", TALK)
    key = lambda r: [(x is not None, str(type(x)), x) for x in r]
    assert rows(got) == sorted(con.execute(quoting.ORACLE_SQL).fetchall(), key=key)
    assert quoting.reply_threads(df.limit(0)).count() == 0


def test_quality_counts_and_verdicts(spark, odd_docs, no_docs):
    df = queries.op8_quality_rules(spark, SF_SMALL)
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    for r in df.collect():
        t = text[r.doc_id] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
        twice = {p for i, w in enumerate(windows) if windows.count(w) > 1 for p in range(i, i + 8)} \
            if len(set(windows)) < len(windows) else set()
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)))
        assert (r.n_dup_lines, r.n_repeat_words) == (len(lines) - len(set(lines)), len(twice))
        assert r.base_failed == (len(words) < 20 or 100 * len(twice) > 30 * len(words)) and not (r.kept and r.base_failed)
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet").filter("quality = 1").join(df, "doc_id")
    assert labels.filter("NOT base_failed AND NOT kept").count() == 0
    odd = quality.quality(odd_docs)
    assert odd.count() == len(ODD) and odd.select("doc.*").columns == odd_docs.columns
    assert odd.filter("kept").count() == 0                 # all short, or one sentence over and over
    assert quality.quality(no_docs).count() == 0


def test_quality_divergence(spark):
    r = random.Random(4)
    text = lambda tail="": " ".join(
        (r.choice(quality.COMMON_WORDS["en"]) if r.random() < 0.4 else "".join(r.choice("aeiourstnl") for _ in range(6))) + tail
        for _ in range(120))
    docs = [(i, text(), "en", "", 0) for i in range(40)] + [(50, text("$$%%"), "en", "", 0), (51, text("$$%%")[:90], "en", "", 0)]
    got = {x.doc.doc_id: x.kept for x in quality.quality(spark.createDataFrame(docs, DOCS)).collect()}
    assert all(got[i] for i in range(40)) and not got[50]


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_patience_alignment():
    r = random.Random(7)
    for _ in range(300):
        a, b = ([r.choice("abcdefgh") for _ in range(r.randint(0, 14))] for _ in range(2))
        got = license.align(a, b)
        assert all(a[i] == b[j] for i, j in got) and len(got) <= lcs(a, b)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(got, got[1:]))
    words = license.words(license.TEMPLATES["MIT"])
    changed = ["junk"] * 40 + words[:30] + ["x", "y"] + words[33:] + ["more"] * 20
    assert len(license.align(changed, words)) >= len(words) - 5
    assert license.increasing([3, 1, 2, 9, 4, 5]) == [1, 2, 4, 5]


def test_licenses_are_found_where_they_stand(spark, odd_docs, no_docs):
    mit, gpl = license.TEMPLATES["MIT"], license.TEMPLATES["GPL-3.0"]
    texts = [mit, "word " * 3000 + mit + " word" * 500 + " " + gpl, mit.upper() + " other words " * 200 + mit,
             " ".join(mit.split()[:60]), "Released\nunder the MIT License.", "no license here"]
    df = spark.createDataFrame([(i, t, "en", "", 0) for i, t in enumerate(texts)], DOCS)
    got = [(r.doc_id, r.license) for r in license.scan(df).collect() if r.coverage > 0.9]
    assert sorted(got) == [(0, "MIT"), (1, "GPL-3.0"), (1, "MIT"), (2, "MIT"), (2, "MIT"), (4, "MIT-notice")]
    assert license.scan(odd_docs).count() == 0 and license.scan(no_docs).count() == 0


def test_licenses_with_insertions_at_every_offset():
    scanner = license.Scanner(license.TEMPLATES, license.MIN_COVERAGE)
    found = scanner("see our page Released under the terms and conditions of the MIT License")
    assert found == [("MIT-notice", 1.0, 3, 13)]
    for name, template in license.TEMPLATES.items():
        t = license.words(template)
        n = len(t)
        other = [x for x in ("zebra", "the", "pear", "of") if x in ("zebra", "pear") or n > 20]
        for extra in (0, 1, n // 2, n, 3 * n):
            torn = t[:n // 2] + ["zebra"] * extra + t[n // 2:]
            for before in range(2 * n):
                text = (other * n)[:before] + torn + ["zebra"] * 9
                assert (name, 1.0, before, before + n + extra) in scanner(" ".join(text)), (name, extra, before)
        copies = (t + t[:n - n // 6] + t) * 20                      # whole and shortened, one after the other
        ends = [h[2:] for h in scanner(" ".join(copies)) if h[0] == name]
        assert len(ends) == 60 and all(a[1] <= b[0] for a, b in zip(ends, ends[1:]))


def test_words_strewn_over_ordinary_text_are_no_license():
    scanner = license.Scanner(license.TEMPLATES, license.MIN_COVERAGE)
    mid = " word" * 600
    assert scanner(f"She was released{mid} under{mid} the bridge{mid} by mit students{mid} a license.") == []
    r = random.Random(1)
    vocabulary = sorted({w for t in license.TEMPLATES.values() for w in license.words(t)})
    plain = [f"p{i}" for i in range(400)]
    for k in range(40):                                   # long texts with every template word in any order
        text = [r.choice(plain) if r.random() < 0.9 else r.choice(vocabulary) for _ in range(4000)]
        assert scanner(" ".join(text)) == [], k


def _stretches(w, t, need):
    """Every stretch (a, b) of ``w`` that begins and ends on template words, with its common subsequence."""
    for a in range(len(w)):
        for b in range(a + 1, len(w) + 1):
            if w[a] in t and w[b - 1] in t and b - a >= need:
                yield a, b, lcs(w[a:b], t)


def test_licenses_against_all_stretches():
    r = random.Random(6)
    templates = {"x": "released under the mit license", "y": "licensed under cc by nc 4 0", "z": "the a the b the c the d"}
    scanner = license.Scanner(templates, 0.8)
    hits = 0
    for _ in range(400):
        name = r.choice(list(templates))
        t = templates[name].split()
        w = [r.choice([*t, "pear", "zebra"]) for _ in range(r.randrange(0, 12))]
        at = r.randrange(len(w) + 1)
        w[at:at] = [x for x in t if r.random() < 0.9]
        for _ in range(r.randrange(3)):
            w.insert(r.randrange(len(w) + 1), "kiwi")
        need = 0.8 * len(t)
        got = [h for h in scanner(" ".join(w)) if h[0] == name]
        for _, coverage, a, b in got:                     # nothing that the words don't hold
            n = round(coverage * len(t))
            assert need <= n <= lcs(w[a:b], t) and license.density(n, b - a) > 0
        dense = [(a, b) for a, b, n in _stretches(w, t, need) if n == len(t) == b - a]
        assert all(any(h[2] < b and a < h[3] for h in got) for a, b in dense)      # whole ones are found
        if not any(n >= need and license.density(n, b - a) > 0 for a, b, n in _stretches(w, t, need)):
            assert not got
        hits += len(got)
    assert hits > 100


def test_op10_against_plain_notices(spark):
    notices = {k: v for k, v in license.TEMPLATES.items() if k.endswith("notice")}
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    expected = {(i, k) for i, t in text.items() for k, v in notices.items() if v in (t or "")}
    scan = queries.op10_license_scan(spark, SF_SMALL).collect()
    got = {(r.doc_id, r.license) for r in scan if r.coverage == 1}
    assert expected and expected <= got
    for r in scan:                                        # and nothing that isn't there
        t = license.words(license.TEMPLATES[r.license])
        own = license.words(text[r.doc_id])[r.start_word:r.end_word]
        n = round(r.coverage * len(t))
        assert n <= lcs(own, t) and license.density(n, len(own)) > 0


def test_pipeline_stages(spark, odd_docs, no_docs):
    from shelfwatch.llm import packing
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "minhash_near_dedup", "pii", "packing"]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    judged = {r.doc_id for r in queries.op8_quality_rules(spark, SF_SMALL).filter("kept").collect()}
    stages = dict(corpus_pipeline.STAGES)
    first = stages["quality_rules"](spark, docs, SF_SMALL)
    assert first.columns == docs.columns and {r.doc_id for r in first.collect()} == judged
    from .test_neardup import brute
    kept = {i for i, (_, c) in brute([(r.doc_id, r.text) for r in first.collect()]).items() if i == c}
    second = stages["minhash_near_dedup"](spark, first, SF_SMALL)
    assert {r.doc_id for r in second.collect()} == kept and second.columns == docs.columns
    pieces = corpus_pipeline.run(spark, SF_SMALL)
    assert {r.doc_id for r in pieces.collect()} == kept
    every = [i for i, _ in ODD]
    expected = {"quality_rules": [],                                       # all short, or one sentence over and over
                "minhash_near_dedup": [None, None, 1, 2, 3, 4, 5, 6, 7, 8, 9, 11, 12], "pii": every,
                "packing": every}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd_docs, SF_SMALL)
        assert name == "packing" or out.columns == odd_docs.columns
        got = out.select("doc_id").collect() if name != "packing" else out.filter("start = 0").select("doc_id").collect()
        order = lambda x: (x is not None, x or 0)
        assert sorted((r.doc_id for r in got), key=order) == sorted(expected[name], key=order), name
        if name == "pii":
            text = {r.doc_id: r.text for r in out.collect()}
            assert text[1] is None and text[2] == "" and "[EMAIL]" in text[11] and text[4] == dict(ODD)[4]
        if name == "packing":
            assert out.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 1024").count() == 0
        empty = stage(spark, no_docs, SF_SMALL)
        assert empty.count() == 0 and (name == "packing" or empty.columns == no_docs.columns)
    assert packing.WINDOW == 1024


@pytest.fixture(autouse=True, scope="module")
def _quiet(spark):
    spark.sparkContext.setLogLevel("OFF")
