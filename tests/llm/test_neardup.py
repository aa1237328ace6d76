"""Near duplicates against all pairs, on full shingle sets."""
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from conftest import SF_SMALL

from shelfwatch.llm import common, neardup, queries

from .conftest import DOCS, rows


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) >= 5:
        return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}
    return {tuple(words)} if words else set()


def brute(docs):
    """doc_id -> (set size, smallest id reachable)."""
    sets, holders, both = {i: shingles(t) for i, t in docs}, defaultdict(list), Counter()
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    for ids in holders.values():
        both.update((a, b) for k, a in enumerate(sorted(ids)) for b in sorted(ids)[k + 1:])
    parent = {i: i for i in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for (a, b), n in both.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((top(a), top(b)))
            parent[b] = a
    return {i: (len(s), top(i)) for i, s in sets.items()}


def check(got, docs):
    expected = brute(docs)
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got} == {
        (i, n, c, i == c) for i, (n, c) in expected.items()}


def test_op4_against_all_pairs(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    check(queries.op4_hyperminhash(spark, SF_SMALL).collect(), docs)


def test_chains_short_texts_and_shared_passages(spark):
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(4))
    docs, n = [], 100
    for _ in range(6):                                   # chains: each a few words off the one before
        words = [word() for _ in range(r.choice([8, 30, 120]))]
        for _ in range(12):
            n += r.randint(1, 9)
            docs.append((n, " ".join(words)))
            words = list(words)
            words[r.randrange(len(words))] = word()
            words.append(word())
    passage = [word() for _ in range(60)]                # half the text in common: candidates, mostly no links
    for _ in range(80):
        n += 1
        docs.append((n, " ".join(passage + [word() for _ in range(r.randint(5, 60))])))
    base = [word() for _ in range(200)]
    for _ in range(120):                                 # a large group of near copies, and of copies
        n += 1
        own = list(base)
        own[r.randrange(200)] = word()
        docs.append((n, " ".join(own if n % 2 else base)))
    r.shuffle(docs)
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in docs], DOCS).repartition(3)
    check(neardup.near_duplicates(df).collect(), docs)


def linked_pairs(texts):
    """All pairs (i, j) of texts that are linked, by the product of the incidence matrix."""
    sets = [shingles(t) for t in texts]
    column = {x: k for k, x in enumerate(set().union(*sets))}
    held = np.zeros((len(sets), len(column)), np.float32)
    for i, s in enumerate(sets):
        held[i, [column[x] for x in s]] = 1
    both, n = held @ held.T, held.sum(axis=1)
    return np.argwhere(np.triu(100 * both >= 75 * (n[:, None] + n[None, :] - both), 1))


def near_copies(n, n_words, edits, seed):
    """Copies of one text, each with 0 to ``edits`` words changed, dropped or added."""
    r = random.Random(seed)
    base = [f"w{r.randrange(500)}" for _ in range(n_words)]
    out = []
    for k in range(n):
        words = list(base)
        for _ in range(r.randrange(edits + 1)):
            at = r.randrange(len(words))
            words[at:at + 1] = r.choice([[f"x{r.randrange(10 ** 6)}"], [f"y{r.randrange(3)}"], [], [words[at], "new"]])
        out.append(" ".join(words))
    return out


def test_a_large_group_of_near_copies_around_the_limit(spark):
    texts = near_copies(3000, 150, 12, seed=2)
    parent = list(range(len(texts)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in linked_pairs(texts):
        a, b = sorted((top(a), top(b)))
        parent[b] = a
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], DOCS).repartition(4)
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(df).collect()}
    assert got == {i: top(i) for i in range(len(texts))}
    assert 50 < len(set(got.values())) < 2000                # some outside, most within


def test_prefix_pairs_hold_every_link(spark):
    texts = near_copies(150, 60, 8, seed=3) + near_copies(60, 9, 2, seed=4) + ["a b c d e f g", "a b c d e f g h"]
    members = spark.createDataFrame([(i, len(shingles(t)), t) for i, t in enumerate(texts)],
                                    "cid long, n_shingles long, text string")
    entries = neardup.prefix_entries(members, 75).selectExpr("*", "cid AS label")
    found = {(r.a, r.b) for r in neardup.prefix_pairs(entries, 75).collect()}
    same = {(i, j) for i in range(len(texts)) for j in range(i) if shingles(texts[i]) == shingles(texts[j])}
    assert {tuple(x) for x in linked_pairs(texts).tolist()} <= found | {(j, i) for i, j in same}
    # One component: nothing to look for.
    assert neardup.prefix_pairs(entries.selectExpr("band", "cid", "n", "place", "1 AS label"), 75).count() == 0


def test_odd_rows_and_pipeline_form(spark, odd_docs, no_docs):
    got = rows(neardup.near_duplicates(odd_docs).select("doc_id", "n_shingles", "component_id", "kept"))
    assert len(got) == odd_docs.count()
    by_id = defaultdict(list)
    for r in got:
        by_id[r[0]].append(r[1:])
    assert by_id[1] == [(0, 1, True)] and by_id[3] == [(0, 3, True)]
    assert by_id[5] == [(1, 5, True)] * 2 and by_id[10] == [(4, 9, False)] and by_id[13] == [(1, 12, False)]
    assert sorted(by_id[None]) == [(0, None, True), (1, None, True)]
    kept = neardup.drop_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns and kept.schema == odd_docs.schema
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in kept.collect()) == [
        (False, 0), (False, 0), *[(True, i) for i in (1, 2, 3, 4, 5, 6, 7, 8, 9, 11, 12)]]
    assert neardup.near_duplicates(no_docs).count() == 0 and neardup.drop_near_duplicates(no_docs).count() == 0


def test_one_of_each_group_stays_where_ids_are_null_or_repeated(spark):
    def near(k, word):
        return " ".join(f"{word}{i if i != k else 'changed'}" for i in range(200))
    docs = [(None, near(5 * i, "a")) for i in range(8)]                # all without an id
    docs += [(7, near(5 * i, "b")) for i in range(8)]                  # all of one id
    docs += [(9, "some other text of its own " + " ".join(f"x{i}" for i in range(50)))]
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in docs], DOCS).repartition(3)
    n = neardup.near_duplicates(df).filter("kept").count()
    kept = neardup.drop_near_duplicates(df).collect()
    assert n == 17 and sorted((r.doc_id is not None, r.doc_id or 0) for r in kept) == [(False, 0), (True, 7), (True, 9)]


def test_sketch_estimate():
    r = np.random.default_rng(2)
    for n, share in ((4000, 0.5), (4000, 0.9), (300, 0.8), (5000, 0.0)):
        x = neardup._mix(np.unique(r.integers(0, 1 << 63, 2 * n, dtype=np.uint64)))
        common = int(n * 2 * share / (1 + share))
        a, b = np.sort(x[:n]), np.sort(np.concatenate([x[:common], x[n:2 * n - common]]))
        about = neardup.estimate(neardup.sketch(a), neardup.sketch(b), len(a), len(b))
        assert abs(about - share) < 0.2
    assert 0 < neardup.chance_agreement(20, 20) < 0.01


def test_tasks_keep_little_and_forget_it_at_their_end(monkeypatch):
    """Spark's Python workers live on: what a task keeps would take the memory of later stages."""
    texts = [f"word{i} stands in text {i} and nowhere else" if i % 7 else None for i in range(1000)]
    ids = pa.array(range(1000), pa.int64())
    batch = pa.RecordBatch.from_arrays([ids, ids, ids, ids, pa.array(texts)], ["doc_id", "k1", "k2", "cid", "text"])
    at_once = []

    def seen(column, raw=common.raw_texts):
        at_once.append(len(column))
        return raw(column)

    plain = common.raw_texts(batch.column("text"))
    monkeypatch.setattr(common, "raw_texts", seen)
    sketched = pa.Table.from_batches(neardup._sketch_task(iter([batch])))
    assert sketched.column("n_shingles").to_pylist() == [len(neardup.shingle_set(t)) for t in plain]
    assert max(at_once) <= 256 and sum(at_once) == 1000
    neardup._WORDS.clear()
    for task in (neardup._sketch_task, neardup._shingle_task):
        assert list(task(iter([batch]))) and not neardup._WORDS
    pairs = pa.RecordBatch.from_arrays([ids[1:3], ids[2:4], pa.array(texts[1:3]), pa.array(texts[2:4])],
                                       ["a", "b", "t_a", "t_b"])
    assert list(neardup._verify_task(75)(iter([pairs]))) and not neardup._WORDS
    assert list(common.each_text(pa.array(texts, pa.large_string()), 10)) == plain
