"""Packing, id files, counts and chunk encoding against plain brute force."""
import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from conftest import SF_SMALL
from tokenizers import Tokenizer, models

from shelfwatch.llm import chunks, counts, idfile, packing, queries, rangecoder, vocab

from .conftest import ODD, rows

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")


def plain_ids(path, text):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def table(spark, name="documents"):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/{name}.parquet").collect()}


@pytest.mark.parametrize("path,spaced", [(BYTE, True), (WORD, False)])
def test_memoised_encoding_is_the_librarys(path, spaced, spark):
    v, r = vocab.Vocabulary(path), random.Random(3)
    texts = [t or "" for _, t in ODD] + list(table(spark).values())[:60]
    texts += ["".join(r.choice("ab 's'S\n\t1.2é– ßÀ\x1f\xa0<|") for _ in range(30)) for _ in range(400)]
    for t, got in zip(texts, v.encode_plain(texts)):
        assert v.encode(t.encode(), spaced) == got, t[:60]


def check_pieces(pieces, expected, window=1024):
    """Every id lies in exactly one piece; sequences have no gaps; little padding."""
    docs, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        docs[p.doc_id].append(p)
        sequences[p.sequence_id].append(p)
    for key, all_ids in expected.items():
        got = sorted(docs[key], key=lambda p: p.start)
        at = 0
        for p in got:
            assert (p.start, p.doc_tokens) == (at, len(all_ids)) and p.length > 0
            assert p.ids_crc32 == crc(all_ids[p.start:p.start + p.length])
            at += p.length
        assert at == len(all_ids)
    padding = 0
    for s in sequences.values():
        s.sort(key=lambda p: p.offset)
        assert [p.offset for p in s] == np.cumsum([0, *[p.length for p in s]])[:-1].tolist()
        size = sum(p.length for p in s)
        assert size <= window
        padding += window - size if size & (size - 1) else 0
    return padding


def test_op1_against_plain_tokens(spark):
    pieces = queries.op1_packing(spark, SF_SMALL).collect()
    expected = {i: plain_ids(BYTE, t) + [0] for i, t in table(spark).items()}
    padding = check_pieces(pieces, expected)
    assert padding < 0.02 * sum(map(len, expected.values()))


def test_packing_odd_rows_and_small_windows(spark, odd_docs, no_docs):
    unique = odd_docs.filter("doc_id IS NOT NULL AND doc_id <> 5")
    expected = {i: plain_ids(BYTE, t) + [0] for i, t in ODD if i not in (None, 5)}
    for window, limit in ((1024, 64), (16, 1), (7, 3)):
        check_pieces(packing.pack(unique, BYTE, window=window, open_windows=limit).collect(), expected, window)
    every = packing.pack(odd_docs, BYTE, keep_ids=True).collect()
    assert sum(p.length for p in every) == sum(len(plain_ids(BYTE, t)) + 1 for _, t in ODD)
    assert all(zlib.crc32(p.ids) == p.ids_crc32 for p in every)
    assert packing.pack(no_docs, BYTE).count() == 0


def test_best_fit_and_fullest():
    w = packing.OpenWindows(10, 2)
    assert w.place(6, "a") == [] and w.place(7, "b") == []       # free: 4, 3
    assert w.place(3, "c") == [["b", "c"]]                       # fits b exactly
    assert w.place(8, "d") == []
    assert w.place(5, "e") == [["d"]]                            # none fits: the fullest goes
    assert sorted(map(tuple, w.rest())) == [("a",), ("e",)]


def test_op2_against_plain_tokens(spark):
    at, expected = 0, []
    for i, t in sorted(table(spark).items()):
        ids = plain_ids(WORD, t) + [1]
        expected.append((i, at, len(ids), crc(ids)))
        at += len(ids)
    assert rows(queries.op2_range_coded_ids(spark, SF_SMALL)) == expected


def test_id_files_of_odd_rows(spark, odd_docs, no_docs, tmp_root):
    idfile.write_ids(odd_docs, f"{tmp_root}/a", WORD)
    got = sorted(idfile.document_digests(spark, f"{tmp_root}/a").collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((i for i, _ in ODD), key=lambda i: (i is not None, i or 0))
    assert got[0].start == 0 and all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:]))
    expected = {(i, len(x), crc(x)) for i, x in ((i, plain_ids(WORD, t) + [1]) for i, t in ODD)}
    assert {(r.doc_id, r.n_tokens, r.ids_crc32) for r in got} == expected
    assert idfile.read_pieces(spark, f"{tmp_root}/a").filter("doc_id = 4").count() > 2     # cut over blocks
    idfile.write_ids(no_docs, f"{tmp_root}/b", WORD)
    assert idfile.document_digests(spark, f"{tmp_root}/b").count() == 0


def test_range_coder_round_trip_and_damage():
    r = np.random.default_rng(1)
    blocks = [np.array(x, np.uint32) for x in (
        [], [5], [7] * 5000, list(range(3000)), [0, 49407] * 3, r.integers(0, 1 << 32, 700),
        r.zipf(1.3, 4096) % 50000, [1, 2, 3] * 1000 + [9])]
    payloads = rangecoder.encode_blocks(blocks, [str(k).encode() for k in range(len(blocks))])
    got, tables = rangecoder.decode_blocks(payloads)
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(got, blocks))
    assert tables == [str(k).encode() for k in range(len(blocks))]
    assert len(payloads[2]) < 300 and len(payloads[7]) < 300                # learnt patterns are cheap
    alone, _ = rangecoder.decode_blocks(payloads[6:7])                      # blocks don't need each other
    assert (alone[0] == blocks[6]).all()
    for at in (0, 30, len(payloads[6]) // 2, len(payloads[6]) - 1):
        bad = bytearray(payloads[6])
        bad[at] ^= 1
        with pytest.raises(rangecoder.Corrupt):
            rangecoder.decode_blocks([bytes(bad)])


def test_coded_ids_are_smaller_than_deflated_ones(spark):
    """Bits an id of the coder, dictionaries included, against deflate of the same blocks as 16-bit numbers."""
    ids = [np.array(plain_ids(WORD, t), np.uint32) for t in list(table(spark).values())[:150]]
    stream = np.concatenate(ids)
    blocks = [stream[k:k + idfile.BLOCK_IDS] for k in range(0, len(stream), idfile.BLOCK_IDS)]
    coded = sum(map(len, rangecoder.encode_blocks(blocks, [b""] * len(blocks))))
    deflated = sum(len(zlib.compress(b.astype("<u2").tobytes(), 6)) for b in blocks)
    print(f"{8 * coded / len(stream):.2f} bits an id, deflate {8 * deflated / len(stream):.2f}")
    assert coded < deflated
    with pytest.raises(ValueError, match="different ids"):
        rangecoder.encode_blocks([np.arange(rangecoder.MOST_IDS + 1, dtype=np.uint32)], [b""])


def test_crc_join():
    for a, b in ((b"", b"xy"), (b"abc", b""), (b"hello ", b"world" * 99)):
        assert idfile.crc32_join(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def test_op3_against_the_librarys_unigram_model(spark):
    tk = Tokenizer(models.Unigram(counts.sentencepiece_vocabulary(PIECE), 0, True))
    texts, score = table(spark), dict(counts.sentencepiece_vocabulary(PIECE))
    lowest, found = min(score.values()), rows(queries.op3_token_counts(spark, SF_SMALL))
    assert len(found) == len(texts)
    for i, n, best in found:
        t = texts[i]
        tokens = tk.encode(counts.BLANK + t.replace(" ", counts.BLANK)).tokens if t else []
        assert n == len(tokens)
        if all(x in score and not x.startswith("<0x") for x in tokens):       # byte pieces stand for unknown characters
            assert best == sum(score[x] for x in tokens) and best >= lowest * max(n, 1)


def _best_path(text, pieces):
    """Highest score over all ways to cut a text into pieces, each tried."""
    score, lowest = {}, min(s for _, s in pieces)
    for p, s in pieces:
        score.setdefault(p, s)
    best = [0.0] + [None] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(end):
            s = score.get(text[start:end], lowest - counts.UNK_PENALTY if end - start == 1 else None)
            if s is not None and best[start] is not None and (best[end] is None or best[start] + s > best[end]):
                best[end] = best[start] + s
    return best[-1]


def test_counts_of_odd_rows_and_ties(spark, odd_docs, no_docs):
    got = token_rows = [(r.doc_id, r.n_tokens) for r in counts.token_counts(odd_docs, PIECE).collect()]
    assert len(token_rows) == len(ODD) and (1, 0) in got and (2, 0) in got and got.count((5, got[0][1])) in (0, 2)
    assert counts.token_counts(no_docs, PIECE).count() == 0
    pieces = [("<unk>", 0.0), ("a", -2.0), ("b", -2.0), ("ab", -4.0), ("ba", -4.0), ("aba", -6.0), ("▁", -1.0),
              ("c▁", -3.5)]
    mine, tk, r = counts.UnigramCounter(pieces), Tokenizer(models.Unigram(pieces, 0, False)), random.Random(1)
    for _ in range(500):
        s = "".join(r.choice("abcx▁y") for _ in range(r.randint(1, 12)))
        n, best = mine(s)
        assert n == len(tk.encode(counts.BLANK + s).ids) and best == _best_path(counts.BLANK + s, pieces)


def sha(x):
    return hashlib.sha256(x).hexdigest()


def test_op9_against_the_library(spark):
    tk = Tokenizer.from_file(WORD)
    expected = {}
    for i, t in table(spark).items():
        ids = plain_ids(WORD, t)
        expected[i] = (i, len(ids), sha(np.array(ids, "<u4").tobytes()),
                       sha(tk.decode(ids, skip_special_tokens=False).encode()))
    assert rows(queries.op9_chunk_bpe(spark, SF_SMALL)) == sorted(expected.values())


def test_chunk_encoding_of_odd_rows(odd_docs, no_docs):
    tk = Tokenizer.from_file(WORD)
    got = chunks.chunk_encode(odd_docs, WORD).collect()
    expected = {(i, np.array(plain_ids(WORD, t), "<u4").tobytes(),
                 tk.decode(plain_ids(WORD, t), skip_special_tokens=False)) for i, t in ODD}
    assert {(r.doc_id, bytes(r.ids), r.decoded) for r in got} == expected and len(got) == len(ODD)
    assert chunks.chunk_encode(no_docs, WORD).count() == 0


def test_chunks_are_shared_and_cover_the_text():
    r = random.Random(5)
    words = ["".join(r.choice("abcdé") for _ in range(6)) for _ in range(4000)]
    passage = " ".join(words).encode()
    a, b = b"first " + passage, b"quite another start " * 9 + passage
    assert b"".join(chunks.chunks_of(a)) == a and b"".join(chunks.chunks_of(b)) == b
    shared = set(chunks.chunks_of(a)) & set(chunks.chunks_of(b))
    assert sum(map(len, shared)) > 0.95 * len(passage)
    encoder = chunks.ChunkEncoder(vocab.Vocabulary(WORD))
    encoder.encode(a)
    before = encoder.encoded
    encoder.encode(b)
    assert encoder.encoded - before < 0.1 * before        # the passage was encoded once
