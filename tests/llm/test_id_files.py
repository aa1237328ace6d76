"""Id files: texts are encoded by columns, blocks coded in streams, checksums joined by xor."""
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from shelfwatch.llm import idfile, rangecoder, vocab, wordids

WORD = public_tokenizers.path("word_bpe_49k.json")


def library_ids(texts):
    tokenizer = Tokenizer.from_file(WORD)
    return [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("slice_bytes,memo", [(12_000_000, 250_000), (300, 40)])
def test_columns_are_encoded_as_the_library_does(slice_bytes, memo, monkeypatch):
    monkeypatch.setattr(wordids, "SLICE_BYTES", slice_bytes)
    monkeypatch.setattr(wordids, "MEMO_WORDS", memo)
    monkeypatch.setattr(wordids, "_ENCODERS", {})
    r = random.Random(7)
    texts = ["", "'s", "'", "a'", "'l", "l", "'r", "e", "x<|endoftext|>y", "it's they'LL !'s 5's 've'd", "\x00a", "é",
             "ÀÞß ×÷ Ω", "<|startoftext|>"]
    for alphabet in ("ab 's'S\n\t1.2é– ßÀ\x1f\xa0<|", "'stmdrevl x1.'é", "ÀÞß×÷ÿÖ ax°§²€…™ ", " \n\r\t"):
        texts += ["".join(r.choice(alphabet) for _ in range(r.randrange(12))) for _ in range(500)]
    r.shuffle(texts)
    assert list(wordids.encode_texts(WORD, pa.array(texts), False)) == library_ids(texts)
    cut = pa.array([None, "gone", None, *texts], pa.large_string())[2:]     # an offset, nulls, wide offsets
    assert list(wordids.encode_texts(WORD, cut, False)) == library_ids(["", *texts])
    assert list(wordids.encode_texts(WORD, pa.array([], pa.string()), False)) == []


def test_plain_texts_of_a_column_are_not_encoded_one_by_one(monkeypatch):
    asked = []
    encode = vocab.Vocabulary.encode
    monkeypatch.setattr(vocab.Vocabulary, "encode", lambda self, text, spaced: asked.append(text) or encode(self, text, spaced))
    texts = [f"Ein Text, it's n° {k}: élan vital…" for k in range(300)] + ["Ω"]
    assert list(wordids.encode_texts(WORD, pa.array(texts), False)) == library_ids(texts)
    assert asked == ["Ω".encode()]


def test_blocks_are_coded_in_few_steps():
    """A block of 4096 ids took 4096 steps of the model on each side."""
    assert rangecoder._Lanes([idfile.BLOCK_IDS] * 3).steps <= 256
    r = np.random.default_rng(3)
    blocks = [r.zipf(1.4, n).astype(np.uint32) % 40_000 for n in (1, 2, 127, 128, 129, 255, 256, 1000, 4095, 4096, 4097)]
    blocks += [r.permutation(20_000).astype(np.uint32), r.integers(0, 1 << 32, 5000, dtype=np.uint32),
               np.full(70_000, 9, np.uint32), np.zeros(0, np.uint32)]
    payloads = rangecoder.encode_blocks(blocks, [b"t"] * len(blocks))
    together, _ = rangecoder.decode_blocks(payloads)
    alone = [rangecoder.decode_blocks([p])[0][0] for p in payloads]
    assert all((a == b).all() and (a == c).all() and len(a) == len(b) == len(c)
               for a, b, c in zip(blocks, together, alone))
    assert rangecoder.encode_blocks(blocks[8:9], [b"t"]) == payloads[8:9]         # whatever is coded beside it


def test_carries_run_through_written_words():
    r = np.random.default_rng(11)
    blocks = [r.integers(0, k, 4096).astype(np.uint32) for k in [2, 3, 300, 4000] * 30]
    got, _ = rangecoder.decode_blocks(rangecoder.encode_blocks(blocks, [b""] * len(blocks)))
    assert all((a == b).all() for a, b in zip(blocks, got))
    words = np.array([7, 0xFFFFFFFF, 0xFFFFFFFF, 5, 0xFFFFFFFE], np.uint32)
    rangecoder._carry(words, np.array([2, 4]))
    assert words.tolist() == [8, 0, 0, 5, 0xFFFFFFFF]


def test_checksums_of_pieces_join_by_xor():
    r = random.Random(2)
    data = r.randbytes(70_000)
    cuts = sorted(r.sample(range(1, len(data)), 400))
    parts = [data[a:b] for a, b in zip([0, *cuts], [*cuts, len(data)])]
    behind = len(data) - np.cumsum([len(p) for p in parts])
    idfile._crc_shift.cache_clear()
    idfile._crc_power.cache_clear()
    moved = idfile.crc32_moved(np.array([zlib.crc32(p) for p in parts]), behind)
    assert np.bitwise_xor.reduce(moved) == zlib.crc32(data)
    assert idfile._crc_shift.cache_info().misses <= 17       # one matrix a power of two, not one a length
    assert len(idfile.crc32_moved(np.zeros(0, np.int64), np.zeros(0, np.int64))) == 0
