"""Ids against the tiktoken and tokenizers libraries, round trips, chunk edges."""

import functools
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from costlake.llm import bpe, packing

RANKS, JSON = P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_50k.json")


def corpus():
    rng = random.Random(3)
    words = ["the", "Ünï", "it's", "we'll", "'re", "  ", "\n", "\t\n ", "123", "4.5", "!!!", "日本語", "a" * 300, "x", "<|endoftext|>", " ", "🙂", "thndedble", "é"]
    out = ["", None, " ", "\n\n  a", "a \nb", "foo\n bar", " lead", "trail ", "a  b"]
    for n in (5, 40, 400, 3000):
        for _ in range(12):
            out.append(rng.choice(["", " "]).join(rng.choice(words) + rng.choice([" ", " ", "", "\n"]) for _ in range(n)))
    return out


def expected(t):
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})
    return enc.encode_ordinary(t or "")


@pytest.mark.parametrize("chunk,overlap", [(64, 16), (1000, 200), (bpe.CHUNK, bpe.OVERLAP)])
def test_encode_as_library(spark, chunk, overlap):
    texts = corpus()
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)] + [(len(texts) - 1, texts[-1], "en")], "doc_id long, text string, ids string")
    out = bpe.encode(df, RANKS, P.PATTERN, chunk, overlap).collect()
    assert len(out) == len(texts) + 1
    enc = bpe.Encoder(RANKS, P.PATTERN)
    for r in out:
        assert np.frombuffer(r["ids"], "<u4").tolist() == expected(texts[r["doc_id"]]), r["doc_id"]
        assert enc.decode(bytes(r["ids"])) == (texts[r["doc_id"]] or "").encode()


def test_long_pre_tokens():
    ranks = bpe.load_ranks(RANKS)
    rng = random.Random(1)
    for n in (129, 500, 5000):
        piece = "".join(rng.choice("abeéth") for _ in range(n))
        assert bpe.merge(piece.encode(), ranks) == expected(piece)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encode(df, RANKS, P.PATTERN).count() == 0
    assert packing.pack(df, JSON).count() == 0


@functools.cache
def file_tokenizer():
    return Tokenizer.from_file(JSON)


def file_ids(t):
    return file_tokenizer().encode(t or "", add_special_tokens=False).ids


def test_packing_ids_as_tokenizers():
    mixed = ["<|endoftext|>", "a<|endoftext|>b", "x <|endoftext|> y <|endoftext|><|endoftext|>", "<|endoftext", " <|endoftext|>\n\n<|END|> <|endoftext|>  z", "one two <|endoftext|>three"]
    for t in [*corpus(), *mixed]:
        assert np.frombuffer(packing.packed_ids(t or "", JSON), "<u4").tolist() == file_ids(t)
    assert 50256 in file_ids(mixed[0])


def test_packing_whole_and_gapless(spark):
    import zlib

    texts = corpus() * 3
    rows = [(i % 40, t, 1) for i, t in enumerate(texts)]
    out = packing.pack(spark.createDataFrame(rows, "doc_id long, text string, length int"), JSON, open_bins=4).collect()
    lengths = sorted(n for _, t, _ in rows for _, n in packing.cut(len(file_ids(t)) + 1))
    assert sorted(r["length"] for r in out) == lengths
    crc = sorted(zlib.crc32((np.array([*file_ids(t), 0], "<u4")[s : s + n]).tobytes()) for _, t, _ in rows for s, n in packing.cut(len(file_ids(t)) + 1))
    assert sorted(r["ids_crc32"] for r in out) == crc
    by = {}
    for r in out:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for off, n in sorted(parts):
            assert off == at
            at += n
        assert at <= packing.SIZE


def test_bins_best_fit_and_fullest_closes():
    b = packing.Bins(10, 2)
    assert [b.place(n) for n in (6, 7, 3, 4)] == [(0, 0), (1, 0), (1, 7), (0, 6)]
    b = packing.Bins(10, 2)
    assert [b.place(n)[0] for n in (6, 7, 8, 3)] == [0, 1, 2, 0]  # the third opening closed bin 1 (7 of 10)
