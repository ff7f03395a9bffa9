"""Packing against the tokenizer's own ids."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from palimpsest.llm import packing


def packed(df, **kw):
    return packing.pack(df, P.path("byte_bpe_50k.tiktoken"), P.PATTERN, P.path("byte_bpe_50k.json"), **kw).collect()


def check(df, got, most=2048):
    coder = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    ids = defaultdict(list)
    for r in df.collect():
        ids[r.doc_id].append(coder.encode(r.text or "", add_special_tokens=False).ids + [1])
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(ids)
    for i, own in pieces.items():
        if len(ids[i]) > 1:
            continue
        want, at = np.array(ids[i][0], "<u4"), 0
        for r in sorted(own, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(want) and r.ids_crc32 == zlib.crc32(want[at : at + r.length].tobytes())
            at += r.length
        assert at == len(want)
    used = padded = 0
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= most
        used, padded = used + at, padded + (at if at & (at - 1) == 0 else most)
    return used, padded, sequences


def test_packing(docs, edge, empty):
    used, padded, _ = check(docs, packed(docs))
    assert used == padded
    check(edge, packed(edge))
    assert packed(empty) == []


def test_limits_hold(docs):
    got = packed(docs, max_tokens=512, max_pieces=3)
    used, padded, sequences = check(docs, got, 512)
    assert max(map(len, sequences.values())) <= 3 and padded < 1.1 * used


def test_loss_limit(docs):
    from pyspark.sql import functions as F

    df = docs.withColumn("bears", F.col("doc_id") % 2 == 0)
    got = packed(df, loss_col="bears", max_tokens=1024, max_loss=600)
    _, _, sequences = check(df, got, 1024)
    for own in sequences.values():
        assert sum(r.length for r in own if r.doc_id % 2 == 0) <= 600


def test_random_limits_hold():
    """Tails above all: any mix of lengths under limits that bind alone or together keeps them, and every token lies in one piece."""
    rng = np.random.default_rng(5)
    for _ in range(120):
        most, pieces, loss = int(rng.integers(16, 2048)), int(rng.integers(1, 9)), int(rng.integers(8, 2048))
        packer, lengths, bears = packing.Packer(0, most, pieces, loss), rng.integers(1, 700, int(rng.integers(0, 40))), rng.random(40) < rng.random()
        for n, length in enumerate(lengths):
            packer.add(n, np.full(length, n, "<u4"), bool(bears[n]))
        packer.fill(0)
        seen, sequences = defaultdict(int), defaultdict(list)
        for row, start, length, _, _, sequence, offset, _ in packer.out:
            assert length > 0
            seen[row] += length
            sequences[sequence].append((offset, length, bears[row]))
        assert [seen[n] for n in range(len(lengths))] == list(lengths)
        for own in sequences.values():
            own.sort()
            assert [o for o, _, _ in own] == [sum(x for _, x, _ in own[:i]) for i in range(len(own))]
            assert sum(x for _, x, _ in own) <= most and len(own) <= pieces and sum(x for _, x, b in own if b) <= loss


def test_tail_keeps_the_loss_limit():
    packer = packing.Packer(0, 2048, 256, 512)
    for n in range(4):
        packer.add(n, np.zeros(400, "<u4"), True)
    packer.fill(0)
    sums = defaultdict(int)
    for _, _, length, _, _, sequence, _, _ in packer.out:
        sums[sequence] += length
    assert max(sums.values()) <= 512 and sum(sums.values()) == 1600


def padding(packer):
    sums = defaultdict(int)
    for _, _, length, _, _, sequence, _, _ in packer.out:
        sums[sequence] += length
    most = int(packer.limits[0])
    return sum(n if n & (n - 1) == 0 else most for n in sums.values()) / sum(sums.values())


def test_tiny_examples_need_little_padding():
    """The limit of pieces closes a sequence at a power of two, in the stream and in its tail."""
    for tokens in range(1, 11):
        for many in (100, 700, 20_000):
            packer = packing.Packer(0)
            for n in range(many):
                packer.add(n, np.full(tokens, n, "<u4"), True)
            packer.fill(0)
            assert padding(packer) == 1 and sum(p[2] for p in packer.out) == tokens * many
    rng, packer = np.random.default_rng(1), packing.Packer(0, 2048, 256, 700)
    for n, tokens in enumerate(rng.integers(1, 40, 5000)):
        packer.add(n, np.full(tokens, n, "<u4"), bool(n % 3))
    packer.fill(0)
    assert padding(packer) < 1.1


def test_long_runs_of_blanks(spark):
    """Texts on which the fast encoder gives up are encoded by the library."""
    texts = [" " * 1_000_000, "a" + "\n" * 2_000_000 + "b", "x " + "\t" * 5_000_000, "-" * 1_500_000, " \n" * 600_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    used, padded, _ = check(df, packed(df))
    assert padded < 1.1 * used
