"""SimHash near-duplicates through an inverted index of positional bytes with count filtering.

A fingerprint is a row of bytes. Two of eight bytes that differ in at most three bits share at least five bytes at their positions. Postings of single bytes would hold 1/256 of
all fingerprints each, and pairing them up is quadratic; so postings are banded: a key is four positional bytes at once. Of any five positions four make one of 14 choices
(BLOCKS), so every pair to be linked meets in a posting. There the shared positional bytes of each pair are tallied, pairs with the guaranteed five are retained, and their bits
are compared. A posting holds distinct fingerprints that agree in 32 of 64 bits: of N random ones N / 2^32.

Where a plan has a least similarity, fingerprints only propose pairs. Postings are those of single positional bytes; a posting's task pairs up what shares a second byte and
has numbers of shingles that allow the similarity. Every pair is then held against the shingle sets themselves. In dense postings each row is held against a bounded number of others,
which links large groups of near copies by few pairs; rows that were not held against all go through an exact search by prefix filtering over their shingles (_rest). Of large inputs those
are all rows, so the search shuffles 24 bytes for a shingle of a prefix, a fifth of all, and sets of shingles are made and shuffled for proposed pairs only.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.common import stored, text_of
from palimpsest.llm.components import connected


@dataclass(frozen=True)
class Plan:
    """words: of a shingle. longs: 64-bit parts of a fingerprint. min_shared: positional bytes that linked fingerprints share at least.
    max_bits: that may differ, max_bits_small where a set has fewer than SMALL_SET shingles. min_similarity: if above 0, the Jaccard similarity that the shingle sets of linked rows have at least.
    by_prefix: pairs are not proposed by fingerprints, but all come from the exact search by prefix filtering (_rest)."""

    words: int
    longs: int
    min_shared: int
    max_bits: int
    max_bits_small: int = 0
    min_similarity: float = 0.0
    by_prefix: bool = False

    @property
    def columns(self) -> list[str]:
        return [f"f{i}" for i in range(self.longs)]


def blocks() -> list[tuple[int, ...]]:
    """Choices of four of eight positions such that any five positions contain one: both halves, and two of each half where the pairs are of like matchings."""
    halves = [((0, 1), (2, 3)), ((0, 2), (1, 3)), ((0, 3), (1, 2))]
    return [(0, 1, 2, 3), (4, 5, 6, 7)] + [(*p, *(4 + x for x in q)) for matching in halves for p in matching for q in matching]


BLOCKS = blocks()
#: Exact: three-word shingles, 64 bits of which three may differ.
EXACT = Plan(words=3, longs=1, min_shared=5, max_bits=3)
#: Near copies of a similarity of 0.8 on five-word shingles: sets with that Jaccard similarity differ in 15 % of the bits (48 of 320, give or take 6; a set of four in one of
#: five in 19 %), unrelated ones in half. By that model one such pair in 20,000 shares fewer than two of the 40 bytes (of four in five: one in 400), and one in 50,000 differs in more than 76 bits.
NEAR = Plan(words=5, longs=5, min_shared=2, max_bits=76, max_bits_small=92, min_similarity=0.8)
#: The same links, all of them by the exact search: no pair is lost, and each set's prefix of shingles is shuffled instead of 40 bytes.
PREFIX = replace(NEAR, by_prefix=True)
SMALL_SET = 40
#: A row is held against so many rows under each pair of bytes, and so many of its best partners of each posting are proposed; rows with more go on to the exact search over shingles.
LOOKS, PARTNERS = 64, 1
SEED = 42
#: After so many comparisons of each row, and every time that number has doubled, postings that are one component already are done.
FIRST_LOOK = 64
#: Slots for counting how many sets hold shingles, as a power of two: four megabytes.
SLOT_BITS = 20
#: Those slots are summed in so many blocks.
SLOT_BLOCKS = 64
#: Bits of the table that lets the rows wanted (and a few others) pass without a shuffle, as a power of two: two megabytes.
MARK_BITS = 24
#: Shingles of prefixes that a task takes in, about.
PREFIX_PART = 2_000_000
#: A posting of more fingerprints is searched in parts.
LONG_POSTING = 2048
#: Links are thinned to a spanning forest beyond so many.
MANY_LINKS = 500_000


def shingle_hashes(text: str, k: int) -> list[int]:
    """XXH64 of every k-word shingle, repeats included; A-Z lower-cased, words split at blanks; a shorter text is one shingle, one without words has none."""
    words = text.encode().lower().split()
    if not words:
        return []
    joined, of = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= k:
        return [of(joined, SEED)]
    ends = (np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1).tolist()
    starts = [0, *(e + 1 for e in ends)]
    return [of(joined[s:e], SEED) for s, e in zip(starts, ends[k - 1 :])]


def shingle_set(hashes: list[int]) -> np.ndarray:
    return np.unique(np.array(hashes, np.uint64)).view(np.int64)


def set_hash(shingles: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(shingles.tobytes(), SEED)).astype(np.int64))


def simhash(hashes: list[int] | np.ndarray, longs: int = 1) -> np.ndarray:
    """A bit is 1 if it is set in over half of the hashes; further parts take the hashes mixed once more each."""
    if not len(hashes):
        return np.zeros(longs, np.uint64)
    h, out = np.array(hashes, np.uint64), []
    for _ in range(longs):
        ones = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
        out.append(np.packbits(ones * 2 > len(h), bitorder="little").view(np.uint64)[0])
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return np.array(out, np.uint64)


def fingerprints(docs: DataFrame, plan: Plan = EXACT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, text_hash, f0 .. (longs, the fingerprint's bits), n (distinct shingles), shingles (hash of their set); a text without words or null has fingerprint zero.

    Where similarity of sets counts, bits are those of the distinct shingles, else repeats count."""
    cols = plan.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            hashes = [shingle_hashes(t, plan.words) for t in b.pop("_text")]
            sets = [shingle_set(h) for h in hashes]
            got = np.array([simhash(h, plan.longs) for h in ([s.view(np.uint64) for s in sets] if plan.min_similarity else hashes)], np.uint64).reshape(-1, plan.longs).view(np.int64)
            for i, c in enumerate(cols):
                b[c] = got[:, i]
            b["n"] = np.fromiter(map(len, sets), np.int64, len(sets))
            b["shingles"] = np.fromiter(map(set_hash, sets), np.int64, len(sets))
            yield b

    rows = docs.select(id_col, text_of(text_col).alias("_text")).withColumn("text_hash", F.xxhash64("_text"))
    return rows.mapInPandas(run, f"`{id_col}` {dict(docs.dtypes)[id_col]}, text_hash long, " + ", ".join(f"{c} long" for c in [*cols, "n", "shingles"]))


def _keys() -> Column:
    """One hash for each block of positions. Hashes that meet by chance cost a comparison and can't make a link."""
    masks = [sum(0xFF << 8 * p for p in block) for block in BLOCKS]
    return F.array(*(F.xxhash64(F.lit(n), F.col("f0").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m))) for n, m in enumerate(masks)))


class Links:
    """Pairs of fingerprints, kept as a spanning forest: what matters is who reaches whom."""

    def __init__(self):
        self.parts, self.n = [], 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        if len(a):
            self.parts.append((a, b))
            self.n += len(a)
            if self.n > MANY_LINKS:
                self.thin()

    def thin(self) -> tuple[np.ndarray, np.ndarray]:
        """Each fingerprint of any link but the least of its component, with that."""
        if not self.parts:
            return (np.zeros(0, np.uint64),) * 2
        a, b = (np.concatenate(x) for x in zip(*self.parts))
        nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        u, v = at[: len(a)], at[len(a) :]
        label = np.arange(len(nodes))
        while True:
            low = np.minimum(label[u], label[v])
            new = label.copy()
            for x in (u, v, label[u], label[v]):
                np.minimum.at(new, x, low)
            new = new[new]
            if (new == label).all():
                break
            label = new
        far = np.flatnonzero(label != np.arange(len(nodes)))
        out = nodes[far], nodes[label[far]]
        self.parts, self.n = [out], len(far)
        return out

    def labels(self, f: np.ndarray) -> np.ndarray:
        """The least fingerprint of each one's component, as far as it is known."""
        a, b = self.thin()
        at = np.minimum(np.searchsorted(a, f), max(0, len(a) - 1))
        return np.where(a[at] == f, b[at], f) if len(a) else f


def _linked(x: np.ndarray, plan: Plan) -> np.ndarray:
    """Of pairs, given where their bits differ: tally the shared positional bytes, then count the bits of those with the guaranteed number."""
    maybe = (x.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1) >= plan.min_shared
    maybe[maybe] = np.bitwise_count(x[maybe]) <= plan.max_bits
    return maybe


def _search(key: np.ndarray, f: np.ndarray, plan: Plan, links: Links) -> None:
    """Links within postings, which are runs of equal keys. A long posting is searched in parts.

    Its fingerprints agree in some bytes; the bits of the others are cut into one block more than bits may differ, so those of a pair to be linked agree in one of the blocks, and only such are held
    against each other: for four other bytes a 256th of all pairs for each block.
    """
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    lengths = np.diff(np.r_[starts, len(key)])
    short = np.repeat(lengths <= LONG_POSTING, lengths)
    if short.any():
        _held(key[short], f[short], plan, links)
    for a, n in zip(starts[lengths > LONG_POSTING], lengths[lengths > LONG_POSTING]):
        own = f[a : a + n]
        places = [p for p in range(8) if ((own ^ own[0]) >> np.uint64(8 * p) & np.uint64(255)).any()]
        value = np.zeros(n, np.uint64)
        for i, p in enumerate(places):
            value |= (own >> np.uint64(8 * p) & np.uint64(255)) << np.uint64(8 * i)
        bits, parts = 8 * len(places), plan.max_bits + 1
        cuts = [bits * k // parts for k in range(parts + 1)]
        for low, high in zip(cuts[:-1], cuts[1:]):
            block = value >> np.uint64(low) & np.uint64((1 << (high - low)) - 1)
            order = np.argsort(block, kind="stable")
            _held(block[order], own[order], plan, links)


def _held(key: np.ndarray, f: np.ndarray, plan: Plan, links: Links) -> None:
    """Links within runs of equal keys: each row is held against the next, the second next .. to the end of its run."""
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    lengths = np.diff(np.r_[starts, len(key)])
    posting = np.repeat(np.arange(len(starts)), lengths)
    left = np.repeat(starts + lengths, lengths) - np.arange(len(key)) - 1
    at, shift, look = np.flatnonzero(left > 0), 1, FIRST_LOOK
    while len(at):
        for i in range(0, len(at), 1_000_000):
            some = at[i : i + 1_000_000]
            hit = some[_linked(f[some] ^ f[some + shift], plan)]
            links.add(f[hit], f[hit + shift])
        shift += 1
        at = at[left[at] >= shift]
        if shift == look and len(at):
            look *= 2
            label = links.labels(f)
            apart = np.maximum.reduceat(label, starts) != np.minimum.reduceat(label, starts)
            at = at[apart[posting[at]]]


def _postings(batches: Iterator[pd.DataFrame], plan: Plan) -> Iterator[pd.DataFrame]:
    """Rows come sorted by key, so a posting is a run; a run that a batch leaves open is carried on."""
    links, rest_key, rest = Links(), [], []
    for b in batches:
        key, f = b["key"].to_numpy(), b["f0"].to_numpy(np.int64).view(np.uint64)
        if not len(key):
            continue
        cut_at = int(np.searchsorted(key, key[-1]))
        if cut_at == 0 and rest_key and rest_key[-1][-1] == key[0]:
            rest_key.append(key)
            rest.append(f)
            continue
        if rest_key or cut_at:
            _search(np.concatenate([*rest_key, key[:cut_at]]), np.concatenate([*rest, f[:cut_at]]), plan, links)
        rest_key, rest = [key[cut_at:]], [f[cut_at:]]
    if rest_key:
        _search(np.concatenate(rest_key), np.concatenate(rest), plan, links)
    a, b = links.thin()
    yield pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})


def _runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Whole postings of rows that come sorted by key."""
    rest: list[pd.DataFrame] = []
    for b in batches:
        key = b["key"].to_numpy()
        if not len(key):
            continue
        ends = np.r_[np.flatnonzero(key[1:] != key[:-1]) + 1, len(key)]
        start = 0
        for end in ends:
            if rest and rest[0]["key"].iat[0] != key[start]:
                yield pd.concat(rest) if len(rest) > 1 else rest[0]
                rest = []
            rest.append(b.iloc[start:end])
            start = end
    if rest:
        yield pd.concat(rest) if len(rest) > 1 else rest[0]


def _partners(batches: Iterator[pd.DataFrame], plan: Plan) -> Iterator[pd.DataFrame]:
    """Pairs (a, b) of class hashes that share the posting's byte and a second one as the first two of all they share, so that each pair comes once.

    Under each second byte rows are held against the next LOOKS, in the order of the bytes behind it. Of each posting a pair is proposed that is among the PARTNERS with the fewest
    differing bits of either row. A row with a pair left out comes as (a, null). Second bytes with rows not looked at come as bits, in one row (key, null, bits) of the posting (_open).
    """
    width = 8 * plan.longs
    for posting in _runs(batches):
        at_byte = int(posting["key"].iat[0]) >> 8
        n, name = (posting[c].to_numpy(np.int64) for c in ("n", "shingles"))
        f = np.ascontiguousarray(posting[plan.columns].to_numpy(np.int64)).view(np.uint64)
        raw, m = f.view(np.uint8).T, len(f)
        if m < 2:
            continue
        open_rows, open_seconds, held = np.zeros(m, bool), np.zeros(256 * width, bool), [np.zeros((3, 0), np.int64)]

        def best() -> np.ndarray:
            """Of the pairs held the best of each row; rows of the others stay open."""
            i, j, bits = pairs = np.concatenate(held, axis=1)
            keep = np.zeros(len(i), bool)
            for side in (i, j):
                order = np.lexsort((bits, side))
                starts = np.flatnonzero(np.r_[True, side[order][1:] != side[order][:-1]]) if len(order) else order
                rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
                keep[order[rank < PARTNERS]] = True
            open_rows[i[~keep]] = open_rows[j[~keep]] = True
            return pairs[:, keep]

        step = max(1, 1_000_000 // m)
        for q in range(at_byte + 1, width, step):
            second = np.arange(q, min(q + step, width))
            behind = [raw[(second + k) % width].astype(np.int64) for k in range(3)]
            place = behind[0] << 16 | behind[1] << 8 | behind[2]
            row = np.argsort(place, axis=1, kind="stable")
            place = (np.take_along_axis(place, row, axis=1) + (np.arange(len(second))[:, None] << 24)).reshape(-1)
            row, at_second = row.reshape(-1), np.repeat(second, m)
            end, here = np.searchsorted(place >> 16, place >> 16, "right"), np.arange(len(row))
            far = np.flatnonzero(end > here + 1 + LOOKS)
            open_seconds[256 * q + np.unique(place[far] >> 16)] = True
            for shift in range(1, LOOKS + 1):
                at = np.flatnonzero(here + shift < end)
                if not len(at):
                    break
                i, j = row[at], row[at + shift]
                x = f[i] ^ f[j]
                bits, less = np.bitwise_count(x).sum(axis=1, dtype=np.int64), np.minimum(n[i], n[j])
                ok = (bits <= np.where(less < SMALL_SET, plan.max_bits_small, plan.max_bits)) & (less >= plan.min_similarity * np.maximum(n[i], n[j]) - 1e-9)
                if ok.any():  # tally the positional bytes shared up to the second one
                    same = np.ascontiguousarray(x[ok]).view(np.uint8) == 0
                    new = (same & (np.arange(width) < at_second[at][ok][:, None])).sum(axis=1) == plan.min_shared - 1
                    held.append(np.stack([i[ok][new], j[ok][new], bits[ok][new]]))
            if sum(h.shape[1] for h in held) > 2_000_000:
                held = [best()]
        i, j, _ = best()
        if len(i):
            yield pd.DataFrame({"a": np.minimum(name[i], name[j]), "b": pd.array(np.maximum(name[i], name[j]), "Int64"), "seconds": None})
        again = np.flatnonzero(open_rows)
        if len(again):
            yield pd.DataFrame({"a": name[again], "b": pd.array([None] * len(again), "Int64"), "seconds": None})
        if open_seconds.any():
            yield pd.DataFrame({"a": posting["key"].iloc[:1].astype("int64"), "b": pd.array([None], "Int64"), "seconds": [np.packbits(open_seconds, bitorder="little").tobytes()]})


def _open(found: DataFrame, classes: DataFrame, plan: Plan) -> DataFrame:
    """Stored: shingles of the classes that were not held against all others. Pairs of bytes with too many rows are bits of a table of fixed size, 13 MB at most, so marking their rows takes no shuffle."""
    dense, width = found.filter("seconds IS NOT NULL").select("a", "seconds").toArrow(), 8 * plan.longs
    at = np.full(256 * width, -1)
    at[dense["a"].to_numpy()] = np.arange(len(dense))
    table = classes.sparkSession.sparkContext.broadcast((at, np.frombuffer(b"".join(dense["seconds"].to_pylist()), np.uint8).reshape(-1, 32 * width)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, bits = table.value
        for b in batches:
            raw = np.ascontiguousarray(b[plan.columns].to_numpy(np.int64)).view(np.uint8)
            hit = np.zeros(len(b), bool)
            for p in range(width - 1):
                posting = at[256 * p + raw[:, p].astype(np.int64)]
                some = np.flatnonzero((posting >= 0) & ~hit)
                second = 256 * np.arange(p + 1, width) + raw[some, p + 1 :]
                hit[some] = (bits[posting[some][:, None], second >> 3] >> (second & 7) & 1).any(axis=1)
            yield pd.DataFrame({"shingles": b["shingles"].to_numpy()[hit]})

    crowded = classes.filter("n > 0").select("shingles", *plan.columns).mapInPandas(run, "shingles long")
    return stored(found.filter("b IS NULL AND seconds IS NULL").select(F.col("a").alias("shingles")).unionByName(crowded).distinct())


def _same_row(id_col: str) -> list[Column]:
    """A row of the left side is that with the id and text of the right side's `rep`; null ids are equal."""
    return [F.col(id_col).eqNullSafe(F.col("rep.id")), F.col("text_hash") == F.col("rep.text_hash")]


def _marked(rows: DataFrame, wanted: DataFrame, id_col: str) -> DataFrame:
    """rows (id, text_hash and others) with `marked`: true for all that `wanted` (id, text_hash) names and for a few others, whose hash shares a bit with one of those. Nothing but the bits, a table of fixed size, is sent."""
    slot = F.shiftrightunsigned(F.xxhash64(id_col, "text_hash"), 64 - MARK_BITS)
    bits = wanted.select(slot.alias("_slot")).groupBy(F.shiftright("_slot", 6).alias("_word")).agg(F.expr("bit_or(shiftleft(1L, CAST(_slot & 63 AS INT)))").alias("_bits"))
    met = rows.withColumn("_slot", slot).join(F.broadcast(bits), F.shiftright("_slot", 6) == F.col("_word"), "left")
    return met.withColumn("marked", F.expr("coalesce(getbit(_bits, CAST(_slot & 63 AS INT)) = 1, false)")).drop("_slot", "_word", "_bits")


def _texts(docs: DataFrame, classes: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One text (_text) of each wanted class, and a few of others."""
    reps = classes.join(wanted.select("shingles").distinct(), "shingles").select(F.col("rep.id").alias(id_col), F.col("rep.text_hash").alias("text_hash"))
    texts = docs.select(id_col, text_of(text_col).alias("_text")).withColumn("text_hash", F.xxhash64("_text"))
    return _marked(texts, reps, id_col).filter("marked").select("_text")


def _named_sets(b: pd.DataFrame, plan: Plan) -> tuple[np.ndarray, list[np.ndarray]]:
    """Names and shingle sets of rows that hold both (shingles, members), or texts (_text) to make them of."""
    if "members" in b:
        return b["shingles"].to_numpy(np.int64), [np.asarray(m, np.int64) for m in b["members"]]
    sets = [shingle_set(shingle_hashes(t, plan.words)) for t in b["_text"]]
    return np.fromiter(map(set_hash, sets), np.int64, len(sets)), sets


def _sets(texts: DataFrame, plan: Plan) -> DataFrame:
    """Stored: shingles (the class) and members (its shingle set) of the texts, which are split into shingles again."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            names, sets = _named_sets(b, plan)
            yield pd.DataFrame({"shingles": names, "members": sets})

    return stored(texts.mapInPandas(run, "shingles long, members array<long>").dropDuplicates(["shingles"]))


def _verified(pairs: DataFrame, sets: DataFrame, plan: Plan) -> DataFrame:
    """Of pairs (a, b) of classes those whose shingle sets are similar enough."""
    for s in "ab":
        pairs = pairs.join(sets.select(F.col("shingles").alias(s), F.col("members").alias(f"members_{s}")), s)
    shared, total = F.size(F.array_intersect("members_a", "members_b")), F.size("members_a") + F.size("members_b")
    return pairs.filter(shared >= F.lit(plan.min_similarity) * (total - shared) - 1e-9).select("a", "b")


def _slots(shingles: np.ndarray) -> np.ndarray:
    return ((shingles.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _holders(sets: DataFrame, plan: Plan) -> tuple[np.ndarray, int]:
    """For each of a fixed number of slots how many sets hold its shingles, together: never less than for one shingle; and the sum of all. Summed up in each task first, which hands its sums over in packed blocks."""
    block = (1 << SLOT_BITS) // SLOT_BLOCKS

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(1 << SLOT_BITS, np.int64)
        for b in batches:
            for m in _named_sets(b, plan)[1]:
                np.add.at(counts, _slots(m), 1)
        if counts.any():
            yield pd.DataFrame({"block": range(SLOT_BLOCKS), "counts": [zlib.compress(_planes(x), 1) for x in counts.reshape(-1, block)]})

    def summed(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        total = sum(_unplaned([zlib.decompress(x)], np.int64) for x in parts["counts"])
        return pd.DataFrame({"block": [key[0]], "counts": [total.tobytes()]})

    kind = "block int, counts binary"
    sums = sets.mapInPandas(run, kind).groupBy("block").applyInPandas(summed, kind).toArrow()
    out = np.zeros((SLOT_BLOCKS, block), np.int64)
    for at, counts in zip(sums["block"].to_pylist(), sums["counts"].to_pylist()):
        out[at] = np.frombuffer(counts, np.int64)
    return np.minimum(out.reshape(-1), 2**32 - 1).astype(np.uint32), int(out.sum())


def _planes(x: np.ndarray) -> bytes:
    """All first bytes, all second bytes ..: bytes that are alike stand together, so they pack well."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def _unplaned(parts: Iterable[bytes], kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.concatenate([np.ascontiguousarray(np.frombuffer(p, np.uint8).reshape(size, -1).T).view(kind).reshape(-1) for p in parts])


def _met(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of a task's shingles of prefixes those that several sets hold, once for each set."""
    parts = [[b[c].tolist() for c in ("g", "shingles", "n", "at")] for b in batches if len(b)]
    if not parts:
        return
    g, name, n, at = (_unplaned([x for p in parts for x in p[i]], kind) for i, kind in enumerate((np.int64, np.int64, np.int32, np.int32)))
    del parts
    order = np.argsort(g, kind="stable")
    same = g[order[1:]] == g[order[:-1]]
    order = order[np.r_[False, same] | np.r_[same, False]]  # most shingles are of one set alone
    order = order[np.lexsort((name[order], g[order]))]
    new_g, new_name = g[order[1:]] != g[order[:-1]], name[order[1:]] != name[order[:-1]]
    order = order[np.r_[True, new_g | new_name][: len(order)]]  # texts of one set
    same = g[order[1:]] == g[order[:-1]]
    order = order[(np.r_[False, same] | np.r_[same, False])[: len(order)]]
    yield pd.DataFrame({"g": g[order], "shingles": name[order], "n": n[order], "at": at[order]})


def _prefixes(sets: DataFrame, plan: Plan) -> DataFrame:
    """Stored: g, shingles (the class), n, at: the shingles of each set's prefix that other sets' prefixes hold too, with their place among all of the set's. sets: shingles and members, or _text, of which they are made in the tasks and stored nowhere.

    The order is one for all sets: by how many sets hold what shares a shingle's slot (_holders, a table of fixed size, broadcast), then by the shingle. So common shingles stand last without a join
    of sets to their shingles' numbers, and one that is alone in its slot is in one set alone: it stands first and is left out, but uses up the prefix. Shingles are dealt out by their hash in packed
    blocks, into as many parts as their number asks for, and those that one set alone holds end there.
    """
    t, (holders, total) = plan.min_similarity, _holders(sets, plan)
    counts = sets.sparkSession.sparkContext.broadcast(holders)
    parts = max(int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil((1 - t) * total / PREFIX_PART))
    bits = (8 * parts).bit_length()

    def packed(names: list[int], picked: list[np.ndarray], sizes: list[tuple[int, int]]) -> pd.DataFrame:
        lengths, g = [len(x) for x in picked], np.concatenate(picked)
        at = np.concatenate([np.arange(alone, alone + k, dtype=np.int32) for (_, alone), k in zip(sizes, lengths)])
        order = np.argsort(g.view(np.uint64))
        g, at, name, n = g[order], at[order], np.repeat(np.array(names, np.int64), lengths)[order], np.repeat(np.array([n for n, _ in sizes], np.int32), lengths)[order]
        bucket = (g.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int32)
        starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        cuts = list(zip(starts, np.r_[starts[1:], len(g)]))
        return pd.DataFrame({"bucket": bucket[starts]} | {c: [_planes(x[i:j]) for i, j in cuts] for c, x in (("g", g), ("shingles", name), ("n", n), ("at", at))})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, picked, sizes, held = [], [], [], 0
        for b in batches:
            for name, m in zip(*_named_sets(b, plan)):
                df = counts.value[_slots(m)]
                alone = int((df == 1).sum())
                length = len(m) - math.ceil(t * len(m) - 1e-9) + 1 - alone
                if len(m) and length > 0:
                    names.append(name)
                    picked.append(m[np.lexsort((m, df))[alone : alone + length]])
                    sizes.append((len(m), alone))
                    held += length
                if held > 1_000_000:
                    yield packed(names, picked, sizes)
                    names, picked, sizes, held = [], [], [], 0
        if picked:
            yield packed(names, picked, sizes)

    dealt = sets.mapInPandas(run, "bucket int, g binary, shingles binary, n binary, at binary").repartition(parts, "bucket")
    return stored(dealt.select("g", "shingles", "n", "at").mapInPandas(_met, "g long, shingles long, n int, at int"))


def _hubs(prefixes: DataFrame, plan: Plan) -> DataFrame:
    """Pairs (a, b) of each class with the smallest one of each shingle of its prefix, where their numbers of shingles allow the similarity: few pairs, which link large groups of near copies."""
    least = prefixes.groupBy("g").agg(F.min(F.struct("shingles", "n")).alias("hub"))
    met = prefixes.select("g", "shingles", "n").join(least, "g").filter("shingles <> hub.shingles")
    alike = F.least("n", "hub.n") >= F.lit(plan.min_similarity) * F.greatest("n", "hub.n") - 1e-9
    return met.filter(alike).select(F.col("hub.shingles").alias("a"), F.col("shingles").alias("b")).distinct()


def _across(batches: Iterator[pd.DataFrame], plan: Plan) -> Iterator[pd.DataFrame]:
    """Pairs of classes of different components under each shingle that their numbers of shingles, and the shingle's places, allow to be similar. Rows come sorted by shingle and component; only such pairs are made, in bounded parts."""
    t = plan.min_similarity

    def pairs(b: pd.DataFrame) -> Iterator[pd.DataFrame]:
        g, component, name, n, left = (b[c].to_numpy(np.int64) for c in ("g", "component", "shingles", "n", "left"))
        new_g = np.r_[True, g[1:] != g[:-1]]
        ends = []
        for new in (new_g, new_g | np.r_[True, component[1:] != component[:-1]]):
            starts = np.flatnonzero(new)
            ends.append(np.repeat(np.r_[starts[1:], len(g)], np.diff(np.r_[starts, len(g)])))
        others = ends[0] - ends[1]
        at = np.flatnonzero(others)
        sums, start = np.r_[0, np.cumsum(others[at])], 0
        while start < len(at):
            stop = max(start + 1, int(np.searchsorted(sums, sums[start] + 1_000_000, "right")) - 1)
            some = at[start:stop]
            i = np.repeat(some, others[some])
            j = ends[1][i] + np.arange(len(i)) - np.repeat(sums[start:stop] - sums[start], others[some])
            ok = (np.minimum(n[i], n[j]) >= t * np.maximum(n[i], n[j]) - 1e-9) & (np.minimum(left[i], left[j]) >= t / (1 + t) * (n[i] + n[j]) - 1e-9)
            x, y = name[i[ok]], name[j[ok]]
            yield pd.DataFrame({"a": np.minimum(x, y), "b": np.maximum(x, y)}).drop_duplicates()
            start = stop

    rest: list[pd.DataFrame] = []
    for b in batches:
        g = b["g"].to_numpy()
        if not len(g):
            continue
        cut_at = int(np.searchsorted(g, g[-1]))
        if cut_at == 0 and rest and rest[0]["g"].iat[0] == g[0]:
            rest.append(b)
            continue
        yield from pairs(pd.concat([*rest, b.iloc[:cut_at]]))
        rest = [b.iloc[cut_at:]]
    if rest:
        yield from pairs(pd.concat(rest))


def _rest(prefixes: DataFrame, labels: DataFrame, plan: Plan) -> DataFrame:
    """Pairs (a, b) of classes of different components that may be similar enough; none that is gets lost.

    Prefix filtering: with shingles in one order, those that few sets hold first, two sets with a Jaccard similarity of t share one of the first n - ceil(t n) + 1 of either. Shingles of one set
    alone can't be shared, but stand first and use up its prefix, so most rows drop out before any pair is made. The first that two sets share bounds their overlap by what stands from it on in either
    (left); later ones bound it more closely, so a pair that any of them lets through is one that the first lets through.
    """
    first = prefixes.join(labels, F.col("shingles") == F.col("node"), "left").select("g", "shingles", "n", (F.col("n") - F.col("at")).alias("left"), F.coalesce("component", "shingles").alias("component"))
    met = first.repartition("g").sortWithinPartitions("g", "component")
    return met.mapInPandas(lambda it: _across(it, plan), "a long, b long").distinct()


def _similar(docs: DataFrame, plan: Plan, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Stored rows of fingerprints(), and of each class of equal shingle sets: shingles, rep (its first row) and component (a hash that all classes reachable from it have in common)."""
    cols = plan.columns
    prints = stored(fingerprints(docs, plan, id_col, text_col))
    row = F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), "text_hash")
    classes = stored(prints.groupBy("shingles").agg(F.min(row).alias("rep"), F.min("n").alias("n"), F.min(F.struct(*cols)).alias("f")).select("shingles", "rep", "n", "f.*"))
    keys = F.array(*(F.lit(256 * p) + F.shiftrightunsigned(f"f{p // 8}", 8 * (p % 8)).bitwiseAND(F.lit(255)).cast("int") for p in range(8 * plan.longs)))
    texts = lambda wanted: _texts(docs, classes, wanted, id_col, text_col)
    of = lambda pairs: _sets(texts(pairs.select(F.explode(F.array("a", "b")).alias("shingles"))), plan)
    if plan.by_prefix:
        prefixes = _prefixes(texts(classes.filter("n > 0")), plan)
        pairs = stored(_hubs(prefixes, plan))
    else:
        index = classes.filter("n > 0").select(F.explode(keys).alias("key"), "shingles", "n", *cols).repartition("key").sortWithinPartitions("key")
        found = stored(index.mapInPandas(lambda it: _partners(it, plan), "a long, b long, seconds binary"))
        pairs, dense = found.filter("b IS NOT NULL").select("a", "b"), _open(found, classes, plan)
        prefixes = _prefixes(texts(dense), plan).join(dense, "shingles", "left_semi")
    links = stored(_verified(pairs, of(pairs), plan))
    more = stored(_rest(prefixes, connected(links), plan).join(pairs, ["a", "b"], "left_anti"))
    return prints, _named(classes, connected(links.unionByName(_verified(more, of(more), plan))))


def _named(classes: DataFrame, labels: DataFrame) -> DataFrame:
    return classes.join(labels, F.col("shingles") == F.col("node"), "left").select("shingles", "rep", F.coalesce("component", "shingles").alias("component"))


def deduplicate(docs: DataFrame, plan: Plan = NEAR, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of near copies, with all its columns: that of the smallest id, of equal ids that of the smallest text hash; null ids come last.

    A row is told by its id and text, so one that shares only its id with a copy stays. Rows that repeat id and text are copies too: one of them stays. All texts without
    words, null ones among them, are one group. Columns named as the operator's own don't clash with them.
    """
    prints, classes = _similar(docs, plan, id_col, text_col)
    keepers = classes.groupBy("component").agg(F.min("rep").alias("rep")).select("rep")
    judged = stored(prints.groupBy(id_col, "text_hash").agg(F.count("*").alias("times")).join(keepers, _same_row(id_col), "left"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), id_col, F.xxhash64(text_of(text_col)).alias("text_hash"))
    # Rows that are not marked stay: they aren't among those to go, nor are they there several times. The others meet the rows that stay; only their texts are shuffled.
    rows = _marked(rows, judged.filter("rep IS NULL OR times > 1").select(id_col, "text_hash"), id_col)
    kept = rows.filter("marked").join(judged.filter("rep IS NOT NULL").select("rep", "times").hint("shuffle_hash"), _same_row(id_col))
    once = kept.filter("times = 1").select("row")
    more = kept.filter("times > 1").groupBy("rep").agg(F.first("row").alias("row")).select("row")
    return rows.filter("NOT marked").select("row").unionByName(once).unionByName(more).select("row.*")


def groups(docs: DataFrame, plan: Plan = EXACT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, f0 .., component_id (the smallest id reachable over links between fingerprints, its own included).

    With a least similarity, links are those between shingle sets of at least that similarity.

    Rows of equal fingerprints (or sets) are one class, so copies are compared once; a null or wordless text has fingerprint zero and is linked like any other (a wordless set
    only to its like). Rows are told apart by what they hold, so rows that repeat an id with different texts aren't linked by it. A null id is no component_id; that is null if no
    row reachable has an id. Extra columns are not read.

    Texts are read once and their fingerprints stored. The index is dealt by key and sorted within partitions; every task returns a spanning forest of
    what it found. A class that a third of all rows share is one row there, and a skewed key that adaptive execution splits in the join back.
    """
    cols = plan.columns
    if plan.min_similarity:
        prints, found = _similar(docs, plan, id_col, text_col)
        least = found.groupBy("component").agg(F.min("rep.id").alias("component_id"))
        return prints.join(found.join(least, "component").select("shingles", "component_id"), "shingles").select(id_col, *cols, "component_id")
    prints = stored(fingerprints(docs, plan, id_col, text_col))
    classes = prints.groupBy("f0").agg(F.min(id_col).alias("rep"))
    index = classes.select(F.explode(_keys()).alias("key"), "f0").repartition("key").sortWithinPartitions("key")
    links = index.mapInPandas(lambda it: _postings(it, plan), "a long, b long").distinct()
    found = connected(links)
    named = classes.join(found, F.col("f0") == F.col("node"), "left").select("f0", "rep", F.coalesce("component", "f0").alias("component"))
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    return prints.join(named.join(least, "component").select("f0", "component_id"), "f0").select(id_col, "f0", "component_id")
