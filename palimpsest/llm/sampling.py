"""Sampled segmentations without replacement: Gumbel top-k by perturbed best-first search over a text's lattice of pieces.

The vocabulary is a SentencePiece model's pieces. A piece's weight is 1 / (rank + RANK_OFFSET), after Zipf, from its rank in the model; a byte no piece covers
falls back to its byte piece. A segmentation's probability is the product of its weights over the sum of that for all segmentations of the text.

No piece goes over a space, so a text's lattice is a chain of its words' lattices, and a segmentation is a chain of decisions, one for each piece. The search holds sets of
segmentations that agree up to a decision and differ there from those already emitted. A set's best perturbed log probability is a Gumbel value about the logarithm of the set's mass,
cut off at that of the set which it was split from. So the search of many texts goes on together, in array operations: each round takes every text's best set, completes a
segmentation of it by free draws, and splits what is left of the set.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLES, RANK_OFFSET, SPACE = 3, 10.0, "▁"
#: Code points of texts that are searched together; a longer text is searched alone.
TOGETHER = 500_000
#: Runs of spaces with the word behind them.
WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
MULTIPLIER, SLOT_BITS = np.uint64(0x9E3779B97F4A7C15), 18
#: Factors that spread hashes over the slots of each table.
SPREAD = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))
#: A longer word, as in languages without spaces, is gone through position by position; shorter ones go together, all positions equally far from their ends at a time.
LONG = 96
#: Log probabilities and positions within distributions are multiples of this, so that sums are exact and results don't depend on which texts are searched together.
GRAIN = 2.0**-26
#: The id of a beginning of pieces that is no whole piece.
NONE = np.iinfo(np.int32).min
#: What a draw is for.
ROOT, WALK, SPLIT, TURN, REST = range(5)
#: No draw gives a Gumbel value so far above its location: draws are at most 1 - 2^-53.
HIGHEST = 37.0
#: Decisions whose mass lies at most so far below that of a set are looked at first.
NEAR = 44.0


def mixed(x: np.ndarray) -> np.ndarray:
    """64 bits in which every bit of x has a say (the finish of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Vocabulary:
    """Pieces of a model, findable by hashes of their beginnings, of each length."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.bytes = {int(p[1:-1], 16): i for i, p in enumerate(pieces) if model.is_byte(i)}
        self.ascii = np.array([self.bytes[b] for b in range(128)], np.int32)
        byte_of = {i: b for b, i in self.bytes.items()}
        raw = [bytes([byte_of[i]]) if i in byte_of else p.encode() for i, p in enumerate(pieces)]
        self.raw, self.size = np.frombuffer(b"".join(raw), np.uint8), np.array([len(x) for x in raw], np.int64)
        self.start = np.cumsum(self.size) - self.size
        normal = np.array([i for i in range(len(pieces)) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))], np.int64)
        if any(SPACE in pieces[i].lstrip(SPACE) for i in normal):
            raise ValueError("a piece of this vocabulary goes on after a space")
        self.odds = np.zeros(len(pieces))
        self.odds[normal] = 1 / (np.arange(len(normal)) + RANK_OFFSET)
        self.byte_odds = 1 / (len(normal) + RANK_OFFSET)
        length = np.array([len(pieces[i]) for i in normal], np.int64)
        points = np.frombuffer("".join(pieces[i] for i in normal).encode("utf-32-le"), np.uint32).astype(np.uint64)
        at, h, found = np.cumsum(length) - length, np.zeros(len(normal), np.uint64), []
        self.longest = int(length.max(initial=0))
        for n in range(self.longest):
            some = length > n
            normal, length, at, h = normal[some], length[some], at[some], h[some]
            h = h * MULTIPLIER + points[at + n] + np.uint64(1)
            found.append((h, np.where(length == n + 1, normal, NONE)))
        every, ids = (np.concatenate(x) for x in zip(*found))  # hashes tell lengths apart
        order = np.argsort(every)
        every, ids = every[order], ids[order]
        firsts = np.flatnonzero(np.r_[True, every[1:] != every[:-1]])
        every, ids = every[firsts], np.maximum.reduceat(ids, firsts)
        # Cuckoo hashing: every hash stands in its slot of one of two tables, so no search looks further. Those that lost or left their slot go to the other table.
        held, out, t, rounds = np.full((2, 1 << SLOT_BITS), -1), np.arange(len(every)), 0, 0
        while len(out):
            spot = self.slot(every[out], t)
            before = held[t, spot]
            held[t, spot] = out
            won = held[t, spot] == out
            out, t, rounds = np.concatenate([out[~won], before[won & (before >= 0)]]), 1 - t, rounds + 1
            if rounds > 1000:
                raise ValueError("too many pieces for the tables: raise SLOT_BITS")
        held = np.maximum(held, 0)  # an empty slot shows a hash that stands elsewhere, with its id
        self.hashes, self.ids = every[held], ids[held].astype(np.int32)

    @staticmethod
    def slot(h: np.ndarray, table: int) -> np.ndarray:
        return ((h * SPREAD[table]) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The hashes that are of beginnings of pieces, by number, and for those the piece's id, NONE if they are no whole piece."""
        spot = self.slot(h, 0)
        met, ids = self.hashes[0][spot] == h, self.ids[0][spot]
        miss = np.flatnonzero(~met)
        h = h[miss]
        spot = self.slot(h, 1)
        met[miss], ids[miss] = self.hashes[1][spot] == h, self.ids[1][spot]
        met = np.flatnonzero(met)
        return met, ids[met]

    def spells(self, ids: np.ndarray, text: bytes) -> bool:
        """Whether the ids are a spelling of a text, given as marked()."""
        size = self.size[ids]
        ends = np.cumsum(size)
        if (int(ends[-1]) if len(ends) else 0) != len(text):
            return False
        return self.raw[np.arange(len(text)) + np.repeat(self.start[ids] - ends + size, size)].tobytes() == text


def marked(text: str) -> bytes:
    """A text as its pieces write it: a space sign in front and for every space."""
    return (SPACE + text.replace(" ", SPACE)).encode() if text else b""


def split(text: str) -> list[str]:
    """Runs of spaces with the word behind them, spaces as the model writes them and one put in front. No piece goes over such a border."""
    if not text:
        return []
    return WORD.findall(SPACE + text.replace(" ", SPACE))


def numbered(texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """The words of texts, as split() gives them: each word's number, how many words a text has, and the different words by number."""
    plain = np.array([bool(t) and t[0] != " " != t[-1] and "  " not in t and SPACE not in t for t in texts], bool)
    order = np.argsort(~plain, kind="stable")  # texts without runs of spaces are taken apart together, in front of the others
    parts = pc.split_pattern(pa.array([t for t, x in zip(texts, plain) if x], pa.string()), " ")
    others = [split(t) for t, x in zip(texts, plain) if not x]
    coded = pa.concat_arrays([parts.flatten(), pa.array([w[1:] for words in others for w in words], pa.string())]).dictionary_encode()
    many = np.concatenate([parts.value_lengths().to_numpy(), np.array(list(map(len, others)), np.int64)]).astype(np.int64)
    first, counts = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    counts[order], first[order] = many, np.cumsum(many) - many
    at, _ = ranges(first, first + counts)
    return coded.indices.to_numpy().astype(np.int64)[at], counts, [SPACE + w for w in coded.dictionary.to_numpy(zero_copy_only=False).tolist()]


class Lattices:
    """Lattices of words, laid out one after another: edges sorted by the position where they start, and for each the probability given all ways to spell the rest.

    first: a position's first edge. upto: position plus the probability of its edges so far, so that a search for position + uniform draw finds an edge. after: where an edge ends, -1 at a word's
    end. Byte fallbacks have the id -1 - code point.
    """

    def __init__(self, vocabulary: Vocabulary, words: list[str]):
        self.length = length = np.array(list(map(len, words)), np.int64)
        self.base = np.cumsum(length) - length
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64)
        n, wide = len(points), vocabulary.longest
        self.word_end = np.repeat(self.base + length, length)
        far = self.word_end - np.arange(n)
        table = np.full(n * wide, NONE, np.int32)  # ids, by position and length
        active, h = np.arange(n), np.zeros(n, np.uint64)
        for k in range(wide):
            inside = np.flatnonzero(far[active] > k)
            active, h = active[inside], h[inside]
            h = h * MULTIPLIER + points[active + k] + np.uint64(1)
            met, ids = vocabulary.find(h)
            active, h = active[met], h[met]
            table[active * wide + k] = ids
        bare = np.flatnonzero(table[::wide] == NONE)
        table[bare * wide] = -1 - points[bare].astype(np.int32)
        at = np.flatnonzero(table != NONE)
        self.pos, self.ids = at // wide, table[at]
        self.end = at - self.pos * (wide - 1) + 1
        many = np.bincount(self.pos, minlength=n)
        self.first = np.concatenate([[0], np.cumsum(many)])
        self.after = np.where(self.end == self.word_end[self.pos], -1, self.end)
        self.p = p = vocabulary.odds[self.ids]
        coded = points[bare]
        p[self.first[bare]] = vocabulary.byte_odds ** (1.0 + (coded > 0x7F) + (coded > 0x7FF) + (coded > 0xFFFF))
        self._given_the_rest(p, wide, far)
        for w in np.flatnonzero(length > LONG):
            self._given_the_rest_of(int(self.base[w]), int(self.base[w] + length[w]), p)
        upto, rows, k = p.copy(), np.flatnonzero(many > 1), 1
        while len(rows):  # the k-th edge of each position that has one
            e = self.first[rows] + k
            upto[e] += upto[e - 1]
            k += 1
            rows = rows[np.flatnonzero(many[rows] > k)]
        upto[self.first[1:] - 1] = 1.0
        self.upto = self.pos + np.rint(np.minimum(upto, 1.0) / GRAIN) * GRAIN

    def log_of(self, edge: np.ndarray | slice) -> np.ndarray:
        """Logarithms of edges' probabilities given the rest."""
        with np.errstate(divide="ignore"):
            return np.rint(np.log(self.p[edge]) / GRAIN) * GRAIN

    @property
    def log_p(self) -> np.ndarray:
        return self.log_of(slice(None))

    def other(self, edge: np.ndarray) -> np.ndarray:
        """Logarithm of what the other edges of each edge's position have together."""
        pos, p = self.pos[edge], self.p[edge]
        # What is left beside a large edge is summed up, as 1 - p would lose its digits.
        large = np.flatnonzero(p > 0.5)
        beside, owner = ranges(self.first[pos[large]], self.first[pos[large] + 1])
        q = self.p[beside]
        left = 1 - p
        left[large] = np.bincount(owner, np.where(q > 0.5, 0.0, q), len(large))
        with np.errstate(divide="ignore"):
            return np.log(left)

    def _given_the_rest(self, odds: np.ndarray, wide: int, far: np.ndarray) -> None:
        """Turns edges' odds into probabilities given all ways to spell the rest of the word; from the words' ends on, positions equally far from them together.

        For that they stand in a table by length of the edge, distance from the end and word, the longest word first, so that each step reads slices. Sums of products are scaled up
        again before they get too small: eight positions are more than 1e-144. Long words are left as they are.
        """
        short = np.flatnonzero(self.length <= LONG)
        order = short[np.argsort(-self.length[short], kind="stable")]
        lengths, rank = self.length[order][::-1], np.zeros(len(self.length), np.int64)
        rank[order] = np.arange(len(order))
        most = int(lengths[-1]) if len(order) else 0
        many = len(order) - np.searchsorted(lengths, np.arange(most + 1))  # words that are so long
        many[0] = 0
        n, offset = int(many.sum()), np.cumsum(many) - many
        spot = (offset[np.minimum(far, most)] + np.repeat(rank, self.length))[self.pos] + (self.end - self.pos - 1) * n
        edges = slice(None) if len(short) == len(rank) else np.flatnonzero(np.repeat(self.length <= LONG, self.length)[self.pos])
        spot = spot[edges]
        table, rest, done = np.zeros(wide * n), np.ones(n), np.ones(len(order))
        table[spot] = odds[edges]
        for i in range(1, most + 1):
            m, here = int(many[i]), slice(int(offset[i]), int(offset[i] + many[i]))
            total = np.zeros(m)
            values = table.reshape(wide, n)[: min(i, wide), here]
            for k, value in enumerate(values):
                value *= rest[offset[i - k - 1] :][:m] if k + 1 < i else done[:m]
                total += value
            values /= total
            rest[here] = total
            if not i & 7 and len(low := np.flatnonzero(total < 1e-100)):
                for k in range(min(i, wide)):
                    rest[offset[i - k] + low] /= total[low]
                if i < wide:
                    done[low] /= total[low]
        odds[edges] = table[spot]

    def _given_the_rest_of(self, start: int, end: int, odds: np.ndarray) -> None:
        """The same within one long word, position by position, on edges."""
        a, b = int(self.first[start]), int(self.first[end])
        cuts, ends, of = (self.first[start : end + 1] - a).tolist(), (self.end[a:b] - start).tolist(), odds[a:b].tolist()
        size = end - start
        rest, total, out, stop = [1.0] * (size + 1), [1.0] * size, [0.0] * (b - a), b - a
        widest = max(map(int.__sub__, ends, (self.pos[a:b] - start).tolist()))
        for i in range(size - 1, -1, -1):
            at = cuts[i]
            values = [p * rest[n] for p, n in zip(of[at:stop], ends[at:stop])]
            out[at:stop], stop = values, at
            rest[i] = total[i] = t = sum(values)
            if not i & 7 and t < 1e-100:
                for n in range(i, min(i + widest, size) + 1):
                    rest[n] /= t
        odds[a:b] = np.array(out) / np.repeat(total, np.diff(cuts))


class Paths:
    """One segmentation of each of some texts: edges in order of their places, and the log probability before edges. by_place has -1 where no edge starts."""

    def __init__(self, lattices: Lattices, text_place: np.ndarray, by_place: np.ndarray):
        self.place = np.flatnonzero(by_place >= 0)
        self.edge = by_place[self.place]
        self.start = np.searchsorted(self.place, text_place)
        # Less the sums of log probabilities: they never fall, and are exact.
        self.cost = np.concatenate([[0.0], np.cumsum(-lattices.log_of(self.edge))])
        self.total = -np.diff(self.cost[self.start])

    def before(self, at: np.ndarray, text: np.ndarray) -> np.ndarray:
        return self.cost[self.start[text]] - self.cost[at]


def ranges(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers from start to end of each range, and the range of each."""
    n = np.maximum(end - start, 0)
    owner = np.repeat(np.arange(len(n)), n)
    return np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n) + start[owner], owner


def search(vocabulary: Vocabulary, keys: list[str], texts: list[str], k: int) -> list[list[tuple[np.ndarray, float, float, float]]]:
    """For each text up to k distinct segmentations by falling perturbed log probability: ids, log probability, perturbed, log of the chance to be among the k given the rest.

    The threshold of the chances is the value of the best set left after k. A set's value can matter only if it is among the best of its split that are still to be emitted, or next to them, so
    no more are kept. Draws are hashes of a text's key, the round, the use and the place in the text.
    """
    flat, counts, words = numbered(texts)
    lattices = Lattices(vocabulary, words)
    n_texts = len(texts)
    # Places count the code points of all texts, one after another.
    word_place = np.concatenate([[0], np.cumsum(lattices.length[flat])])
    shift = word_place[:-1] - lattices.base[flat]  # from a position of the word's lattice to its place
    text_word = np.concatenate([[0], np.cumsum(counts)])
    text_place = word_place[text_word]
    text_of = np.repeat(np.arange(n_texts), np.diff(text_place))
    seed = np.array([xxhash.xxh64_intdigest(x) for x in keys], np.uint64)

    def salt(turn: int, use: int) -> np.ndarray:
        return mixed(seed + np.array([8 * turn + use + 1], np.uint64) * MULTIPLIER) - text_place[:-1].astype(np.uint64) * MULTIPLIER

    def uniform(text: np.ndarray, place: np.ndarray, turn: int, use: int) -> np.ndarray:
        x = mixed(salt(turn, use)[text] + place.astype(np.uint64) * MULTIPLIER)
        return np.maximum((x >> np.uint64(11)).astype(float) * 2.0**-53, 1e-300)

    def aims(key: np.ndarray, at: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Positions plus draws, which are multiples of GRAIN."""
        return at + (mixed(key + place.astype(np.uint64) * MULTIPLIER) >> np.uint64(38)) * GRAIN

    def walk(at: np.ndarray, shift: np.ndarray, turn: int, by_place: np.ndarray) -> None:
        """From positions on to the ends of their words, drawn freely."""
        key = salt(turn, WALK)[text_of[at + shift]]
        if lattices.length.max(initial=0) > LONG:
            far = lattices.word_end[at] - at > LONG
            for one in np.flatnonzero(far).tolist():
                walk_long(int(at[one]), int(shift[one]), key[one], by_place)
            at, shift, key = at[~far], shift[~far], key[~far]
        while len(at):
            place = at + shift
            aim, e = aims(key, at, place), lattices.first[at]
            going = np.flatnonzero(lattices.upto[e] <= aim)  # the last edge of a position reaches 1, which no draw does
            edge, goal = e[going], aim[going]
            while len(going):
                edge += 1
                e[going] = edge
                on = np.flatnonzero(lattices.upto[edge] <= goal)
                going, edge, goal = going[on], edge[on], goal[on]
            by_place[place] = e
            at = lattices.after[e]
            more = np.flatnonzero(at >= 0)
            at, shift, key = at[more], shift[more], key[more]

    def walk_long(at: int, shift: int, key: np.uint64, by_place: np.ndarray) -> None:
        """The same for one word, position by position. The draws of its positions are made together."""
        end = int(lattices.word_end[at])
        here = np.arange(at, end)
        a, b = int(lattices.first[at]), int(lattices.first[end])
        aim, firsts, upto, ends = aims(key, here, here + shift).tolist(), (lattices.first[at:end] - a).tolist(), lattices.upto[a:b].tolist(), lattices.end[a:b].tolist()
        i, visited, out = at, [], []
        while i < end:
            e, goal = firsts[i - at], aim[i - at]
            while upto[e] <= goal:
                e += 1
            visited.append(i)
            out.append(e)
            i = ends[e]
        by_place[np.array(visited) + shift] = np.array(out) + a

    def cut_off(mass: np.ndarray, u: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """Gumbel values about the masses' logarithms, given that they are below the bounds."""
        with np.errstate(invalid="ignore"):
            return below(mass - np.log(-np.log(u)), bound)

    def below(free: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """Gumbel values that may be above the bounds as values given that they are not; greater ones stay greater."""
        return -np.logaddexp(-bound, -free)

    room = k * (k + 2)
    value = np.full((n_texts, room), -np.inf)
    holds = np.zeros((n_texts, room, 2), np.int64)  # path and decision
    gone = np.full((n_texts, room, k), -1, np.int64)  # edges that the set doesn't take there
    used = np.zeros(n_texts, np.int64)

    def put(text: np.ndarray, values: np.ndarray, path: int, decision: np.ndarray, without: np.ndarray) -> None:
        some = values > -np.inf
        text, slot = text[some], used[text[some]]
        value[text, slot], holds[text, slot, 0], holds[text, slot, 1] = values[some], path, decision[some]
        gone[text, slot] = without[some]
        used[text] += 1

    def highest(path: Paths, number: int, live: np.ndarray, start: np.ndarray, end: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """The highest Gumbel values about the masses that leave a path at its decisions of each range, not cut off, and where."""
        value, where = np.full((most, len(live)), -np.inf), np.zeros((most, len(live)), np.int64)
        at, owner = ranges(start, end)
        values = path.before(at, live[owner]) + lattices.other(path.edge[at]) - np.log(-np.log(uniform(live[owner], path.place[at], number, SPLIT)))
        firsts = np.flatnonzero(np.diff(owner, prepend=-1))
        sizes = np.diff(np.append(firsts, len(at)))
        for i in range(most if len(at) else 0):
            hit = np.flatnonzero((values == np.repeat(np.maximum.reduceat(values, firsts), sizes)) & (values > -np.inf))
            hit = hit[np.flatnonzero(np.diff(owner[hit], prepend=-1))]
            value[i, owner[hit]], where[i, owner[hit]] = values[hit], at[hit]
            values[hit] = -np.inf
        return value, where

    def put_decisions(path: Paths, number: int, live: np.ndarray, start: np.ndarray, bound: np.ndarray, most: int) -> None:
        """Sets that leave a path at its decisions from `start` on: the best `most` of each live text.

        A decision has no more mass than the path has up to there, so those behind aren't looked at where those in front have values that they can't reach.
        """
        end = path.start[live + 1]
        near = np.minimum(np.searchsorted(path.cost, path.cost[start] + NEAR, "right"), end)
        value, where = highest(path, number, live, start, near, most)
        far = np.flatnonzero((near < end) & (value[-1] <= path.before(near, live) + HIGHEST))
        if len(far):
            value[:, far], where[:, far] = highest(path, number, live[far], start[far], end[far], most)
        for values, at in zip(value, where):
            without = np.full((len(live), k), -1, np.int64)
            some = np.flatnonzero(values > -np.inf)
            without[some, 0] = path.edge[at[some]]
            put(live, np.where(values > -np.inf, below(values, bound[live]), -np.inf), number, at, without)

    every = np.arange(n_texts)
    perturbed = np.full((k, n_texts), -np.inf)
    perturbed[0] = -np.log(-np.log(uniform(every, text_place[:-1], 0, ROOT)))
    by_place = np.full(len(text_of), -1, np.int64)
    walk(lattices.base[flat], shift, 0, by_place)
    none = np.zeros(0, np.int64)
    paths = [Paths(lattices, text_place, by_place)]
    put_decisions(paths[0], 0, every, paths[0].start[:-1], perturbed[0], k)
    for turn in range(1, k):
        best = value.argmax(axis=1) if room else every
        bound = value[every, best]
        live = np.flatnonzero(bound > -np.inf)
        value[live, best[live]] = -np.inf
        perturbed[turn, live] = bound[live]
        base, decision, without = holds[live, best[live], 0], holds[live, best[live], 1], gone[live, best[live]]
        place, edge, start, before = (np.zeros(len(live), t) for t in (np.int64, np.int64, np.int64, float))
        by_place = np.full(len(text_of), -1, np.int64)
        for number, path in enumerate(paths):
            mine = np.flatnonzero(base == number)
            at = decision[mine]
            place[mine], edge[mine], before[mine], start[mine] = path.place[at], path.edge[at], path.before(at, live[mine]), path.start[live[mine]]
            kept, _ = ranges(start[mine], at)
            by_place[path.place[kept]] = path.edge[kept]
        word = np.searchsorted(word_place, place, "right") - 1
        # Another edge at the decision, by the probabilities of those that the set may take.
        from_ = lattices.pos[edge]
        choice, owner = ranges(lattices.first[from_], lattices.first[from_ + 1])
        odds = np.where((choice[:, None] == without[owner]).any(axis=1), 0.0, lattices.p[choice])
        firsts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else none
        total = np.add.reduceat(odds, firsts) if len(owner) else np.zeros(0)
        target = uniform(live, place, turn, TURN) * total
        sums = np.cumsum(odds)
        sums -= (sums[firsts] - odds[firsts])[owner] if len(owner) else 0
        fits = np.flatnonzero((odds > 0) & (sums >= target[owner]))
        taken_at = np.full(len(live), -1, np.int64)
        taken_at[owner[fits][::-1]] = fits[::-1]
        spare = np.flatnonzero(odds > 0)
        missing = taken_at < 0
        if missing.any():  # rounding: the last edge with a chance
            last = np.full(len(live), -1, np.int64)
            last[owner[spare]] = spare
            taken_at[missing] = last[missing]
        taken = choice[taken_at]
        odds[taken_at] = 0.0
        left = np.add.reduceat(odds, firsts) if len(owner) else np.zeros(0)
        by_place[place] = taken
        onward = np.flatnonzero(lattices.after[taken] >= 0)
        later, _ = ranges(word + 1, text_word[live + 1])
        walk(np.concatenate([lattices.after[taken[onward]], lattices.base[flat[later]]]), np.concatenate([shift[word[onward]], shift[later]]), turn, by_place)
        path = Paths(lattices, text_place, by_place)
        paths.append(path)
        at = path.start[live] + decision - start
        without = np.concatenate([without[:, :turn], taken[:, None], without[:, turn + 1 :]], axis=1)
        with np.errstate(divide="ignore"):
            put(live, cut_off(before + np.log(left), uniform(live, place, turn, REST), bound[live]), turn, at, without)
        put_decisions(path, turn, live, at + 1, bound, k - turn)
    threshold = value.max(axis=1, initial=-np.inf)
    every_ids = [spelled(vocabulary, lattices.ids[path.edge], path.start) for path in paths]
    out = []
    for t in range(n_texts):
        own = []
        for turn in range(k):
            if perturbed[turn, t] > -np.inf and (turn == 0 or texts[t]):
                p, (ids, start) = float(paths[turn].total[t]), every_ids[turn]
                own.append((ids[start[t] : start[t + 1]], p, float(perturbed[turn, t]), log_chance(p - float(threshold[t]))))
        out.append(own)
    return out


def spelled(vocabulary: Vocabulary, ids: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids with byte fallbacks as their bytes' pieces, and where each text's start."""
    bare = np.flatnonzero(ids < 0)
    if not len(bare):
        return ids, start
    if ids.min() >= -128:
        ids[bare] = vocabulary.ascii[-1 - ids[bare]]
        return ids, start
    coded = [chr(-1 - i).encode() for i in ids[bare].tolist()]
    many = np.ones(len(ids), np.int64)
    many[bare] = list(map(len, coded))
    ends = np.concatenate([[0], np.cumsum(many)])
    out = np.repeat(ids, many)
    out[out < 0] = [vocabulary.bytes[b] for b in b"".join(coded)]
    return out, ends[start]


def log_chance(d: float) -> float:
    """log(1 - exp(-exp(d))): chance that a Gumbel value about d is above 0, which no double but its logarithm holds for long texts."""
    return d if d < -30 else 0.0 if d > 4 else math.log(-math.expm1(-math.exp(d)))


def sample(vocabulary: Vocabulary, keys: list[str], texts: list[str], k: int) -> Iterator[list[tuple[np.ndarray, float, float, float]]]:
    """Samples of each text, in order; so many texts are searched together as have about TOGETHER code points."""
    start = 0
    while start < len(texts):
        end, total = start, 0
        while end < len(texts) and (end == start or total + len(texts[end]) <= TOGETHER):
            total, end = total + len(texts[end]), end + 1
        yield from search(vocabulary, keys[start:end], texts[start:end], k)
        start = end


def sample_segmentations(df: DataFrame, path: str, keys: list[str], text_col: str = "text", k: int = SAMPLES, seed: int = 0) -> DataFrame:
    """Per row and sample: the keys, sample (from 1), ids, log_prob, perturbed, log_inclusion and round_trip (the ids' pieces spell the text).

    Draws depend on the seed and the row's keys alone, so rows repeated with equal keys and texts have equal samples. A null or empty text has one
    segmentation, the empty one, of probability 1; a text with fewer than k segmentations has all of them, each sure to be included. Extra columns are not
    read. Nothing is shuffled; whole texts are segmented, and memory is bounded by one text or TOGETHER code points.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(path)
        for b in batches:
            own = b.select([c for c in b.schema.names if c not in ("_key", "_text")])
            row_keys, texts = (b.column(c).to_numpy(zero_copy_only=False).tolist() for c in ("_key", "_text"))
            out, held = [], 0

            def made() -> pa.RecordBatch:
                at, number, ids, *scores, spelt = zip(*out) if out else ((),) * 7
                ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *ids])))
                cols = [pa.array(number, pa.int32()), lists, *(pa.array(x, pa.float64()) for x in scores), pa.array(spelt, pa.bool_())]
                names = ["sample", "ids", "log_prob", "perturbed", "log_inclusion", "round_trip"]
                return pa.RecordBatch.from_arrays([*own.take(pa.array(at, pa.int64())).columns, *cols], names=[*own.schema.names, *names])

            for n, got in enumerate(sample(vocabulary, row_keys, texts, k)):
                want = marked(texts[n])
                for i, (ids, *scores) in enumerate(got):
                    out.append((n, i + 1, ids, *scores, vocabulary.spells(ids, want)))
                    held += len(ids)
                if held > 4 * TOGETHER:
                    yield made()
                    out, held = [], 0
            yield made()

    rows = df.select(*keys, F.concat_ws("\x1f", F.lit(str(seed)), *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in keys)).alias("_key"), F.coalesce(text_col, F.lit("")).alias("_text"))
    own = ", ".join(f"`{n}` {t}" for n, t in rows.drop("_key", "_text").dtypes)
    return rows.mapInArrow(run, own + ", sample int, ids array<int>, log_prob double, perturbed double, log_inclusion double, round_trip boolean")
