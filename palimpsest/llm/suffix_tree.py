"""Language-model scores by a probabilistic suffix tree over bytes, beside a smoothed unigram score over words.

The tree's contexts are up to DEPTH symbols long. A context is a candidate if it precedes at least MIN_COUNT symbols, and is retained if its next-symbol distribution diverges from that of its suffix, in nats for a
symbol and in all: so what is kept rests on the evidence for it alone and grows with the corpus. Distributions are smoothed by those of the retained suffixes down to the root. A symbol is scored by the longest retained suffix of what was read.

The tree is cut into shards by the last two symbols of its contexts, each of a bounded number of states, and a shard is built and broadcast on its own. A task sorts the symbols of a block of texts by what
they follow, so a block meets each shard once, and shards beyond a fixed number of bytes are let go after each block.
"""

from __future__ import annotations

import math
import pickle
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.common import stored, text_of

DEPTH, MIN_COUNT = 5, 50
#: States of a shard (more only if one pair of last symbols has more), and bytes of shards that a worker keeps between blocks.
SHARD_STATES, KEEP_BYTES = 50_000, 1 << 25
#: Divergence test: Kullback-Leibler distance to the suffix's distribution, in nats for a symbol, and that times the context's count.
MIN_NATS, MIN_TOTAL_NATS = 0.005, 10.0
#: Weight of the suffix's distribution in a context's own, in symbols; count of every symbol that the root adds.
SMOOTHING, FLOOR = 4.0, 0.5
#: Symbols: 0 stands before a text, 1 + b for byte b, 257 for its end.
START, END, BITS = 0, 257, 9
#: At most so many frequent words are broadcast: those that make up more than that share of all training tokens each.
TABLE_ENTRIES = 200_000
#: Symbols, words and rows that a task works on at a time.
BLOCK, FLUSH, ROWS = 1 << 19, 200_000, 1000


def lowered(text: str) -> bytes:
    """UTF-8 with A-Z lower-cased."""
    return text.encode().lower()


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, counts = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
    return codes[first], np.add.reduceat(counts, first)


def gram_counts(texts: Iterator[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(DEPTH + 1)-grams of symbols, each packed into a long, with their counts."""
    parts, waiting, n = [], [], 0

    def count() -> None:
        s = np.concatenate(waiting).astype(np.int64)
        g = s[DEPTH:].copy()
        for i in range(1, DEPTH + 1):
            g |= s[DEPTH - i : len(s) - i] << (BITS * i)
        g = np.sort(g[s[DEPTH:] != START])
        first = np.flatnonzero(np.r_[True, g[1:] != g[:-1]]) if len(g) else np.zeros(0, int)
        parts.append((g[first], np.diff(np.r_[first, len(g)])))
        waiting.clear()

    def put(x: np.ndarray) -> None:
        nonlocal n
        waiting.append(x)
        n += len(x)
        if n >= BLOCK:
            count()
            n = 0
            if len(parts) > 8:
                parts[:] = [_merge(parts)]

    for t in texts:
        s = np.concatenate([np.zeros(DEPTH, np.uint16), np.frombuffer(t, np.uint8).astype(np.uint16) + 1, np.array([END], np.uint16)])
        for i in range(0, len(s) - DEPTH, BLOCK):
            piece = s[i : i + BLOCK + DEPTH].copy()
            if i and waiting:  # a piece that continues a text must come first: the symbols it repeats are context only
                count()
                n = 0
            put(piece)
    if waiting:
        count()
    return _merge(parts) if parts else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def context_counts(train: DataFrame, text_col: str = "text") -> DataFrame:
    """state (length and symbols of a context), next and n, over all texts of train. Each task sums up its own texts first."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = []
        for b in batches:
            parts.append(gram_counts(lowered(t) for t in b["_text"]))
            parts = [_merge(parts)]
        if not parts:
            return
        grams, counts = parts[0]
        for d in range(DEPTH + 1):
            codes, sums = _merge([(grams & ((1 << BITS * (d + 1)) - 1), counts)])
            for i in range(0, len(codes), 100_000):
                c = codes[i : i + 100_000]
                yield pd.DataFrame({"code": c | d << BITS * (DEPTH + 1), "n": sums[i : i + 100_000]})

    rows = train.select(text_of(text_col).alias("_text")).mapInPandas(run, "code long, n long")
    summed = rows.groupBy("code").agg(F.sum("n").alias("n"))
    return summed.select(F.shiftright("code", BITS).alias("state"), F.col("code").bitwiseAND(F.lit((1 << BITS) - 1)).cast("int").alias("next"), "n")


def retained(counts: DataFrame) -> DataFrame:
    """Rows of the contexts that pass the divergence test, and of the root."""
    frequent = counts.groupBy("state").agg(F.sum("n").alias("total")).filter((F.col("state") == 0) | (F.col("total") >= MIN_COUNT))
    rows = counts.join(frequent, "state").withColumn("p", F.col("n") / F.col("total"))
    length = F.shiftright("state", BITS * DEPTH)
    symbols = F.col("state").bitwiseAND(F.lit((1 << BITS * DEPTH) - 1))
    shorter = F.expr(f"shiftleft(1L, cast({BITS} * (shiftright(state, {BITS * DEPTH}) - 1) as int)) - 1")
    suffix = symbols.bitwiseAND(shorter).bitwiseOR(F.expr(f"shiftleft(shiftright(state, {BITS * DEPTH}) - 1, {BITS * DEPTH})"))
    child = rows.filter(length > 0).withColumn("suffix", suffix)
    parent = rows.select(F.col("state").alias("suffix"), "next", F.col("p").alias("q"))
    nats = child.join(parent, ["suffix", "next"]).groupBy("state").agg(F.sum(F.col("p") * F.log(F.col("p") / F.col("q"))).alias("nats"), F.first("total").alias("t"))
    far = nats.filter((F.col("nats") >= MIN_NATS) & (F.col("nats") * F.col("t") >= MIN_TOTAL_NATS)).select("state")
    return rows.join(far, "state", "left_semi").unionByName(rows.filter("state = 0")).select("state", "next", "n")


def _turned(state: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Codes of contexts with the last symbol in front, as many symbols as DEPTH: contexts of equal last symbols are neighbours, and a suffix is a prefix."""
    out = np.zeros(len(state), np.int64)
    for i in range(DEPTH):
        out |= np.where(i < depth, state >> BITS * i & (1 << BITS) - 1, 0) << BITS * (DEPTH - 1 - i)
    return out


class Shard:
    """Scoring table of the contexts whose last two symbols lie in a range, with the shorter ones: for each of them and each kind of symbol the log10 probability.

    Kinds: one for each symbol that the root has seen, one for all others.
    """

    def __init__(self, state: np.ndarray, nxt: np.ndarray, n: np.ndarray):
        names = np.unique(np.r_[0, state])  # the root is there without training, too
        row = np.searchsorted(names, state)
        depth = names >> (BITS * DEPTH)
        code, total = _turned(names, depth), np.bincount(row, n, len(names))
        seen = np.unique(nxt[state == 0])
        self.kind = np.full(1 << BITS, len(seen), np.int16)
        self.kind[seen] = np.arange(len(seen))
        prob = np.zeros((len(names), len(seen) + 1))
        counts = np.zeros_like(prob)
        np.add.at(counts, (row, self.kind[nxt]), n)
        self.levels = []
        for d in range(DEPTH + 1):
            own = np.flatnonzero(depth == d)
            if d == 0:
                prob[own] = (counts[own] + FLOOR) / (total.take(own).sum() + 257 * FLOOR)
            elif len(own):
                back = self.rows(code[own])  # the longest retained suffix among the shorter ones
                weight = total[own][:, None] + SMOOTHING
                prob[own] = (counts[own] + SMOOTHING * prob[back]) / weight
            order = np.argsort(code[own], kind="stable")
            self.levels.append((code[own][order], own[order].astype(np.int32)))
        self.cost = np.log10(prob).astype(np.float32)

    @property
    def nbytes(self) -> int:
        return self.cost.nbytes + sum(c.nbytes + r.nbytes for c, r in self.levels)

    def rows(self, context: np.ndarray) -> np.ndarray:
        """The row of the longest retained suffix of each turned context."""
        out = np.full(len(context), self.levels[0][1][0], np.int64)
        open_ = np.arange(len(context))
        for d in range(len(self.levels) - 1, 0, -1):
            codes, own = self.levels[d]
            if not len(codes) or not len(open_):
                continue
            shift = BITS * (DEPTH - d)
            want = context[open_] >> shift << shift
            at = np.minimum(np.searchsorted(codes, want), len(codes) - 1)
            hit = codes[at] == want
            out[open_[hit]] = own[at[hit]]
            open_ = open_[~hit]
        return out

    def costs(self, context: np.ndarray, nxt: np.ndarray) -> np.ndarray:
        """log10 probability of each symbol after its turned context; contexts come sorted."""
        if not len(context):
            return np.zeros(0)
        first = np.flatnonzero(np.r_[True, context[1:] != context[:-1]])
        rows = np.repeat(self.rows(context[first]), np.diff(np.r_[first, len(context)]))
        return self.cost[rows, self.kind[nxt]].astype(float)


class Shards:
    """Shards by ranges of the last two symbols. `loads` gives a shard; those that fit in KEEP_BYTES together stay loaded."""

    def __init__(self, ends: list[int], loads: list):
        self.ends, self.loads, self.kept, self.size = np.array(ends, np.int64), loads, {}, 0

    def shard(self, k: int) -> Shard:
        if k in self.kept:
            return self.kept[k]
        found = self.loads[k]()
        if self.size + found.nbytes <= KEEP_BYTES:
            self.kept[k], self.size = found, self.size + found.nbytes
        return found

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """log10 probability of each text and its end."""
        out, waiting, owner, n = np.zeros(len(texts)), [], [], 0

        def flush() -> None:
            if not waiting:
                return
            grams, of = np.concatenate(waiting), np.concatenate(owner)
            order = np.argsort(grams, kind="stable")
            sorted_ = grams[order]
            first = np.flatnonzero(np.r_[True, sorted_[1:] != sorted_[:-1]])
            one = sorted_[first]
            context, nxt = one >> BITS, one & (1 << BITS) - 1
            cost = np.zeros(len(one))
            cuts = np.searchsorted(context >> BITS * (DEPTH - 2), self.ends)
            for k, (a, b) in enumerate(zip(np.r_[0, cuts], np.r_[cuts, len(one)])):
                if b > a:
                    cost[a:b] = self.shard(k).costs(context[a:b], nxt[a:b])
            each = np.repeat(cost, np.diff(np.r_[first, len(sorted_)]))
            np.add(out, np.bincount(of[order], each, len(texts)), out=out)
            waiting.clear()
            owner.clear()

        for i, t in enumerate(texts):
            for at in range(0, len(t) + 1, BLOCK):
                # A piece of a long text begins with the symbols before it.
                body = np.frombuffer(t, np.uint8, min(BLOCK, len(t) - at) if at < len(t) else 0, at).astype(np.int64) + 1
                before = np.frombuffer(t[max(0, at - DEPTH) : at], np.uint8).astype(np.int64) + 1
                x = np.concatenate([np.zeros(DEPTH - len(before), np.int64), before, body, np.full(int(at + BLOCK > len(t)), END, np.int64)])
                g = x[DEPTH:].copy()
                for j in range(1, DEPTH + 1):
                    g |= x[DEPTH - j : len(x) - j] << BITS * (DEPTH + 1 - j)
                waiting.append(g)
                owner.append(np.full(len(g), i, np.int32))
                n += len(g)
                if n >= BLOCK:
                    flush()
                    n = 0
        flush()
        return out


def shard_ends(kept: DataFrame, most: int | None = None) -> list[int]:
    """Ranges of the last two symbols (as one number) with about equally many states: the first number of each range after the first. The numbers of states are at most 257 x 257 rows."""
    last, second = F.col("state").bitwiseAND(F.lit((1 << BITS) - 1)), F.shiftright("state", BITS).bitwiseAND(F.lit((1 << BITS) - 1))
    deep = kept.filter(F.shiftright("state", BITS * DEPTH) >= 2).select("state", (last * (1 << BITS) + second).alias("pair"))
    sizes, ends, total = deep.groupBy("pair").agg(F.count_distinct("state").alias("n")).orderBy("pair").toArrow(), [], 0
    for pair, n in zip(sizes["pair"].to_pylist(), sizes["n"].to_pylist()):
        if total and total + n > (most or SHARD_STATES):
            ends.append(pair)
            total = 0
        total += n
    return ends


def shard_tables(kept: DataFrame, ends: list[int]) -> DataFrame:
    """shard and data (its tables, pickled): one task builds each shard of the contexts of its pairs and all of less than two symbols."""
    last, second = F.col("state").bitwiseAND(F.lit((1 << BITS) - 1)), F.shiftright("state", BITS).bitwiseAND(F.lit((1 << BITS) - 1))
    pair, every = last * (1 << BITS) + second, F.sequence(F.lit(0), F.lit(len(ends)))
    own = sum(((pair >= e).cast("int") for e in ends), F.lit(0))
    rows = kept.select("state", "next", "n", F.explode(F.when(F.shiftright("state", BITS * DEPTH) < 2, every).otherwise(F.array(own))).alias("shard"))

    def build(f: pd.DataFrame) -> pd.DataFrame:
        shard = Shard(*(f[c].to_numpy(np.int64) for c in ("state", "next", "n")))
        return pd.DataFrame({"shard": [f["shard"].iat[0]], "data": [pickle.dumps(vars(shard), 5)]})

    return rows.groupBy("shard").applyInPandas(build, "shard int, data binary")


def loaded(data: bytes) -> Shard:
    shard = Shard.__new__(Shard)
    shard.__dict__.update(pickle.loads(data))
    return shard


NO_SHARD = pickle.dumps(vars(Shard(*(np.zeros(0, np.int64),) * 3)), 5)


def word_counts(train: DataFrame, text_col: str = "text") -> DataFrame:
    """token, n over all texts of train; the empty token stands for a text's end."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for b in batches:
            for t in b["_text"]:
                seen.update(lowered(t).split())
                if len(seen) > FLUSH:
                    yield pd.DataFrame({"token": [w.decode() for w in seen], "n": list(seen.values())})
                    seen.clear()
            if len(b):
                seen[b""] += len(b)
        if seen:
            yield pd.DataFrame({"token": [w.decode() for w in seen], "n": list(seen.values())})

    rows = train.select(text_of(text_col).alias("_text")).mapInPandas(run, "token string, n long")
    return rows.groupBy("token").agg(F.sum("n").alias("n"))


def _loaded(b: Broadcast) -> Shard:
    """A shard from its broadcast, which the worker then forgets; what stays loaded is for Shards to say."""
    found = loaded(b.value)
    b.__dict__.pop("_value", None)
    return found


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, held_out, n_tokens, n_known, train_tokens, base_score and score. Rows where held_out holds teach nothing.

    A null text is empty: its end is its only token. Without training rows every token costs the same. Repeated rows stay. Extra columns are not read.

    Words above a fixed share of all tokens are looked up in a broadcast table of bounded size. The others, each in few places, are
    shuffled to the table of all counts; what they add to a document is summed up on the way back. Shards are built by tasks and broadcast each on its own, of bounded
    size; a tree of any number of shards is scored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"), held_out.alias("_held_out"))
    train = rows.filter(~F.col("_held_out"))
    counts = stored(word_counts(train, "_text"))
    n, v = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    base = math.log10(n + 0.5 * (v + 1))
    common = counts.filter(F.col("n") > n / TABLE_ENTRIES).select("token", "n").toArrow()
    contexts = stored(context_counts(train, "_text"))
    kept = stored(retained(contexts))
    ends = shard_ends(kept)
    frequent = spark.sparkContext.broadcast((common["token"].combine_chunks(), common["n"].to_numpy()))
    tables = stored(shard_tables(kept, ends))

    def table(k: int) -> bytes:
        found = tables.filter(F.col("shard") == k).select("data").toArrow()["data"]
        return found[0].as_py() if len(found) else NO_SHARD

    tree = [spark.sparkContext.broadcast(table(k)) for k in range(len(ends) + 1)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens, numbers = frequent.value
        common = dict(zip((t.encode() for t in tokens.to_pylist()), np.log10(numbers + 0.5).tolist()))
        number = TaskContext.get().partitionId() << 36
        model = Shards(ends, [lambda b=b: _loaded(b) for b in tree])
        for b in (b.iloc[at : at + ROWS] for b in batches for at in range(0, len(b), ROWS)):
            texts = [lowered(t) for t in b["_text"]]
            cols = {c: [] for c in ("uid", "token", "tf", "n_tokens", "n_known", "log_sum")}
            for t in texts:
                words = t.split()
                words.append(b"")
                got = list(map(common.get, words))
                rare = Counter(w for w, x in zip(words, got) if x is None)
                logs = [x for x in got if x is not None]
                own = {"uid": number, "token": f" {number}", "tf": 0, "n_tokens": len(words), "n_known": len(logs), "log_sum": math.fsum(logs)}
                for c, x in own.items():
                    cols[c].append(x)
                cols["uid"] += [number] * len(rare)
                cols["token"] += [w.decode() for w in rare]
                cols["tf"] += rare.values()
                for c in ("n_tokens", "n_known", "log_sum"):
                    cols[c] += [0] * len(rare)
                number += 1
            out = pd.DataFrame(cols)
            first = out["tf"] == 0
            out["score"], out["held_out"], out["id"] = np.nan, None, None
            out.loc[first, "score"] = model.scores(texts)
            out["held_out"] = out["held_out"].astype(object)
            out.loc[first, "held_out"] = b["_held_out"].to_numpy()
            out.loc[first, "id"] = b["_id"].astype(object).where(b["_id"].notna(), None).to_numpy()
            yield out

    kind = dict(docs.dtypes)[id_col]
    found = rows.mapInPandas(run, f"uid long, token string, tf long, n_tokens long, n_known long, log_sum double, score double, held_out boolean, id {kind}")
    met = found.join(counts.withColumnRenamed("n", "c"), "token", "left")
    c = F.coalesce("c", F.lit(0))
    mine = F.col("tf") == 0
    summed = met.groupBy("uid").agg(
        F.max(F.when(mine, F.col("id"))).alias(id_col), F.max(F.when(mine, F.col("held_out"))).alias("held_out"), F.sum("n_tokens").alias("n_tokens"),
        F.sum(F.col("n_known") + F.when(c > 0, F.col("tf")).otherwise(0)).alias("n_known"), F.sum(F.col("log_sum") + F.col("tf") * F.log10(c + 0.5)).alias("logs"),
        F.max(F.when(mine, F.col("score"))).alias("score"),
    )
    return summed.select(id_col, "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), (F.col("logs") - F.col("n_tokens") * base).alias("base_score"), "score")
