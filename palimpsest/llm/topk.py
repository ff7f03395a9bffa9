"""Exact top-k by inner product: shards of near vectors, a ball tree for each, searched branch and bound under the current k-th score."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.llm.common import stored

#: Rows of a shard (about), points of a leaf.
SHARD_ROWS, LEAF = 8192, 128
#: Coarse cells are fitted on so many rows at most and are so many at most; larger cells are dealt over several shards.
SAMPLE_ROWS, MAX_CELLS = 20_000, 1024
#: Cells that a query visits in each round; the last round takes all that its k-th score still lets through.
ROUNDS = (1, 4, None)
#: The cell of vectors with components too large for exact sums in doubles, which are scored in whole numbers.
LARGE = -1
MOST, LEAST = 2**63 - 1, -(2**63)


def halves(points: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows `at` in two: by the nearer of two far points, or, if one side would be less than a tenth, in the middle between them."""
    own = points[at]
    a = own[((own - own.mean(axis=0)) ** 2).sum(axis=1).argmax()]
    b = own[((own - a) ** 2).sum(axis=1).argmax()]
    along = own @ (b - a)
    order = np.argsort(along, kind="stable")
    cut = int((along < ((a + b) / 2) @ (b - a)).sum())
    if not 0.1 * len(at) <= cut <= 0.9 * len(at):
        cut = len(at) // 2
    return at[order[:cut]], at[order[cut:]]


def coarse_centres(sample: np.ndarray, cells: int) -> np.ndarray:
    """Centres of about `cells` parts of equal numbers of sample rows."""
    parts = [np.arange(len(sample))]
    while len(parts) < cells and max(map(len, parts)) > 1:
        parts.sort(key=len)
        parts += halves(sample, parts.pop())
    return np.array([sample[p].mean(axis=0) for p in parts])


class BallTree:
    """Balls around the halves of a set of points. `scored` counts pairs whose product was taken."""

    def __init__(self, ids: np.ndarray, points: np.ndarray):
        self.ids, self.points, self.nodes, self.scored = ids, points, [], 0
        if len(ids):
            self._build(np.arange(len(ids)))

    def _build(self, at: np.ndarray) -> int:
        own = self.points[at]
        centre = own.mean(axis=0)
        number = len(self.nodes)
        self.nodes.append(None)
        below = tuple(self._build(x) for x in halves(self.points, at)) if len(at) > LEAF else ()
        self.nodes[number] = centre, math.sqrt(((own - centre) ** 2).sum(axis=1).max()), below, at
        return number

    def search(self, query_ids: np.ndarray, queries: np.ndarray, bound: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids of each query's k best, best first, padded with -inf; what scores below a query's bound may be missing.

        Nodes are taken by their highest upper bound, q . centre + |q| radius, and only for the queries whose current k-th score it reaches.
        """
        best = np.full((len(queries), k), -np.inf)
        who = np.full((len(queries), k), MOST)
        if not self.nodes:
            return best, who
        size = np.sqrt((queries ** 2).sum(axis=1))

        def upper(node: int, some: np.ndarray) -> np.ndarray:
            centre, radius, *_ = self.nodes[node]
            return raised(queries[some] @ centre + size[some] * radius)

        def score(leaf: int, some: np.ndarray) -> None:
            at = self.nodes[leaf][3]
            self.scored += len(some) * len(at)
            scores = queries[some] @ self.points[at].T
            scores = np.where(query_ids[some][:, None] == self.ids[at][None, :], -np.inf, scores)
            news = np.flatnonzero((scores >= np.maximum(best[some, -1], bound[some])[:, None]).any(axis=1))
            if len(news):
                s = np.concatenate([best[some[news]], scores[news]], axis=1)
                i = np.concatenate([who[some[news]], np.broadcast_to(self.ids[at], (len(news), len(at)))], axis=1)
                i = np.where(s == -np.inf, MOST, i)
                order = np.lexsort((i, -s), axis=1)[:, :k]
                best[some[news]], who[some[news]] = np.take_along_axis(s, order, 1), np.take_along_axis(i, order, 1)

        every = np.arange(len(queries))
        home, ways = np.zeros(len(queries), int), [(0, every)]
        while ways:  # first each query's own way down, for a k-th score to cut with
            node, some = ways.pop()
            below = self.nodes[node][2]
            if below:
                left = upper(below[0], some) >= upper(below[1], some)
                ways += [(child, mine) for child, mine in ((below[0], some[left]), (below[1], some[~left])) if len(mine)]
            else:
                home[some] = node
                score(node, some)
        heap = [(0.0, 0, every, upper(0, every))]
        while heap:
            _, node, some, reach = heapq.heappop(heap)
            some = some[(reach >= np.maximum(best[some, -1], bound[some]))]
            below = self.nodes[node][2]
            for child in below if len(some) else ():
                reach = upper(child, some)
                heapq.heappush(heap, (-float(reach.max()), child, some, reach))
            if not below:
                some = some[home[some] != node]
                if len(some):
                    score(node, some)
        return best, who


def raised(x: np.ndarray) -> np.ndarray:
    """Upper bounds a little higher, so that rounding cuts no branch."""
    return x + 1e-6 * (1 + np.abs(x))


def whole_scores(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, points: np.ndarray, k: int) -> tuple[list[int], list[int], list[int]]:
    """Row of the query, id and score of each query's k best, in whole numbers; beyond the range of a long its ends stand."""
    a, b = (np.array([[int(x) for x in row] for row in m], object).reshape(len(m), -1) for m in (queries, points))
    out: tuple[list[int], list[int], list[int]] = [], [], []
    for n, q in enumerate(a):
        scores = [(min(MOST, max(LEAST, int(s))), int(i)) for s, i in zip(b @ q, ids) if i != query_ids[n]]
        for s, i in heapq.nsmallest(k, ((-s, i) for s, i in scores)):
            for c, x in zip(out, (n, i, -s)):
                c.append(x)
    return out


def is_large(v: np.ndarray) -> np.ndarray:
    """Rows whose products with each other might not be exact in doubles."""
    return np.abs(v).max(axis=1, initial=0) > math.sqrt(2**53 / max(1, v.shape[1]))


def matrices(column: pd.Series) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions and vectors of each length."""
    dims = column.map(len).to_numpy()
    for d in np.unique(dims):
        at = np.flatnonzero(dims == d)
        yield at, np.array(column.iloc[at].tolist(), float).reshape(len(at), d)


def _deal(batches: Iterator[pd.DataFrame], centres: dict[int, np.ndarray]) -> Iterator[pd.DataFrame]:
    """Each vector with its length, nearest cell and distance to the cell's centre."""
    for b in batches:
        dim, cell, far = (np.zeros(len(b), t) for t in (np.int32, np.int32, float))
        for at, v in matrices(b["v"]) if len(b) else ():
            large = is_large(v)
            own = centres.get(v.shape[1], np.zeros((1, v.shape[1])))
            x = np.where(large[:, None], 0, v)
            nearest = (-2 * x @ own.T + (own ** 2).sum(axis=1)).argmin(axis=1)
            dim[at], cell[at] = v.shape[1], np.where(large, LARGE, nearest)
            far[at] = np.where(large, np.inf, np.sqrt(((x - own[nearest]) ** 2).sum(axis=1)))
        yield b.assign(dim=dim, cell=cell, far=far)


def _visits(batches: Iterator[pd.DataFrame], balls: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]], most: int | None) -> Iterator[pd.DataFrame]:
    """Queries with the cells to visit in this round (`now`), those of the highest upper bounds that reach the query's bound, and all visited so far."""
    for b in batches:
        seen, now = [[]] * len(b), [[]] * len(b)
        bound = b["bound"].to_numpy(float, na_value=-np.inf)
        for at, v in matrices(b["v"]) if len(b) else ():
            if v.shape[1] not in balls:
                continue
            cells, centre, radius = balls[v.shape[1]]
            with np.errstate(over="ignore", invalid="ignore"):
                upper = raised(v @ centre.T + np.sqrt((v ** 2).sum(axis=1))[:, None] * radius)
            upper[:, cells == LARGE] = np.inf
            upper[is_large(v)] = np.inf
            order = np.argsort(-upper, axis=1, kind="stable")
            for n, i in enumerate(at):
                before = set(b["seen"].iat[i])
                some = [int(cells[c]) for c in order[n] if upper[n, c] >= bound[i] and int(cells[c]) not in before][:most]
                now[i], seen[i] = some, [*before, *some]
        yield b.assign(seen=seen, now=now)


def _meet(batches: Iterator[pd.DataFrame], k: int) -> Iterator[pd.DataFrame]:
    """Rows come sorted by shard, a shard's points before its queries: its tree is built once, and its queries stream by."""
    empty = pd.DataFrame({"query_id": [], "id": [], "score": []}, dtype="int64")
    shard, points, tree, large = None, [], None, None
    for b in batches:
        key = list(zip(b["dim"], b["cell"], b["part"], b["side"]))
        ends = [n for n in range(1, len(key)) if key[n] != key[n - 1]] + [len(key)]
        for start, end in zip([0, *ends[:-1]], ends):
            if start == end:
                continue
            rows, (*mine, side) = b.iloc[start:end], key[start]
            if mine != shard:
                shard, points, tree = mine, [], None
            if side == 0:
                points.append(rows)
                continue
            if not points:
                continue
            if tree is None:
                all_points = pd.concat(points)
                x, ids = np.array(all_points["v"].tolist(), float).reshape(len(all_points), -1), all_points["id"].to_numpy(np.int64)
                points, large = [True], shard[1] == LARGE
                tree = BallTree(ids[:0], x[:0]) if large else BallTree(ids, x)
                tree.all_ids, tree.all_points = ids, x
            q, own = np.array(rows["v"].tolist(), float).reshape(len(rows), -1), rows["id"].to_numpy(np.int64)
            bound = rows["bound"].to_numpy(float, na_value=-np.inf)
            slow = is_large(q) | large
            if (~slow).any():
                best, who = tree.search(own[~slow], q[~slow], bound[~slow], k)
                row, col = np.nonzero((best > -np.inf) & (best >= bound[~slow][:, None]))
                yield pd.DataFrame({"query_id": own[~slow][row], "id": who[row, col], "score": best[row, col].astype(np.int64)})
            if slow.any():
                row, who, score = whole_scores(own[slow], q[slow], tree.all_ids, tree.all_points, k)
                yield pd.DataFrame({"query_id": own[slow][row], "id": who, "score": score}, dtype="int64")
    yield empty


def _floor(x: Column) -> Column:
    """Largest whole number not above x, as a double; from 2^52 on every double is whole, and Spark's floor, a long, would not hold them all."""
    return F.when(F.abs(x) < 2**52, F.floor(x).cast("double")).otherwise(x)


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: float = 64.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), id and score of each query's k highest integer inner products, ties to smaller ids; all if there are fewer.

    Components become floor(scale * x). Vectors that are null or hold a null or non-finite component take no part, nor do rows with a null id. A query meets vectors
    of its own length only. Where several query rows share an id, the least of their vectors, by components, is the query; all rows of that id are its own and no candidates of it,
    while for other queries each is one. Scores beyond the range of a long count as its least or largest value. Extra columns are not read.

    Cells are fitted on a bounded sample, but every vector is in one; a cell's shards hold about SHARD_ROWS vectors. A query goes to cells in rounds, those of the highest upper
    bounds first, and leaves out each whose bound lies below its k-th score so far, before any vector moves. In a round each shard's vectors are moved once: a task builds
    their tree and the shard's queries stream by it.
    """
    x = F.col(vector_col)
    whole = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    good = vectors.filter(F.col(id_col).isNotNull() & x.isNotNull()).filter(whole)
    good = good.select(F.col(id_col).cast("long").alias("id"), F.transform(x, lambda e: _floor(e.cast("double") * scale)).alias("v"), is_query.alias("q"))
    n = good.count()
    sample = [r["v"] for r in good.select("v", F.xxhash64("id", "v").alias("at")).orderBy("at").limit(SAMPLE_ROWS).collect()]
    centres = {}
    for at, m in matrices(pd.Series(sample, dtype=object)) if sample else ():
        usual = m[~is_large(m)]
        if len(usual):
            centres[m.shape[1]] = coarse_centres(usual, min(MAX_CELLS, math.ceil(n * len(at) / len(sample) / SHARD_ROWS)))
    dealt = stored(good.mapInPandas(lambda it: _deal(it, centres), "id long, v array<double>, q boolean, dim int, cell int, far double"))
    cells = dealt.groupBy("dim", "cell").agg(F.count("*").alias("n"), F.max("far").alias("far")).collect()
    balls, parts = {}, {(r["dim"], r["cell"]): math.ceil(r["n"] / SHARD_ROWS) for r in cells}
    for d in {r["dim"] for r in cells}:
        own = [r for r in cells if r["dim"] == d]
        known = centres.get(d, np.zeros((1, d)))
        balls[d] = np.array([r["cell"] for r in own]), np.array([known[r["cell"]] if r["cell"] != LARGE else np.zeros(d) for r in own]).reshape(len(own), d), np.array([r["far"] for r in own])
    n_parts = F.create_map(*(F.lit(y) for (d, c), m in parts.items() for y in (f"{d} {c}", m))) if parts else F.create_map(F.lit(""), F.lit(1))
    shards, place = max(1, sum(parts.values())), n_parts[F.concat_ws(" ", "dim", "cell")]
    points = dealt.select("dim", "cell", F.pmod(F.xxhash64("id"), place).cast("int").alias("part"), F.lit(0).alias("side"), "id", "v", F.lit(None).cast("long").alias("bound"))
    asked = dealt.filter("q").groupBy("id").agg(F.min("v").alias("v")).select("id", "v", F.size("v").alias("dim"), F.lit(None).cast("long").alias("bound"), F.array().cast("array<int>").alias("seen"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    found = None
    for most in ROUNDS:
        visits = stored(asked.mapInPandas(lambda it, most=most: _visits(it, balls, most), "id long, v array<double>, dim int, bound long, seen array<int>, now array<int>"))
        going = visits.select("dim", F.explode("now").alias("cell"), "id", "v", "bound").withColumn("part", F.explode(F.sequence(F.lit(0), place - 1))).withColumn("side", F.lit(1))
        wanted = going.select("dim", "cell").distinct()
        both = points.join(F.broadcast(wanted), ["dim", "cell"], "left_semi").select(*points.columns).unionByName(going)
        met = both.repartition(min(shards, 10_000), "dim", "cell", "part").sortWithinPartitions("dim", "cell", "part", "side")
        more = met.mapInPandas(lambda it: _meet(it, k), "query_id long, id long, score long")
        found = stored((more if found is None else found.unionByName(more)).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).drop("rank"))
        kth = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("bound"))
        asked = visits.drop("bound", "now").join(kth, "id", "left").select("id", "v", "dim", "bound", "seen")
    return found.withColumn("rank", F.row_number().over(best)).select("query_id", "rank", F.col("id").alias(id_col), "score")
