"""Merkle manifest of a dataset: a tree of digests for each group, its proofs and their check. Only every few levels are stored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.common import ascii_lower, numbered, remainder, stored

#: Children of a node, and levels that one stored level stands below the next: a stored block holds ARITY ** STEP nodes.
ARITY, STEP = 8, 2
SPAN = ARITY**STEP
#: Characters of a digest.
WIDE = 64


def digest_of(*values: Column) -> Column:
    """Digest of a row: each value is `-` if null, else its UTF-8 byte count, `:` and the value."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts)), 256)


def _parents(digests: Column) -> Column:
    """Digests of a level, as one text, to those of the level above: every ARITY consecutive ones become one."""
    run = ARITY * WIDE
    return F.array_join(F.transform(F.sequence(F.lit(0), F.floor((F.length(digests) - 1) / run).cast("int")), lambda r: F.sha2(F.substring(digests, r * run + 1, F.lit(run)), 256)), "")


def _regenerated(blocks: DataFrame) -> DataFrame:
    """Blocks with the digests of their own levels: d0 are the stored ones, d1 .. those made again from them; a tree of one node has no level above."""
    out, n = blocks.withColumn("d0", F.array_join(F.transform("nodes", lambda x: x["digest"]), "")), F.col("n")
    for s in range(STEP):
        out = out.withColumn(f"d{s + 1}", F.when(n > 1, _parents(F.col(f"d{s}"))).otherwise(F.col(f"d{s}")))
        n = F.ceil(n / ARITY)
    return out


def _blocks(nodes: DataFrame) -> DataFrame:
    """Nodes of one level in blocks of SPAN consecutive ones, stored."""
    grouped = nodes.groupBy("tree", "n", F.floor(F.col("pos") / SPAN).alias("block"))
    return stored(grouped.agg(F.array_sort(F.collect_list(F.struct("pos", "digest", "row"))).alias("nodes")))


def plant(rows: DataFrame, order: list[str]) -> list[DataFrame]:
    """The stored levels, lowest first, of one tree for each value of `tree`; its leaves are the column `digest` in the order of `order`, `row` (a struct) goes with them.

    A stored level is a table of blocks: tree, n (nodes of the tree at that level), block, nodes. The STEP - 1 levels between two stored ones are computed for the upper
    and forgotten. Trees of one hot value of `tree` are dealt out by blocks, which hold at most SPAN nodes.
    """
    nodes, levels = numbered(rows.select("tree", *(c for c in order if c != "digest"), "digest", "row"), ["tree"], order), []
    while True:
        levels.append(_blocks(nodes))
        more = levels[-1].filter(F.col("n") > SPAN)
        if more.isEmpty():
            return levels
        nodes = _regenerated(more).select("tree", F.ceil(F.col("n") / SPAN).alias("n"), F.col("block").alias("pos"), F.col(f"d{STEP}").alias("digest"), F.lit(None).cast("int").alias("row"))


def roots(levels: list[DataFrame]) -> DataFrame:
    """Per tree: its root, and the stored level (`top`) whose one block lies below it."""
    found = [_regenerated(b.filter(F.col("n") <= SPAN)).select("tree", F.col(f"d{STEP}").alias("root"), F.lit(k).alias("top")) for k, b in enumerate(levels)]
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def proofs(levels: list[DataFrame], above: DataFrame) -> DataFrame:
    """Per leaf: row, digest, path and the column `carry` of `above`. above: per tree, the path that continues its root's and what else to carry.

    A path lists, from the leaf up, the siblings before and after the node, each as one text. Each block makes its missing interior digests again from its stored nodes,
    hands its nodes their siblings and forgets the rest; the path above a block is that of the node which it makes on the next stored level.
    """
    tops = stored(roots(levels).withColumnRenamed("tree", "_tree").join(above, F.col("_tree").eqNullSafe(F.col("tree"))).select("_tree", "top", "path", "carry"))
    down = None
    for k in reversed(range(len(levels))):
        begin = tops.filter(F.col("top") == k).select("_tree", F.lit(0).cast("long").alias("_pos"), "path", "carry")
        known = begin if down is None else begin.unionByName(down.select(F.col("tree").alias("_tree"), F.col("pos").alias("_pos"), "path", "carry"))
        met = _regenerated(levels[k]).join(known, F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("block") == F.col("_pos")))
        each = met.select("tree", "n", *(f"d{s}" for s in range(STEP)), "path", "carry", F.posexplode("nodes").alias("i", "node"))
        steps, n = [], F.col("n")
        for s in range(STEP):
            at = F.floor(F.col("i") / ARITY**s).cast("int")
            inner = at % ARITY
            before, after = F.substring(f"d{s}", (at - inner) * WIDE + 1, inner * WIDE), F.substring(f"d{s}", (at + 1) * WIDE + 1, (ARITY - 1 - inner) * WIDE)
            steps.append(F.when(n > 1, F.struct(before.alias("before"), after.alias("after"))))
            n = F.ceil(n / ARITY)
        down = each.select("tree", "node.*", F.concat(F.array_compact(F.array(*steps)), "path").alias("path"), "carry")
        if k:
            down = stored(down.select("tree", "pos", "path", "carry"))
    return down.select("row", "digest", "path", "carry")


def fold(digest: Column, path: Column) -> Column:
    """The root that a leaf's digest and a path lead to."""
    return F.aggregate(path, digest, lambda d, x: F.sha2(F.concat(x["before"], d, x["after"]), 256))


def proof_text(path: Column) -> Column:
    """A path's siblings as one text, level by level, left to right."""
    return F.array_join(F.transform(path, lambda x: F.concat(x["before"], x["after"])), "")


NO_PATH = "CAST(array() AS array<struct<before:string,after:string>>)"


def manifest(docs: DataFrame, columns: list[str], tree_col: str, order_col: str, changed: Column | None = None) -> DataFrame:
    """Per row of docs: the column `order_col`, leaf, subroot (root of its tree), root (of the tree over all subroots), path, and changed_leaf.

    A leaf is the digest of the row's `columns`. Trees stand for the values of tree_col, ordered by it (null first, a tree of its own), leaves by order_col (null first; rows of
    one id by their leaf, equal rows in any order). changed: a column whose digest of a row is carried along as changed_leaf, to test proofs with. No rows: no result.
    Other columns are not read; texts are read once and not shuffled, only digests are.
    """
    leaf = digest_of(*(F.col(c) for c in columns)).alias("digest")
    changed = F.lit(None).cast("string") if changed is None else changed
    own = stored(docs.select(F.col(tree_col).alias("tree"), F.col(order_col).alias("id"), leaf, changed.alias("changed"), F.monotonically_increasing_id().alias("serial")))
    lower = plant(own.select("tree", "id", "digest", "serial", F.struct("id", "changed").alias("row")), ["id", "digest", "serial"])
    upper = plant(roots(lower).select(F.lit(None).cast("string").alias("tree"), F.col("tree").alias("of"), F.col("root").alias("digest"), F.struct(F.col("tree").alias("of")).alias("row")), ["of"])
    start = roots(upper).select("tree", F.expr(NO_PATH).alias("path"), F.struct(F.lit("").alias("subroot"), "root").alias("carry"))
    above = proofs(upper, start).select(F.col("row.of").alias("tree"), "path", F.struct(F.col("digest").alias("subroot"), F.col("carry.root").alias("root")).alias("carry"))
    return proofs(lower, above).select(F.col("row.id").alias(order_col), F.col("digest").alias("leaf"), "carry.subroot", "carry.root", "path", F.col("row.changed").alias("changed_leaf"))


COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def check_tampering(docs: DataFrame) -> DataFrame:
    """Manifest of documents with their proofs' digests; every third row (by crc32 of its id, a null id as the empty text) is checked with its text's A-Z lower-cased."""
    lowered = digest_of(*(ascii_lower(F.col(c)) if c == "text" else F.col(c) for c in COLUMNS))
    rows = manifest(docs, COLUMNS, "lang", "doc_id", F.when(remainder("doc_id", 3) == 0, lowered))
    out = rows.withColumn("folded_root", fold(F.coalesce("changed_leaf", "leaf"), F.col("path")))
    return out.select("doc_id", "leaf", "subroot", "root", F.sha2(proof_text(F.col("path")), 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
