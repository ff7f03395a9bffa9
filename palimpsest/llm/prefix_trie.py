"""Prefix trie of conversations by bursting: shards hold containers of suffixes under trie heads, oversized ones burst by the next turn, the others are sorted and swept into nodes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.llm.common import stored, text_of

#: Characters of a turn's id: role and text as 128 bits. Two turns of 10^12 share one by chance with odds of 10^-15.
WIDE = 32
#: A container of more turns than this, in more than one suffix, bursts.
LIMIT = 2_000
#: Fixed value: what separates words.
GAP = r"[^\x20\x09-\x0D]+"


def conversations(turns: DataFrame) -> DataFrame:
    """Per conv_id its turns in order: `ids`, an array of turn ids, and `words`, one of their word counts.

    Turns (conv_id, turn, role, text) stand by turn (null first), those of one turn by role and text; null role or text is empty, repeated rows are turns of their own.
    Rows without conv_id belong to no conversation and are left out; other columns are not read. Texts are shuffled once, to be sorted; a conversation itself is
    one row of 40 bytes a turn.
    """
    role, text = text_of("role"), text_of("text")
    rows = turns.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("_turn"), role.alias("_role"), text.alias("_text"),
        F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)).alias("id"), F.regexp_count(text, F.lit(GAP)).alias("words"),
    )
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("_turn", "_role", "_text"))
    seq = F.array_sort(F.collect_list(F.struct("place", "id", "words")))
    found = rows.select("conv_id", place.alias("place"), "id", "words").groupBy("conv_id").agg(seq.alias("s"))
    return found.select("conv_id", F.transform("s", lambda x: x["id"]).alias("ids"), F.transform("s", lambda x: x["words"]).alias("words"))


def rebuilt(convs: DataFrame, block: int = 20, most: int = 3) -> DataFrame:
    """Conversations with shared beginnings: the first h turns are those of conversation c - c % block (all if fewer, none if absent), then c's own after its first h; h = crc32(c) % (most + 1)."""
    n = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)).cast("int")
    heads = convs.filter(F.col("conv_id") % block == 0).select(F.col("conv_id").alias("_of"), F.slice("ids", 1, most).alias("_ids"), F.slice("words", 1, most).alias("_words"))
    met = convs.withColumn("_n", n).join(heads, F.col("conv_id") - F.col("conv_id") % block == F.col("_of"), "left")

    def joined(head: str, own: str, kind: str) -> Column:
        return F.concat(F.coalesce(F.slice(head, F.lit(1), F.col("_n")), F.expr(f"CAST(array() AS array<{kind}>)")), F.slice(own, F.col("_n") + 1, F.size(own)))

    return met.select("conv_id", joined("_ids", "ids", "string").alias("ids"), joined("_words", "words", "int").alias("words"))


def _key(seq: Column, depth: Column) -> Column:
    """Key of the trie node that a prefix of so many turns leads to."""
    return F.md5(F.substring(seq, F.lit(1), depth * WIDE))


def burst(suffixes: DataFrame, limit: int = LIMIT) -> tuple[DataFrame, DataFrame]:
    """Suffixes with the depth of the container that holds them, and the heads that burst.

    suffixes: id (digest of seq), seq (turn ids as one text), size (turns), words, n, conv (members and the smallest of them). All stand in the root's container at first. A container of more than `limit`
    turns in more than one suffix becomes a head, and its suffixes go on by their next turn into containers one turn deeper; those that end there belong to the
    head (depth size + 1). Each round bursts twice as many levels as the one before, over what is still oversized; so rounds grow with the logarithm of the longest shared beginning.
    Counts are combined before their shuffle.

    Returns (suffixes with depth and head_conv, the smallest member of the head above), (heads: key, depth, seq, words of its last turn, n, conv).
    """
    rows, done, heads, step = suffixes.withColumns({"depth": F.lit(0), "head_conv": F.lit(None).cast("long")}), None, None, 1
    while True:
        levels = F.sequence(F.col("depth"), F.least(F.col("depth") + step - 1, F.col("size")))
        each = rows.select("id", "seq", "size", "n", "conv", "words", F.explode(levels).alias("at")).withColumn("key", _key(F.col("seq"), F.col("at")))
        # A level may only burst if the levels above it do; sizes fall along a path, so that holds by itself.
        large = each.groupBy("at", "key").agg(
            F.sum(F.col("size") - F.col("at") + 1).alias("turns"), F.count("*").alias("suffixes"), F.sum("n").alias("n"), F.min("conv").alias("conv"),
            F.first(F.substring("seq", F.lit(1), F.col("at") * WIDE)).alias("prefix"), F.first(F.when(F.col("at") > 0, F.get("words", F.col("at") - 1)).otherwise(0)).alias("own"),
        )
        large = stored(large.filter((F.col("turns") > limit) & (F.col("suffixes") > 1)).select(F.col("at").alias("depth"), "key", F.col("prefix").alias("seq"), F.col("own").alias("words"), "n", "conv"))
        heads = large if heads is None else heads.unionByName(large)
        if large.isEmpty():
            done = rows if done is None else done.unionByName(rows)
            return done, heads
        # How many levels of a suffix's path burst. Stored, so that the next round starts from there.
        found = large.select(F.col("depth").alias("_at"), F.col("key").alias("_key"), F.col("conv").alias("_conv"))
        hit = each.select("id", "at", "key").join(found, (F.col("at") == F.col("_at")) & (F.col("key") == F.col("_key")))
        hit = hit.groupBy(F.col("id").alias("_id")).agg(F.count("*").cast("int").alias("_deep"), F.max_by("_conv", "_at").alias("_head"))
        met = rows.join(hit, F.col("id") == F.col("_id"), "left").withColumn("open", (F.coalesce("_deep", F.lit(0)) == step) & (F.col("depth") + F.col("_deep") <= F.col("size")))
        met = stored(met.withColumns({"depth": F.col("depth") + F.coalesce("_deep", F.lit(0)), "head_conv": F.coalesce("_head", "head_conv")}).drop("_id", "_deep", "_head"))
        closed, rows = met.filter("NOT open").drop("open"), met.filter("open").drop("open")
        done, step = closed if done is None else done.unionByName(closed), 2 * step


NODE = "conv_id long, depth int, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ended string, top string"
NAMES = [c.split()[0] for c in NODE.split(", ")]


def _sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Containers, one after the other, each with its suffixes in order: nodes by one pass with a stack. Memory: one container's nodes."""
    container, stack, nodes, before = None, [], [], ""

    def close(depth: int) -> None:
        # Open nodes below `depth` have seen all their suffixes: [depth, n, conv, children, leaves, saved below, own words, ended, children's rows].
        while stack and stack[-1][0] > depth:
            d, n, conv, children, leaves, saved, own, ended, below = stack.pop()
            row = [conv, d, head, n, children, leaves or 1, saved + (n - 1) * own, ended, top if d == base else None]
            for child in below:
                child[2] = conv
            nodes.append(row)
            if stack:
                up = stack[-1]
                up[1] += n
                up[2] = min(up[2], conv)
                up[3] += 1
                up[4] += row[5]
                up[5] += row[6]
                up[8].append(row)

    base, head, top = 0, None, ""
    for b in batches:
        for seq, size, words, n, conv, key, depth, above in zip(b["seq"], b["size"], b["words"], b["n"], b["conv"], b["key"], b["depth"], b["head_conv"]):
            shared = -1
            if key == container:
                shared, end = base, min(len(seq), len(before))
                while (at := shared * WIDE) < end and seq[at : at + WIDE] == before[at : at + WIDE]:
                    shared += 1
                close(shared)
            else:
                close(-1)
                if len(nodes) > 10_000:
                    yield pd.DataFrame(nodes, columns=NAMES, dtype=object)
                    nodes.clear()
                container, base, head, top = key, depth, above and int(above), seq[: depth * WIDE]
                shared = base - 1
            for d in range(shared + 1, size + 1):
                stack.append([d, 0, conv, 0, 0, 0, int(words[d - 1]) if d else 0, None, []])
            stack[-1][1] += n
            stack[-1][2] = min(stack[-1][2], conv)
            stack[-1][7] = hashlib.md5(seq.encode()).hexdigest()
            before = seq
    close(-1)
    yield pd.DataFrame(nodes, columns=NAMES, dtype=object)


def _texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted (key, conv_id) rows to one text for each run of a key within a batch."""
    for b in batches:
        out = []
        for key, run in groupby(zip(b["key"], b["conv_id"]), lambda x: x[0]):
            ids = [i for _, i in run]
            out.append((key, ids[0], ",".join(map(str, ids))))
        yield pd.DataFrame(out, columns=["key", "first", "ids"])


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Texts of a key, in order, streamed through one digest: nothing of a key is kept but the digest's state."""
    key, state = None, None
    for b in batches:
        out = []
        for k, ids in zip(b["key"], b["ids"]):
            if k == key:
                state.update(b"," + ids.encode())
            else:
                if state:
                    out.append((key, state.hexdigest()))
                key, state = k, hashlib.sha256(ids.encode())
        yield pd.DataFrame(out, columns=["ended", "ends_sha256"])
    if state:
        yield pd.DataFrame([(key, state.hexdigest())], columns=["ended", "ends_sha256"])


def endings(convs: DataFrame) -> DataFrame:
    """Per node where conversations (conv_id, seq) end: its key (`ended`) and the digest of their ids, ascending. Ids of a node are sorted over many tasks and become texts there; the digest then reads those."""
    rows = convs.select(F.md5("seq").alias("key"), "conv_id")
    texts = rows.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").mapInPandas(_texts, "key string, first long, ids string")
    return texts.repartition("key").sortWithinPartitions("key", "first").mapInPandas(_digests, "ended string, ends_sha256 string")


def trie(convs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Per node of the trie over conversations (conv_id, ids, words): conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    A node is a distinct sequence of first turns, members are the conversations that start with it; the root has depth 0, and conversations without turns end there. n_leaves:
    nodes without children in its subtree; saved_tokens: over its subtree, each node's (n_convs - 1) times the words of its last turn; ends_sha256: of the ids that end there,
    ascending, joined by commas. ids of conversations must be unique. No conversations: no nodes.

    Equal conversations are one suffix with a weight, counted before any shuffle of suffixes. Containers under `limit` turns are sorted and swept whole, spread by key; heads are summed
    from the tops of the containers below them.
    """
    named = stored(convs.select("conv_id", F.array_join("ids", "").alias("seq"), "words"))
    distinct = stored(named.groupBy("seq").agg(F.first("words").alias("words"), F.count("*").alias("n"), F.min("conv_id").alias("conv")).withColumns({"size": F.size("words"), "id": F.md5("seq")}))
    held, heads = burst(distinct, limit)
    # As text, for a column of longs with nulls would reach pandas as floats.
    swept = held.filter("depth <= size").select("seq", "size", "words", "n", "conv", "depth", F.col("head_conv").cast("string").alias("head_conv"), _key(F.col("seq"), F.col("depth")).alias("key"))
    nodes = stored(swept.repartition("key").sortWithinPartitions("key", "seq").mapInPandas(_sweep, NODE))
    # Heads: their own savings and what hangs below them, told to each head above.
    own = heads.select("depth", "seq", F.lit(0).cast("long").alias("leaves"), ((F.col("n") - 1) * F.col("words")).alias("saved"))
    tops = nodes.filter("top IS NOT NULL").select("depth", F.col("top").alias("seq"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"))
    told = own.unionByName(tops).select("*", F.explode(F.sequence(F.lit(0), "depth")).alias("at")).filter("at < depth OR leaves = 0")
    sums = told.groupBy("at", _key(F.col("seq"), F.col("at")).alias("key")).agg(F.count_if(F.col("depth") == F.col("at") + 1).alias("n_children"), F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    upper = heads.select(F.col("depth").alias("_depth"), F.col("key").alias("_key"), F.col("conv").alias("parent_conv_id"))
    above = heads.withColumn("_up", F.when(F.col("depth") > 0, _key(F.col("seq"), F.col("depth") - 1)))
    above = above.join(upper, (F.col("_depth") == F.col("depth") - 1) & (F.col("_key") == F.col("_up")), "left")
    full = above.join(sums.withColumnRenamed("key", "_sum"), (F.col("at") == F.col("depth")) & (F.col("_sum") == F.col("key")))
    inner = full.select(F.col("conv").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children", "n_leaves", "saved_tokens", F.col("key").alias("ended"))
    every = nodes.drop("top").unionByName(inner)
    # Nodes where nothing ends get a key that no ending has, so that they don't meet in one task.
    every = every.withColumn("ended", F.coalesce("ended", F.concat_ws("-", "conv_id", "depth")))
    out = every.join(endings(named), "ended", "left").drop("ended").withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)))
    return out.select("conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
