"""Merges of landings: which row is the newest value of its key, and since which landing."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.operators.joins import null_safe_join


def _values(df: DataFrame, key: list[str], lineage: list[str]) -> list[str]:
    return [c for c in df.columns if c not in key and c not in lineage]


def dedup_lineage(df: DataFrame, values: list[str], run: str) -> DataFrame:
    """Rows equal in all but lineage are one, that of the earliest run; the same key with other values stays."""
    w = Window.partitionBy(*values).orderBy(run)
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def landing_conflicts(df: DataFrame, key: list[str], lineage: list[str], run: str = "run_id") -> DataFrame:
    """Keys that hold more than one set of values inside one landing."""
    values = F.struct(*_values(df, key, lineage))
    return df.groupBy(*key, run).agg(F.count_distinct(values).alias("value_sets")).filter("value_sets > 1")


def merge_newest(rows: DataFrame, key: list[str], lineage: list[str]) -> DataFrame:
    """Newest values of every key, with the lineage of the first landing of its last unbroken run of those values."""
    values = F.struct(*_values(rows, key, lineage))
    by = Window.partitionBy(*key)
    before = F.lag(values).over(by.orderBy(*lineage))
    changed = rows.withColumn("_starts", F.coalesce(~values.eqNullSafe(before), F.lit(True)))
    at = F.struct(*lineage)
    last = changed.withColumn("_last", F.max(F.when(F.col("_starts"), at)).over(by))
    return last.filter(F.col("_starts") & (at == F.col("_last"))).drop("_starts", "_last")


def merge_into_base(new: DataFrame, base: DataFrame, key: list[str], lineage: list[str]) -> DataFrame:
    """Served base with new landings: keys that they touch are collapsed again, all others pass through. The same as reading every landing."""
    touched = merge_newest(null_safe_join(base, new, key, "semi").unionByName(new), key, lineage)
    return null_safe_join(base, new, key, "anti").unionByName(touched)


#: So many partitions are named in a filter; landings that touch more are joined to them by label.
NAMED_PARTITIONS = 1000
#: Keys to a word of 64 bits in a Bloom filter (16 bits a key, four of them set), words that a filter has at most, and words of all filters that are broadcast at most (64 MB).
WORD_KEYS, WORDS, BROADCAST_WORDS = 4, 1 << 20, 1 << 23


def _word(key: list[str], mask: Column) -> tuple[Column, Column]:
    """The word of a filter (of mask + 1 words, a power of two) that a key's bits stand in, and these bits. Null is a key like any other."""
    h, g = F.xxhash64(*key), F.xxhash64(F.lit(1), *key)
    bits = F.lit(0).cast("long")
    for k in range(4):
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(g, 6 * k).bitwiseAND(F.lit(63)).cast("int")))
    return h.bitwiseAND(mask), bits


def key_index(base: DataFrame, key: list[str], part: str) -> DataFrame:
    """Per partition of the base: part, n (rows), lo and hi (of the first key column), mask and words of a Bloom filter over its keys. Kept beside the partition, it says what the partition can't hold.

    A filter has a word for every WORD_KEYS keys, as a power of two and at most WORDS; beyond that it lets more keys pass, which the base's files then decide.
    """
    sizes = base.groupBy(part).agg(F.count("*").alias("n"), F.min(key[0]).alias("lo"), F.max(key[0]).alias("hi"))
    mask = F.least(F.pow(F.lit(2), F.ceil(F.log2(F.greatest(F.col("n") / WORD_KEYS, F.lit(1.0))))).cast("long"), F.lit(WORDS)) - 1
    sizes = sizes.withColumn("mask", mask)
    own = sizes.select(F.col(part).alias("_of"), "mask")
    word, bits = _word(key, F.col("mask"))
    filled = base.join(own, F.col(part).eqNullSafe(F.col("_of"))).select(F.col("_of").alias("part"), word.alias("w"), bits.alias("b"))
    every = filled.unionByName(own.select(F.col("_of").alias("part"), F.explode(F.sequence(F.lit(0).cast("long"), "mask")).alias("w"), F.lit(0).cast("long").alias("b")))
    words = every.groupBy("part", "w").agg(F.bit_or("b").alias("b")).groupBy("part").agg(F.transform(F.array_sort(F.collect_list(F.struct("w", "b"))), lambda x: x["b"]).alias("words"))
    return sizes.join(words, F.col(part).eqNullSafe(F.col("part"))).select(sizes[part].alias("part"), "n", "lo", "hi", "mask", "words")


def may_hold(keys: DataFrame, index: DataFrame, key: list[str]) -> DataFrame:
    """Pairs of a partition (`part`) and a key that it may hold: within its range and in its filter. Keys in no partition are left out, save that about one in 500 passes by chance."""
    word, bits = _word(key, F.col("_mask"))
    rows = index.select("part", F.col("lo").alias("_lo"), F.col("hi").alias("_hi"), F.col("mask").alias("_mask"), F.col("words").alias("_words"))
    inside = F.col(key[0]).isNull() | F.col(key[0]).between(F.col("_lo"), F.col("_hi"))
    met = keys.select(*key).distinct().join(rows, inside)
    return met.filter(F.get("_words", word.cast("int")).bitwiseAND(bits) == bits).select("part", *key)


def held_elsewhere(new: DataFrame, other: DataFrame, key: list[str], part: str, index: DataFrame | None = None) -> DataFrame:
    """Keys of the new rows that `other`, the partitions that they don't touch, hold.

    With an index of those partitions (key_index) its rows are asked first, and files are read only of partitions that may hold a key, which are named in
    the filter. Without one, or where the filters together are too large to broadcast, the keys of all of them are read.
    """
    if index is not None:
        index = index.withColumn("_size", F.col("mask") + 1)
        if (index.agg(F.sum("_size")).first()[0] or 0) <= BROADCAST_WORDS:
            hits = [r[0] for r in may_hold(new, F.broadcast(index), key).select("part").distinct().limit(NAMED_PARTITIONS + 1).collect()]
            if not hits:
                return new.select(*key).limit(0)
            if len(hits) <= NAMED_PARTITIONS:
                other = other.filter(F.col(part).isin(hits) | (F.col(part).isNull() if None in hits else F.lit(False)))
    return null_safe_join(other.select(*key), new, key, "semi")


def merge_partitions(new: DataFrame, base: DataFrame, key: list[str], lineage: list[str], part: str, label: str = "[0-9]{4}Q[1-4]", index: DataFrame | None = None) -> DataFrame:
    """Merged rows of the partitions that the new landings touch; the base is filtered by partition before any shuffle.

    A label that isn't of the pattern stops, and so does a key of the new landings that the base holds in a partition that they don't touch: it would be served twice.
    index: key_index of the base, kept with it; then only partitions that may hold such a key are read for this.
    """
    labels = new.select(part).distinct()
    parts = [r[0] for r in labels.limit(NAMED_PARTITIONS + 1).collect()]
    bad = [p for p in parts if p is None or not re.fullmatch(label, p)][:5]
    if not bad and len(parts) > NAMED_PARTITIONS:
        bad = [r[0] for r in labels.filter(F.col(part).isNull() | ~F.col(part).rlike(f"^({label})$")).limit(5).collect()]
    if bad:
        raise ValueError(f"partition labels: {bad}")
    if len(parts) <= NAMED_PARTITIONS:
        touched, other = base.filter(F.col(part).isin(parts)), base.filter(~F.col(part).isin(parts))
        index = None if index is None else index.filter(~F.col("part").isin(parts))
    else:
        touched, other = base.join(labels, part, "left_semi").select(*base.columns), base.join(labels, part, "left_anti").select(*base.columns)
        index = None if index is None else index.join(labels.withColumnRenamed(part, "part"), "part", "left_anti")
    moved = held_elsewhere(new, other, key, part, index).limit(5).collect()
    if moved:
        raise ValueError(f"keys of other partitions: {[tuple(r) for r in moved]}")
    return merge_into_base(new, touched, key, lineage)


def replace_documents(base: DataFrame, new: DataFrame, changes: DataFrame, entity: str, key: list[str], lineage: list[str]) -> DataFrame:
    """Rows of a changed entity are those of its newest document: unchanged rows keep their lineage, missing ones go. Others stay."""
    values = key + _values(base, key, lineage)
    same = null_safe_join(null_safe_join(base, changes, [entity], "semi"), new, values, "semi")
    return null_safe_join(base, changes, [entity], "anti").unionByName(same).unionByName(null_safe_join(new, base, values, "anti"))


def collapse_conflict(df: DataFrame, key: list[str], attr: str) -> DataFrame:
    """Copies of a key become one row; where they differ in `attr`, it is null and flagged."""
    return df.groupBy(*key).agg(F.when(F.count_distinct(attr) <= 1, F.max(attr)).alias(attr), (F.count_distinct(attr) > 1).alias(f"{attr}_conflict"), F.count("*").alias("copies"))


def repeated_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys held by more than one row."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")


def require_unique(df: DataFrame, key: list[str]) -> DataFrame:
    """df, if no key repeats; else an error with some that do."""
    bad = repeated_keys(df, key).limit(5).collect()
    if bad:
        raise ValueError(f"repeated keys: {[tuple(r) for r in bad]}")
    return df


def entity_digests(rows: DataFrame, entity: str, key: list[str], values: list[str]) -> DataFrame:
    """Per entity `rows` and `digest` of its rows, whatever their order: sums of 64-bit hashes of key and values. Kept in a landing's manifest, it tells whether an entity is the same without its rows."""
    h = F.xxhash64(*key, *values).cast("decimal(38,0)")
    g = F.xxhash64(F.lit(1), *key, *values).cast("decimal(38,0)")
    return rows.groupBy(entity).agg(F.count("*").alias("rows"), F.struct(F.sum(h).alias("h"), F.sum(g).alias("g")).alias("digest"))


def newest_rows(rows: DataFrame, key: list[str], lineage: list[str]) -> DataFrame:
    """Of each key the row of the newest landing; of several there, the one of the largest values."""
    others = [c for c in rows.columns if c not in key and c not in lineage]
    best = rows.groupBy(*key).agg(F.max(F.struct(*lineage, *others)).alias("_b"))
    return best.select(*key, "_b.*").select(*rows.columns)


def changed_entities(current: DataFrame, prior: DataFrame, entity: str, key: list[str], values: list[str], lineage: list[str] | None = None, manifest: DataFrame | None = None) -> DataFrame:
    """Entities with a row that is new or differs from the newest prior landing of its key.

    lineage: columns that order the prior landings, which are reduced to the newest row of each key; without it the prior is one landing. manifest: entity_digests of the prior, kept
    from when it was landed; entities whose digest is the same drop out by it before any row is joined, so only rows of the others are read together.
    """
    rows = current.select(entity, *(c for c in [*key, *values] if c != entity))
    if manifest is not None:
        known = manifest.select(F.col(entity).alias("_entity"), F.col("rows").alias("_rows"), F.col("digest").alias("_digest"))
        own = entity_digests(rows, entity, key, values).join(known, F.col(entity).eqNullSafe(F.col("_entity")), "left")
        differ = own.filter(~(F.col("rows").eqNullSafe(F.col("_rows")) & F.col("digest").eqNullSafe(F.col("_digest")))).select(entity)
        rows = null_safe_join(rows, differ, [entity], "semi")
        prior = null_safe_join(prior, differ, [entity], "semi") if entity in key else prior
    old = newest_rows(prior.select(*key, *values, *lineage), key, lineage) if lineage else prior
    old = old.select(*(F.col(k).alias(f"_{k}") for k in key), F.struct(*values).alias("_old"))
    met = rows.join(old, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key], "left")
    return met.filter(~F.struct(*values).eqNullSafe(F.col("_old"))).select(entity).distinct()


def change_set(changes: DataFrame, existing: DataFrame, entity: str) -> DataFrame:
    """Entities of an incremental change list; a full one adds every entity that exists. The change lists of a run must be of one mode, else an error names the run."""
    if "run_id" in changes.columns:
        mixed = changes.groupBy("run_id").agg(F.count_distinct("mode").alias("n")).filter("n > 1").limit(5).collect()
        if mixed:
            raise ValueError(f"runs of two modes: {[r['run_id'] for r in mixed]}")
    full = changes.filter("mode = 'full'").limit(1).select(F.lit(1).alias("_full"))
    return changes.select(entity).unionByName(existing.select(entity).crossJoin(F.broadcast(full)).select(entity)).distinct()


def classify_pulls(stored: DataFrame, new: DataFrame, key: str, date: str, value: str, tol: float = 1e-5) -> DataFrame:
    """How a pull meets the stored values of its key: bootstrap, no_overlap, incremental, rebase (one common ratio) or correction.

    split_flag: a rebase by a whole number or one over it, as a share split makes. window_extended: the pull goes back beyond the stored dates.
    """
    a = stored.select(key, date, F.col(value).alias("_old"))
    b = new.select(key, date, F.col(value).alias("_new"))
    met = b.join(a, [key, date], "left").withColumn("_r", F.try_divide(F.col("_new"), F.col("_old")))
    known = stored.groupBy(key).agg(F.lit(True).alias("_known"), F.min(date).alias("_since"))
    out = met.groupBy(key).agg(F.count("_r").alias("overlap"), F.min("_r").alias("_lo"), F.max("_r").alias("_hi"), F.min(date).alias("_first")).join(known, key, "left")
    kind = (
        F.when(F.col("_known").isNull(), "bootstrap").when(F.col("overlap") == 0, "no_overlap").when((F.abs(F.col("_lo") - 1) <= tol) & (F.abs(F.col("_hi") - 1) <= tol), "incremental")
        .when(F.col("_hi") - F.col("_lo") <= tol, "rebase").otherwise("correction")
    )
    ratio = F.greatest(F.col("_hi"), F.try_divide(F.lit(1.0), F.col("_lo")))
    split = (kind == "rebase") & (F.round(ratio) >= 2) & (F.abs(ratio - F.round(ratio)) <= tol * ratio)
    return out.select(key, "overlap", kind.alias("kind"), F.coalesce(split, F.lit(False)).alias("split_flag"), F.coalesce(F.col("_first") < F.col("_since"), F.lit(False)).alias("window_extended"))


def stored_basis(raw: DataFrame, key: str, date: str, run: str, full: str) -> DataFrame:
    """Rows of a key from its latest full pull on, the newest run of each date; `full_from` is the first date of that pull."""
    by = Window.partitionBy(key)
    since = raw.withColumn("_full", F.max(F.when(F.col(full), F.col(run))).over(by)).withColumn("full_from", F.min(F.when(F.col(run) == F.col("_full"), F.col(date))).over(by)).filter(F.col(run) >= F.col("_full"))
    w = Window.partitionBy(key, date).orderBy(F.col(run).desc())
    return since.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n", "_full")


def edition_difference(df: DataFrame, by: list[str], edition: str, value: str, early, late, left_out: str | None = None) -> DataFrame:
    """Late edition less early one, by group, without the rows of a left-out class; both are cumulative, so a negative difference stops."""
    rows = df if left_out is None else df.filter(~F.coalesce(F.expr(left_out), F.lit(False)))
    part = lambda e: F.coalesce(F.sum(F.when(F.col(edition) == e, F.col(value))), F.lit(0))
    out = rows.groupBy(*by).agg((part(late) - part(early)).alias("difference"))
    bad = out.filter("difference < 0").limit(5).collect()
    if bad:
        raise ValueError(f"negative differences: {[tuple(r) for r in bad]}")
    return out
