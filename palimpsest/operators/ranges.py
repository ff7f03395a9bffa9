"""Ordered work spread over ranges: running sums, places and exact quantiles in groups of any size."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.sources.raw import shared_folder


def stored(df: DataFrame) -> str:
    """The folder, in the shared one, that the rows were written to as Parquet."""
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


def kept(df: DataFrame) -> DataFrame:
    """Written to the shared folder and read again: later plans start from there, and tasks that are lost don't deal rows out anew."""
    return df.sparkSession.read.schema(df.schema).parquet(stored(df))


def dealt(df: DataFrame, keys: list[str], rows: int = 500_000) -> DataFrame:
    """Dealt out by key into as many parts as the number of rows asks for, about `rows` in each, and no fewer than the session's: what a task sorts doesn't grow with the input. Keys of one value stay together."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, -(-df.count() // rows)), *keys)


def cut(df: DataFrame) -> DataFrame:
    """Computed once and kept in the shared checkpoint folder, without the plan that led to it: for rounds of an iteration."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def running(df: DataFrame, by: list[str], order: list[str | Column], sums: dict[str, str | Column]) -> DataFrame:
    """Rows with running sums, inclusive, over their group in an order, and the groups' totals: `name` and `name_total` for each of `sums` (name: column).

    Rows are dealt out by ranges of the group and the order together and sorted there, so one group may fill as many tasks as there are ranges. Sums run inside a range; what
    stands before it comes from one sum a range and group. Null values add nothing; where only nulls came so far, the sum is null. Rows equal in all of `order` stand in any order.
    """
    values = {f"_v_{n}": F.col(c) if isinstance(c, str) else c for n, c in sums.items()}
    keys = [F.col(c) for c in by]
    ranged = df.withColumns(values).repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    rows = kept(ranged.withColumn("_at", F.monotonically_increasing_id())).withColumn("_range", F.shiftright("_at", 33))
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    before = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy(*by, "_range").agg(*(F.sum(v).alias(v) for v in values))
    parts = parts.select(*(F.col(c).alias(f"_of_{c}") for c in by), F.col("_range").alias("_of"), *(F.sum(f"_v_{n}").over(before).alias(f"_b_{n}") for n in sums), *(F.sum(f"_v_{n}").over(group).alias(f"{n}_total") for n in sums))
    on = F.col("_range") == F.col("_of")
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    inside = Window.partitionBy(*by, "_range").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    own = rows.withColumns({f"_r_{n}": F.sum(f"_v_{n}").over(inside) for n in sums})
    met = own.join(parts, on)
    return met.select(*df.columns, *(x for n in sums for x in (F.coalesce(F.col(f"_b_{n}") + F.col(f"_r_{n}"), f"_b_{n}", f"_r_{n}").alias(n), f"{n}_total")))


def quantiles(df: DataFrame, by: list[str], col: str | Column, probs: dict[str, float]) -> DataFrame:
    """Continuous quantiles of each group by name, exact: the values at the two places around each, found among places that are spread over ranges. Nulls don't count; a group of nulls has null quantiles."""
    value = (F.col(col) if isinstance(col, str) else col).cast("double")
    rows = running(df.select(*by, value.alias("_q")), by, [F.col("_q")], {"_p": F.col("_q").isNotNull().cast("long")})
    place, picks = F.when(F.col("_q").isNotNull(), F.col("_p") - 1), []
    for name, p in probs.items():
        at = (F.col("_p_total") - 1) * F.lit(float(p))
        picks += [F.max(F.when(place == F.floor(at), F.col("_q"))).alias(f"_lo_{name}"), F.max(F.when(place == F.ceil(at), F.col("_q"))).alias(f"_hi_{name}")]
    found = rows.groupBy(*by).agg(F.max("_p_total").alias("_n"), *picks)

    def between(name: str, p: float) -> Column:
        at, lo, hi = (F.col("_n") - 1) * F.lit(float(p)), F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        return F.when(lo == hi, lo).otherwise((F.ceil(at) - at) * lo + (at - F.floor(at)) * hi).alias(name)

    return found.select(*by, *(between(n, p) for n, p in probs.items()))
