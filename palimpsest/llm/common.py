"""Small helpers that the operators share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: The characters \\x09-\\x0D and \\x20.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str) -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(col), F.lit(""))


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(c, UPPER, LOWER)


def remainder(id_col: str, by: int) -> Column:
    """crc32 of the id written as text, modulo `by`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % by


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder in spark.checkpoint.dir; only where it is unset and all runs on one machine, as in tests, a temporary one."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = sc.getConf().get("spark.checkpoint.dir")
        if not named and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoint-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Computed once and kept in the shared checkpoint folder; later plans start from there."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, *partition_by: str) -> DataFrame:
    """Written as Parquet in the shared folder and read again, so that its readers can prune columns."""
    path = f"{checkpoint_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Rows with `pos`, their place from 0 among the rows of equal `by` in the order of `order` (nulls first), and `n`, how many those are.

    Rows are dealt out by ranges of all these columns and sorted there, so a group of any size is spread over tasks; places within a range
    are stored, and what stands before each range comes from one count a range and group. Rows equal in all these columns stand in any order.
    """
    ranged = df.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order)
    placed = stored(ranged.withColumn("_at", F.monotonically_increasing_id())).withColumn("_range", F.shiftright("_at", 33))
    held = Window.partitionBy(*by)
    starts = placed.groupBy(*by, "_range").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    starts = starts.select(
        *(F.col(c).alias(f"_{c}_of") for c in by), F.col("_range").alias("_range_of"), F.sum("_n").over(held).alias("n"),
        (F.coalesce(F.sum("_n").over(held.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    on = F.col("_range") == F.col("_range_of")
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"_{c}_of"))
    return placed.join(starts, on).select(*df.columns, (F.col("_at") + F.col("_shift")).alias("pos"), "n")
