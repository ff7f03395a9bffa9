"""Raw landings: write-once snapshots with a load record, and the reads and calendars that decide what to load next."""

from __future__ import annotations

import datetime
import tempfile

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

LOADS = "source string, dataset string, run_id string, path string, rows_downloaded long, rows_written long, loaded_at timestamp, note string"


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which driver and executors share; a temporary one only where that is unset and all runs on one machine, as in tests."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = sc.getConf().get("spark.checkpoint.dir")
        if not named and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoint-"))
    return sc.getCheckpointDir()


def scan_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A logical table: all Parquet files under its folder, united by column name."""
    return spark.read.option("mergeSchema", True).parquet(f"{folder}/{table}")


def landing_path(root: str, source: str, dataset: str, run_id: str) -> str:
    return f"{root}/source={source}/dataset={dataset}/run_id={run_id}"


def land_raw(df: DataFrame, root: str, source: str, dataset: str, run_id: str, loaded_at: datetime.datetime, note: str | None = None) -> DataFrame:
    """Writes a snapshot once, with run_id and loaded_at in its rows, and returns its load record.

    A second landing of a run is refused. An empty download is recorded and not written. Rows are counted while they are written and once more in
    the files: the two must agree.
    """
    spark, path = df.sparkSession, landing_path(root, source, dataset, run_id)
    sent = written = 0
    if df.isEmpty():
        path = None
    else:
        seen = Observation()
        rows = df.withColumn("run_id", F.lit(run_id)).withColumn("loaded_at", F.lit(loaded_at).cast("timestamp"))
        rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("errorifexists").parquet(path)
        sent, written = seen.get["n"], spark.read.parquet(path).count()
        if sent != written:
            raise ValueError(f"{path}: {sent} rows sent, {written} in the files")
    return spark.createDataFrame([(source, dataset, run_id, path, sent, written, loaded_at, note)], LOADS)


def raw_snapshots(spark: SparkSession, root: str, source: str, dataset: str, runs: list[str] | None = None, columns: dict[str, str] | None = None) -> DataFrame:
    """All landings of a dataset, or only the named runs (no other folder is listed), united by name. Absent ones of `columns` are added as nulls of their type."""
    paths = [landing_path(root, source, dataset, r) for r in (["*"] if runs is None else runs)]
    df = spark.read.option("mergeSchema", True).parquet(*paths)
    return df.select("*", *(F.lit(None).cast(t).alias(c) for c, t in (columns or {}).items() if c not in df.columns))


def write_partitioned(df: DataFrame, path: str, by: str) -> None:
    """One folder for each value of a column, which stays in the rows too. A value that many rows hold is written by several tasks."""
    df.withColumn("part", F.col(by)).hint("rebalance", "part").write.mode("errorifexists").partitionBy("part").parquet(path)


def file_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Every Parquet file under a path: name, rows, bytes and sha256. Files are hashed whole, one to a task, so each must be below 2 GB."""
    name = lambda c: F.regexp_replace(c, "^file:/+", "/")  # noqa: E731  the two readers write local paths differently
    bytes_of = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    hashed = bytes_of.select(name(F.col("path")).alias("path"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    rows = spark.read.option("recursiveFileLookup", True).option("mergeSchema", True).parquet(path).groupBy(name(F.col("_metadata.file_path")).alias("path")).agg(F.count("*").alias("rows"))
    return hashed.join(rows, "path", "left").select("path", F.coalesce("rows", F.lit(0)).alias("rows"), "bytes", "sha256")


def trading_days(spark: SparkSession, start: Column, end: Column, holidays: DataFrame) -> DataFrame:
    """Weekdays between two dates, both included, without the dates of `holidays` (its first column)."""
    days = spark.range(1).select(F.explode(F.sequence(start, end)).alias("session")).filter(F.weekday("session") < 5)
    return days.join(holidays.select(F.col(holidays.columns[0]).alias("session")).distinct(), "session", "left_anti")


def due_quarters(spark: SparkSession, today: Column, first: Column, landed: DataFrame, recent: int = 2) -> DataFrame:
    """Quarters (YYYYQn) from the first one to today's that were not landed, and the most recent ones whether landed or not."""
    starts = spark.range(1).select(F.explode(F.sequence(F.trunc(first, "quarter"), F.trunc(today, "quarter"), F.expr("INTERVAL 3 MONTH"))).alias("d"))
    every = starts.select("d", F.concat(F.year("d"), F.lit("Q"), F.quarter("d")).alias("quarter"))
    again = every.filter(F.col("d") > F.add_months(F.trunc(today, "quarter"), -3 * recent))
    return every.join(landed.select(F.col(landed.columns[0]).alias("quarter")).distinct(), "quarter", "left_anti").select("quarter").union(again.select("quarter")).distinct()


def past_watermark(df: DataFrame, landed: DataFrame, date_col: str, overlap_days: int) -> DataFrame:
    """Rows dated on or after the latest landed date less the overlap; all rows if nothing was landed."""
    newest = F.broadcast(landed.agg(F.date_sub(F.max(date_col), overlap_days).alias("_from")))
    return df.join(newest, F.col("_from").isNull() | (F.col(date_col) >= F.col("_from"))).drop("_from")


def drop_stale(df: DataFrame, landed: DataFrame, key: str, stamp: str) -> DataFrame:
    """Rows whose stamp isn't older than the newest one landed for their key."""
    newest = landed.groupBy(F.col(key).alias("_key")).agg(F.max(stamp).alias("_newest"))
    return df.join(newest, F.col(key) == F.col("_key"), "left").filter(F.col("_newest").isNull() | (F.col(stamp) >= F.col("_newest"))).drop("_key", "_newest")


def complete_runs(loads: DataFrame, required: list[str]) -> DataFrame:
    """Runs that have a load record for every required dataset."""
    met = loads.filter(F.col("dataset").isin(required)).groupBy("run_id").agg(F.count_distinct("dataset").alias("_n"))
    return met.filter(F.col("_n") == len(set(required))).select("run_id")
