"""The landing merge, driven by files as they arrive, into a table that is rewritten partition by partition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from palimpsest.operators.merge import held_elsewhere, key_index, merge_into_base

#: Partitions by key where the caller names no column: so many buckets of the key's hash.
BUCKETS = 64
#: Batches whose state stays readable. Files of a partition that none of the last KEEP batches serves are deleted after a commit.
KEEP = 2


class ServedTable:
    """A table in partitions, each of which is served from the batch that wrote it last.

    Under `root`: data/batch=N/part=P holds the partitions that batch N rewrote, index/batch=N their key index, pointers/batch=N one row for every partition of the table as of that
    batch (part, served), ledger/batch=N one row on the batch. Pointers are one small file, written last of all but the ledger; a batch counts once they are there. Everything of a
    batch is in folders of its own number, so a batch that is run again overwrites what it left and nothing else.
    A table has some thousands of partitions at most: their labels and pointers, not their rows, pass through the driver.
    """

    def __init__(self, spark: SparkSession, root: str, schema: StructType, key: list[str], lineage: list[str], part: str | None = None, buckets: int = BUCKETS):
        self.spark, self.root, self.schema, self.key, self.lineage, self.part, self.buckets = spark, root, schema, key, lineage, part, buckets

    def label(self) -> Column:
        """The folder of a row: its partition column as text (in hex where it is no plain word), else the bucket of its key."""
        if self.part is None:
            return F.concat(F.lit("b"), F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("string"))
        text = F.col(self.part).cast("string")
        return F.when(text.isNull(), "null").when(text.rlike("^[0-9][0-9A-Za-z]*$"), text).otherwise(F.concat(F.lit("x"), F.hex(text)))

    def _exists(self, path: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def _delete(self, path: str) -> None:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)

    def pointers(self, before: int | None = None) -> dict[str, int]:
        """Partition and the batch that it is served from, as of the newest batch, or the newest below `before`."""
        if not self._exists(f"{self.root}/pointers"):
            return {}
        rows = self.spark.read.schema("part string, served int, batch int").parquet(f"{self.root}/pointers")
        rows = rows if before is None else rows.filter(F.col("batch") < before)
        newest = rows.agg(F.max("batch")).first()[0]
        return {} if newest is None else {r["part"]: r["served"] for r in rows.filter(F.col("batch") == newest).select("part", "served").collect()}

    def read(self, pointers: dict[str, int]) -> DataFrame:
        """The rows of the named partitions; no other folder is listed."""
        paths = [f"{self.root}/data/batch={b}/part={p}" for p, b in sorted(pointers.items())]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def index(self, pointers: dict[str, int]) -> DataFrame:
        """Key index of the named partitions."""
        rows = self.spark.read.parquet(f"{self.root}/index")
        named = self.spark.createDataFrame(list(pointers.items()), "part string, batch int")
        return rows.join(named, ["part", "batch"]).drop("batch")

    def upsert(self, new: DataFrame, batch: int) -> None:
        """Merges a batch of landings: reads and writes only the partitions that it touches. A key that an untouched partition holds stops it, before anything is written."""
        columns = [f.name for f in self.schema.fields]
        rows = new.select(*columns, self.label().alias("_part"))
        touched = {r[0] for r in rows.select("_part").distinct().collect()}
        if not touched:
            return
        pointers = self.pointers(before=batch)
        others = {p: b for p, b in pointers.items() if p not in touched}
        if self.part is not None and others:
            base = self.read(others)
            moved = held_elsewhere(rows, base.withColumn("_part", self.label()), self.key, "_part", self.index(others)).limit(5).collect()
            if moved:
                raise ValueError(f"keys of other partitions: {[tuple(r) for r in moved]}")
        merged = merge_into_base(rows.select(*columns), self.read({p: b for p, b in pointers.items() if p in touched}), self.key, self.lineage)
        at = f"{self.root}/data/batch={batch}"
        merged.withColumn("part", self.label()).hint("rebalance", "part").write.mode("overwrite").partitionBy("part").parquet(at)
        written = self.spark.read.schema(self.schema).parquet(at).withColumn("_part", self.label())
        counts = written.groupBy("_part").count().collect()
        if self.part is not None:
            key_index(written, self.key, "_part").write.mode("overwrite").parquet(f"{self.root}/index/batch={batch}")
        served = [*others.items(), *((r["_part"], batch) for r in counts)]
        table = self.spark.createDataFrame(served, "part string, served int")
        table.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/pointers/batch={batch}")
        line = self.spark.createDataFrame([(len(touched), sum(r["count"] for r in counts))], "parts int, rows_written long")
        line.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/ledger/batch={batch}")
        self._prune()

    def _prune(self) -> None:
        """Deletes what none of the last KEEP batches serves: partitions' files, and pointers of older batches. The ledger stays whole."""
        rows = self.spark.read.schema("part string, served int, batch int").parquet(f"{self.root}/pointers").select("part", "served", "batch").distinct().collect()
        batches = sorted({r["batch"] for r in rows})
        kept = set(batches[-KEEP:])
        alive = {(r["part"], r["served"]) for r in rows if r["batch"] in kept}
        for part, served in {(r["part"], r["served"]) for r in rows} - alive:
            self._delete(f"{self.root}/data/batch={served}/part={part}")
        for b in set(batches) - kept:
            self._delete(f"{self.root}/pointers/batch={b}")

    def ledger(self) -> DataFrame:
        """One row for every batch that was merged: batch, parts, rows_written."""
        schema = "parts int, rows_written long, batch int"
        return self.spark.read.schema(schema).parquet(f"{self.root}/ledger") if self._exists(f"{self.root}/ledger") else self.spark.createDataFrame([], schema)


def stream_merge(spark: SparkSession, landing_dir: str, target: str, checkpoint: str, key: list[str], lineage: list[str], schema: str, max_files: int | None = None, part: str | None = None) -> DataFrame:
    """Merges all landings that have arrived in `landing_dir` since the last call into the served table under `target`, and returns that table (ServedTable).

    Every micro-batch rewrites the partitions that it touches: those of the column `part`, or buckets of the key. A batch that is run again after a failure reads what was served
    before it and overwrites its own folders, so it is merged once and has one ledger row. Landings must arrive in the order of their lineage. Before any landing the table is empty.
    """
    source = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
    source = source.option("maxFilesPerTrigger", max_files) if max_files else source
    rows = source.parquet(landing_dir)
    table = ServedTable(spark, target, rows.schema, key, lineage, part)

    def merge(batch: DataFrame, batch_id: int) -> None:
        ServedTable(batch.sparkSession, target, table.schema, key, lineage, part).upsert(batch, batch_id)

    rows.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(merge).start().awaitTermination()
    return table.read(table.pointers())
