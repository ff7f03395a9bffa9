"""Versions: immutable folders of tables, visible once a pointer names them. A version may be whole, or composed of groups that are each served from the run they last passed in."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.operators.checks import compose


def build_version(spark: SparkSession, root: str, version: str, staged: dict[str, DataFrame], lists: dict[str, int] | None = None) -> DataFrame:
    """Writes every table of a version, reads each back, and points CURRENT at it only if all counts agree. Returns one row per table: name, rows, path.

    A version is never overwritten, and a failed one is never pointed at: readers see the last good one. `lists` holds the counts that the caller expects;
    where it has none, the staged table is counted. CURRENT is a table of pointers that only grows, one small file each; the newest is the version served.
    """
    rows = []
    for name, df in staged.items():
        path = f"{root}/versions/{version}/{name}"
        df.write.mode("errorifexists").parquet(path)
        want = (lists or {}).get(name)
        want, got = df.count() if want is None else want, spark.read.parquet(path).count()
        if want != got:
            raise ValueError(f"{name}: {want} rows staged, {got} written; {version} is not published")
        rows.append((name, got, path))
    out = spark.createDataFrame(rows, "table_name string, n_rows long, path string")
    pointer = spark.range(1).select(F.lit(version).alias("version"), F.current_timestamp().alias("published_at"))
    pointer.coalesce(1).write.mode("append").parquet(f"{root}/CURRENT")
    return out


def current_version(spark: SparkSession, root: str) -> str:
    """The version published last."""
    return spark.read.parquet(f"{root}/CURRENT").orderBy(F.desc("published_at"), F.desc("version")).first()["version"]


def served(spark: SparkSession, root: str, table: str, version: str | None = None) -> DataFrame:
    """A table of a version, by default the current one."""
    return spark.read.parquet(f"{root}/versions/{version or current_version(spark, root)}/{table}")


# Versions by group


COMPOSITION = "source_group string, outcome string, source_run string, reason string, table_name string, path string, n_rows long"
#: Outcomes of a group whose tables a version serves.
SERVED = ("published", "carried_forward", "not_run")


def composition(spark: SparkSession, root: str, version: str | None = None) -> DataFrame | None:
    """A version's rows, one for each group and table: outcome, the run that the data are of, why it isn't this one, path. By default of the current version; None before the first."""
    try:
        version = version or current_version(spark, root)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return spark.read.schema(COMPOSITION).parquet(f"{root}/compositions/{version}")


def publish_groups(spark: SparkSession, root: str, run_id: str, staged: dict[str, dict[str, DataFrame]], verdicts: DataFrame, groups: list[str]) -> DataFrame:
    """Publishes a run's groups by their verdicts (source_group, verdict) and returns the composition.

    staged: the tables of the groups that the run attempted. Tables of groups that passed are written and read back, and their counts must agree. A group that is blocked, failed or without a
    verdict, or that wasn't attempted, stays on the run it was served from, without a copy: its rows name the former paths. A run in which no group passes publishes nothing: the
    composition is returned, CURRENT stays. A run is written once. The composition is one small file, and CURRENT is switched to it last, so readers see the old
    version or the new one, whole.
    """
    stray = sorted(set(staged) - set(groups))
    if stray:
        raise ValueError(f"groups that aren't declared: {stray}")
    before = composition(spark, root)
    rows = [] if before is None else [r for r in before.collect() if r["path"] is not None]
    names = lambda xs: spark.createDataFrame([(x,) for x in xs], "source_group string")
    served_by = spark.createDataFrame(sorted({(r["source_group"], r["source_run"]) for r in rows}), "source_group string, run_id string")
    planned = compose(names(groups), verdicts.select("source_group", "verdict"), names(staged), served_by, run_id).orderBy("source_group").collect()
    out, passed = [], [g for g in planned if g["outcome"] == "published"]
    for g in planned:
        name, tables = g["source_group"], []
        if g["outcome"] == "published":
            for table, df in staged[name].items():
                path = f"{root}/groups/{name}/{run_id}/{table}"
                df.write.mode("errorifexists").parquet(path)
                want, got = df.count(), spark.read.parquet(path).count()
                if want != got:
                    raise ValueError(f"{name}.{table}: {want} rows staged, {got} written; {run_id} is not published")
                tables.append((table, path, got))
        else:
            tables = [(r["table_name"], r["path"], r["n_rows"]) for r in rows if r["source_group"] == name]
        out += [(name, g["outcome"], g["source_run"], g["reason"], *t) for t in tables or [(None, None, None)]]
    made = spark.createDataFrame(out, COMPOSITION)
    if passed:
        made.coalesce(1).write.mode("errorifexists").parquet(f"{root}/compositions/{run_id}")
        pointer = spark.range(1).select(F.lit(run_id).alias("version"), F.current_timestamp().alias("published_at"))
        pointer.coalesce(1).write.mode("append").parquet(f"{root}/CURRENT")
    return made


def served_group(spark: SparkSession, root: str, group: str, table: str, version: str | None = None) -> DataFrame:
    """A group's table as a version serves it, whichever run it is of."""
    rows = composition(spark, root, version)
    found = [] if rows is None else rows.filter((F.col("source_group") == group) & (F.col("table_name") == table)).collect()
    if not found:
        raise ValueError(f"{group}.{table} is not served")
    return spark.read.parquet(found[0]["path"])
