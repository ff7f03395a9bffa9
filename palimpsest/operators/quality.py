"""Quality checks: a check is a query for failing rows, no rows mean it passed."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """id, severity (error or warn), gate (blocks publication) or monitor, source group, the query for failing rows, and the columns that name a row for its acknowledgement."""

    id: str
    severity: str
    gate: bool
    group: str
    failing: Callable[[], DataFrame]
    description: str = ""
    ack_key: tuple[str, ...] = ()

    def __post_init__(self):
        if self.severity not in ("error", "warn"):
            raise ValueError(f"{self.id}: severity is error or warn")


#: The group of checks on a whole run, which block no group.
RUN = "run"
REQUIRED_FIELDS = ("id", "severity", "gate", "group", "description")


def declared_checks(files: dict[str, str], groups: list[str], query: Callable[[str], DataFrame]) -> list[Check]:
    """Checks declared as SQL files (name without ending: text), in order of their ids; query runs a file's SQL.

    A file begins with comment lines `-- field: value`. Fields: id, severity (error, warn), gate (yes, no), group (one of `groups`, or run, which can't gate), description, and, for warnings only,
    ack_key: comma list of columns. The file is named by its id, or that and `_` and a name. No file, a repeated id or any other defect stops with all defects found.
    """
    found, defects = [], [] if files else ["no checks"]
    for name, text in sorted(files.items()):
        head = {}
        for line in text.splitlines():
            field = re.fullmatch(r"--[ \t]*([A-Za-z_]+)[ \t]*:[ \t]*(\S.*)", line.rstrip())
            if field is None:
                break
            head[field[1]] = field[2]
        wrong = [f"no {f}" for f in REQUIRED_FIELDS if f not in head]
        if not wrong:
            keys = tuple(k for k in (x.strip() for x in head.get("ack_key", "").split(",")) if k)
            rules = {
                f"severity {head['severity']}": head["severity"] not in ("error", "warn"), f"gate {head['gate']}": head["gate"] not in ("yes", "no"), f"group {head['group']}": head["group"] not in (*groups, RUN),
                "a check on the run can't gate": head["group"] == RUN and head["gate"] == "yes", "only a warning's rows can be acknowledged": bool(keys) and head["severity"] != "warn",
                f"named {name}, id {head['id']}": name != head["id"] and not re.fullmatch(re.escape(head["id"]) + "_[A-Za-z0-9_]+", name),
            }
            wrong = [what for what, broken in rules.items() if broken]
        defects += [f"{name}: {what}" for what in wrong]
        if not wrong:
            sql = text.strip().rstrip(";")
            found.append(Check(head["id"], head["severity"], head["gate"] == "yes", head["group"], lambda sql=sql: query(sql), head["description"], keys))
    ids = [c.id for c in found]
    defects += [f"id {i} repeats" for i in sorted({i for i in ids if ids.count(i) > 1})]
    if defects:
        raise ValueError("; ".join(defects))
    return sorted(found, key=lambda c: c.id)


def check_files(spark: SparkSession, folder: str) -> dict[str, str]:
    """The .sql files of a folder, by name without ending; they are configuration, a few kilobytes each."""
    rows = spark.read.option("pathGlobFilter", "*.sql").text(folder, wholetext=True).select("value", "_metadata.file_name").collect()
    return {r["file_name"].removesuffix(".sql"): r["value"] for r in rows}


def failing_keys(spark: SparkSession, checks: list[Check]) -> DataFrame:
    """check_id and ack_key of the failing rows of all checks that have an ack_key: its columns as text, joined by `|`, null as the empty text."""
    out = spark.createDataFrame([], "check_id string, ack_key string")
    for c in checks:
        if c.ack_key:
            text = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in c.ack_key]
            out = out.unionByName(c.failing().select(F.lit(c.id).alias("check_id"), F.concat_ws("|", *text).alias("ack_key")))
    return out


RESULTS = "check_id string, source_group string, severity string, gate boolean, status string, failing_rows long, sample string"


def run_checks(spark: SparkSession, checks: list[Check], sample: int = 20) -> DataFrame:
    """One row per check: passed, failed with its severity, or broken if its query can't run. One pass counts a check's rows; of failing ones a bounded sample is read, as JSON."""
    if len({c.id for c in checks}) < len(checks):
        raise ValueError("check ids repeat")
    rows = []
    for c in checks:
        try:
            bad = c.failing().select(F.to_json(F.struct("*")).alias("row"))
            got = bad.agg(F.count("*").alias("n"), F.first("row").alias("one")).first()
            n, some = got["n"], [got["one"]] if got["n"] == 1 else [r[0] for r in bad.limit(sample).collect()] if got["n"] else []
            some = "[" + ",".join(some) + "]"
            rows.append((c.id, c.group, c.severity, c.gate, c.severity if n else "passed", n, some))
        except Exception as e:  # noqa: BLE001  a check that can't run is a result
            rows.append((c.id, c.group, c.severity, c.gate, "broken", None, str(e)[:500]))
    return spark.createDataFrame(rows, RESULTS)


def verdicts(results: DataFrame) -> DataFrame:
    """Per group: failed if a gate is broken, blocked if a gate has an error, else passed."""
    return results.groupBy("source_group").agg(
        F.when(F.bool_or(F.col("gate") & (F.col("status") == "broken")), "failed").when(F.bool_or(F.col("gate") & (F.col("status") == "error")), "blocked").otherwise("passed").alias("verdict")
    )


def with_run_verdict(groups: DataFrame) -> DataFrame:
    """Verdicts of the groups and, as group run, that of the whole run: the worst of them."""
    worst = F.when(F.bool_or(F.col("verdict") == "failed"), "failed").when(F.bool_or(F.col("verdict") == "blocked"), "blocked").otherwise("passed")
    return groups.unionByName(groups.agg(worst.alias("verdict")).select(F.lit("run").alias("source_group"), "verdict"))


def acknowledge(results: DataFrame, failing: DataFrame, reviewed: DataFrame) -> DataFrame:
    """Results in which a warning whose failing rows (check_id, ack_key) are all reviewed is acknowledged. Reviews of rows that no longer fail are a warning of their own."""
    open_rows = failing.join(reviewed, ["check_id", "ack_key"], "left_anti").groupBy("check_id").agg(F.count("*").alias("_open"))
    met = results.join(open_rows, "check_id", "left")
    out = met.withColumn("status", F.when((F.col("status") == "warn") & F.col("_open").isNull(), "acknowledged").otherwise(F.col("status"))).drop("_open")
    stale = stale_reviews(failing, reviewed).agg(F.count("*").alias("n")).filter("n > 0")
    return out.unionByName(stale.select(F.lit("unmatched_reviews").alias("check_id"), F.lit("warn").alias("status"), F.lit("warn").alias("severity"), F.col("n").alias("failing_rows")), allowMissingColumns=True)


def stale_reviews(failing: DataFrame, reviewed: DataFrame) -> DataFrame:
    """Reviews of rows that no longer fail."""
    return reviewed.join(failing, ["check_id", "ack_key"], "left_anti")


def health(results: DataFrame, published: bool) -> DataFrame:
    """red on an error, a broken check or an unpublished run, yellow on a warning, else green."""
    rank = F.max(F.when(F.col("status").isin("error", "broken"), 2).when(F.col("status") == "warn", 1).otherwise(0))
    return results.agg(F.element_at(F.array(F.lit("green"), F.lit("yellow"), F.lit("red")), F.greatest(rank, F.lit(0 if published else 2)) + 1).alias("health"))


def require_none(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """df, if no row meets a named condition; else an error with all counts. One pass counts for all rules."""
    found = df.agg(*(F.count_if(F.expr(c)).alias(n) for n, c in rules.items())).first().asDict()
    bad = {n: k for n, k in found.items() if k}
    if bad:
        raise ValueError(f"rows that must not be: {bad}")
    return df


def assert_row_preserving(raw: DataFrame, out: DataFrame) -> DataFrame:
    """out, if it has exactly as many rows as raw."""
    a, b = raw.count(), out.count()
    if a != b:
        raise ValueError(f"{a} rows in, {b} rows out")
    return out


def schema_rows(spark: SparkSession, df: DataFrame) -> DataFrame:
    """A table's schema as rows: column, type."""
    return spark.createDataFrame(df.dtypes, "column string, type string")


def schema_differences(spark: SparkSession, df: DataFrame, declared: dict[str, str]) -> DataFrame:
    """Columns of a table that differ from the declared ones (name: type), both ways: column and problem, absent, undeclared or type. Types are compared as Spark names them."""
    have = {c: t for c, t in df.dtypes}
    rows = [(c, "absent" if c not in have else "undeclared" if c not in declared else "type") for c in [*declared, *(c for c in have if c not in declared)] if have.get(c) != declared.get(c)]
    return spark.createDataFrame(rows, "column string, problem string")


def broken_rules(df: DataFrame, rules: dict[str, str], keep: list[str]) -> DataFrame:
    """One row for each rule (name: condition) that a row breaks; the table is read once. A condition that is null is not broken."""
    broken = F.array_compact(F.array(*(F.when(F.expr(c), F.lit(n)) for n, c in rules.items())))
    return df.select(*keep, F.explode(broken).alias("rule"))


def impossible_values(obs: DataFrame, run_date: str, is_price: str) -> DataFrame:
    """Observations (series_id, obs_date, vintage, value, available_date) that can't be: a price (condition is_price) that is missing, NaN or not above 0, dates that are missing, a date after the run's, and a value known before its date."""
    rules = {
        "missing_price": f"({is_price}) AND (value IS NULL OR isnan(value))", "price_not_above_0": f"({is_price}) AND NOT isnan(value) AND value <= 0", "missing_date": "obs_date IS NULL OR available_date IS NULL OR vintage IS NULL",
        "future": f"obs_date > DATE '{run_date}'", "look_ahead": "available_date < obs_date",
    }
    return broken_rules(obs, rules, ["series_id", "obs_date", "vintage", "value", "available_date"])
