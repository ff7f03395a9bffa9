"""Files as their publishers send them, read by Spark's own readers into rows with declared columns. Drift stops a read; nothing is guessed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from palimpsest.operators.quality import require_none
from palimpsest.operators.ranges import kept

FILE = "_metadata.file_path"


def from_file_name(regex: str) -> Column:
    """The first group of a pattern over the path of a row's file; a path that doesn't match raises."""
    found = F.regexp_extract(F.col(FILE), regex, 1)
    return F.when(found != "", found).otherwise(F.raise_error(F.concat(F.lit(f"no match of {regex} in "), F.col(FILE))))


def ingest_index(spark: SparkSession, paths: str | list[str], quarter_regex: str = r"/(\d{4}Q\d)[^/]*$") -> DataFrame:
    """Pipe-separated filing index: cik, company_name, form_type, date_filed, filename, quarter (from the file's path).

    Preamble, header and the dashed line hold no company number before a pipe. A line that starts with one and has not exactly five fields raises.
    """
    lines = spark.read.text(paths).select("value", from_file_name(quarter_regex).alias("quarter")).filter(F.col("value").rlike(r"^\d+\|"))
    f = F.split("value", r"\|")
    checked = F.when(F.size(f) == 5, f).otherwise(F.raise_error(F.concat(F.lit("not five fields: "), "value")))
    rows = lines.select(checked.alias("f"), "quarter")
    return rows.select(
        F.col("f")[0].cast("long").alias("cik"), F.col("f")[1].alias("company_name"), F.col("f")[2].alias("form_type"), F.col("f")[3].cast("date").alias("date_filed"), F.col("f")[4].alias("filename"), "quarter"
    )


SUBMISSION = """cik long, name string, entityType string, sic string, tickers array<string>, exchanges array<string>,
 filings struct<recent: struct<accessionNumber: array<string>, filingDate: array<string>, reportDate: array<string>, form: array<string>, items: array<string>>>"""


def ingest_submissions(spark: SparkSession, paths: str | list[str], schema: str = SUBMISSION, multi_line: bool = True) -> tuple[DataFrame, DataFrame]:
    """One JSON document for each company as (details, filings); its parallel arrays become filing rows, and arrays of different lengths raise."""
    docs = spark.read.schema(schema).option("mode", "FAILFAST").option("multiLine", multi_line).json(paths)
    names = docs.schema["filings"].dataType["recent"].dataType.names
    part = lambda n: F.col(f"filings.recent.{n}")
    even = reduce(lambda a, b: a & b, (F.size(part(n)) == F.size(part(names[0])) for n in names[1:]), F.lit(True))
    zipped = F.when(even, F.arrays_zip(*(part(n).alias(n) for n in names))).otherwise(F.raise_error(F.concat(F.lit("arrays of different lengths: "), F.col("cik").cast("string"))))
    return docs.drop("filings"), docs.select("cik", F.explode(zipped).alias("f")).select("cik", "f.*")


FACTS = """cik long, entityName string, facts map<string, map<string, struct<label: string, description: string, units: map<string, array<
 struct<start: string, end: string, val: string, accn: string, fy: int, fp: string, form: string, filed: string, frame: string>>>>>>"""


def ingest_companyfacts(spark: SparkSession, paths: str | list[str], multi_line: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Taxonomy, concept and unit levels as (facts, concepts, changes): `val` stays the text that was sent; a document without facts is a change without rows.

    Documents are parsed twice: for the facts, and for what concepts and changes share, which is stored without the facts' rows.
    """
    docs = spark.read.schema(FACTS).option("mode", "FAILFAST").option("multiLine", multi_line).json(paths)
    opened = docs.select("cik", F.explode("facts").alias("taxonomy", "of")).select("cik", "taxonomy", F.explode("of").alias("concept", "c"))
    facts = opened.select("cik", "taxonomy", "concept", F.explode("c.units").alias("unit", "rows")).select("cik", "taxonomy", "concept", "unit", F.inline("rows"))
    named = F.transform_values("facts", lambda _, of: F.transform_values(of, lambda _, c: F.struct(c["label"].alias("label"), c["description"].alias("description"))))
    heads = kept(docs.select("cik", F.col("entityName").alias("entity_name"), named.alias("facts")))
    concepts = heads.select("cik", "entity_name", F.explode("facts").alias("taxonomy", "of")).select("cik", "entity_name", "taxonomy", F.explode("of").alias("concept", "c"))
    return facts, concepts.select("cik", "entity_name", "taxonomy", "concept", "c.label", "c.description"), heads.select("cik", (F.coalesce(F.size("facts"), F.lit(0)) > 0).alias("document_found"))


MACRO = "series_id string, count long, observations array<struct<date: date, realtime_start: date, realtime_end: date, value: string>>"
MACRO_SERIES = "seriess array<struct<id: string, title: string, units: string, frequency_short: string, seasonal_adjustment_short: string, observation_start: string, realtime_start: date, realtime_end: date>>"


def ingest_fred(spark: SparkSession, observations: str | list[str], series: str | list[str], multi_line: bool = True) -> tuple[DataFrame, DataFrame]:
    """(observations, metadata history) of macro series. A document whose `count` differs from its rows was cut off and raises."""
    docs = spark.read.schema(MACRO).option("mode", "FAILFAST").option("multiLine", multi_line).json(observations)
    whole = F.when(F.size("observations") == F.col("count"), F.col("observations")).otherwise(F.raise_error(F.concat(F.lit("cut off: "), "series_id")))
    rows = docs.select(F.col("series_id").alias("fred_id"), F.inline(whole)).withColumnRenamed("date", "obs_date")
    meta = spark.read.schema(MACRO_SERIES).option("mode", "FAILFAST").option("multiLine", multi_line).json(series)
    return rows, meta.select(F.inline("seriess")).withColumnRenamed("id", "fred_id")


def ingest_bars(spark: SparkSession, paths: str | list[str], schema: str, column_map: dict[str, str], stamp: str) -> DataFrame:
    """Daily bars from CSV under stable names; `stamp` becomes obs_date and must be midnight UTC."""
    bars = ingest_csv_strict(spark, paths, schema)
    at = F.col(stamp)
    day = F.when(F.coalesce(at == F.date_trunc("day", at), F.lit(False)), F.to_date(at)).otherwise(F.raise_error(F.concat(F.lit("not midnight: "), F.coalesce(at.cast("string"), F.lit("null")))))
    return bars.withColumn("obs_date", day).drop(stamp).withColumnsRenamed(column_map)


def ingest_sdmx(spark: SparkSession, paths: str, series: str, obs: str, group: str, entity: str = "country", indicator: str = "indicator") -> tuple[DataFrame, DataFrame]:
    """SDMX-ML as (observations, series). The schemas list XML attributes (`_NAME type`): of Series elements, of their Obs elements, and of Group elements.

    A group of an entity and an indicator adds its other attributes to that series; one without an entity adds them, under `indicator_`, to all series of
    its indicator. Two groups of one key would double a series and raise.
    """
    xml = lambda tag, schema: spark.read.format("xml").option("rowTag", tag).schema(schema).option("mode", "FAILFAST").load(paths)
    plain = lambda df: df.withColumnsRenamed({c: c.lstrip("_").lower() for c in df.columns})
    rows, groups = xml("Series", f"{series}, Obs array<struct<{obs}>>"), plain(xml("Group", group))
    notes = [c for c in groups.columns if c not in (entity, indicator)]

    def one(df: DataFrame, keys: list[str], prefix: str) -> DataFrame:
        alone = lambda c: F.when(F.count("*") == 1, F.first(c)).otherwise(F.raise_error("two groups of one key"))
        return df.groupBy(*keys).agg(*(alone(c).alias(prefix + c) for c in notes))

    values = plain(rows.select(f"_{entity.upper()}", f"_{indicator.upper()}", F.inline("Obs")))
    heads = plain(rows.drop("Obs"))
    met = heads.join(one(groups.filter(F.col(entity).isNotNull()), [entity, indicator], ""), [entity, indicator], "left")
    return values, met.join(one(groups.filter(F.col(entity).isNull()), [indicator], "indicator_"), indicator, "left")


def ingest_csv_strict(spark: SparkSession, paths: str | list[str], schema: str, sep: str = ",") -> DataFrame:
    """Typed CSV whose header must be the declared columns in order; a bad value raises when it is read, and files without a row are refused."""
    df = spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").option("sep", sep).csv(paths)
    if df.isEmpty():
        raise ValueError(f"no rows in {paths}")
    return df


def ingest_tsv_text(spark: SparkSession, paths: str | list[str], columns: list[str], quarter_regex: str = r"/(\d{4}q\d)[^/]*$") -> DataFrame:
    """Tab-separated text of many quarters, no quoting, every column text; the quarter comes from the file's path."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    df = spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").option("sep", "\t").option("quote", "").csv(paths)
    return df.select(*columns, from_file_name(quarter_regex).alias("quarter"))


def ingest_csv_optional(spark: SparkSession, paths: list[str], required: list[str], wanted: dict[str, str]) -> DataFrame:
    """CSV files whose headers drift, as the columns of `wanted` (name: type). Names meet without regard to case, thousands commas go, absent columns are null;
    an absent required one raises. Each file has a header of its own, so this plans one scan for each: for tens of files, not thousands."""

    def one(path: str) -> DataFrame:
        df = spark.read.option("header", True).csv(path)
        have = {c.strip().lower(): c for c in df.columns}
        absent = [c for c in required if c.lower() not in have]
        if absent:
            raise ValueError(f"{path} lacks {absent}")
        plain = lambda c, t: F.col(f"`{have[c.lower()]}`") if t == "string" else F.regexp_replace(F.col(f"`{have[c.lower()]}`"), ",", "")
        return df.select(*((plain(c, t) if c.lower() in have else F.lit(None)).cast(t).alias(c) for c, t in wanted.items()))

    return reduce(DataFrame.unionByName, map(one, paths))


def declared(df: DataFrame, schema: StructType, rules: dict[str, str]) -> DataFrame:
    """df, if its columns are the declared ones and no row meets a named condition."""
    if df.columns != schema.names:
        raise ValueError(f"columns are {df.columns}, not {schema.names}")
    return require_none(df, rules)
