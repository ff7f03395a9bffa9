"""URL filters: host-suffix and path-prefix expressions of each URL meet the rules by short hash prefixes, full digests confirm. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.common import ascii_lower, stored

#: Hex digits of a digest by which expressions and rules meet (four bytes).
SHORT = 8
#: Up to so many rules are broadcast (some 100 bytes each); more are joined by a shuffle on the short prefix.
BROADCAST_RULES = 1_000_000


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; null or without `://`: empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(_rest(url), "^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to `?`, `#` or the end, as it is; null or without `://`: empty."""
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def _folder(path: Column) -> Column:
    """A path up to its last slash, which is included; empty without one."""
    return F.regexp_extract(path, "(?s)^(.*/)?", 1)


def _digest(host: Column, folder: Column) -> Column:
    """A blank stands between the two, which no host that a rule names holds; the confirmation compares both anyway."""
    return F.sha2(F.concat(host, F.lit(" "), folder), 256)


def rule_table(rules: DataFrame) -> DataFrame:
    """Rules (action, host, path) with what they are met by: short, digest, and the greatest number of labels and slashes that any rule has.

    Hosts are lower-cased; a null host or path is empty. A rule given twice counts once, with both actions it blocks.
    """
    clean = rules.select(ascii_lower(F.coalesce("host", F.lit(""))).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "action")
    one = clean.groupBy("host", "path").agg(F.max(F.struct((F.col("action") == "block").alias("_"), "action"))["action"].alias("action"))
    digest = _digest(F.col("host"), _folder(F.col("path")))
    return one.select(F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), "action", digest.alias("rule_digest"), F.substring(digest, 1, SHORT).alias("short"))


def expressions(urls: DataFrame, labels: int, slashes: int) -> DataFrame:
    """Per row of urls (host, path): each host suffix of at most `labels` labels with each path prefix that ends at one of its first `slashes` slashes or is empty.

    The bounds are those of the longest rule, so no expression that a rule could equal is left out, and a URL of any length has at most labels x (slashes + 1).
    """
    parts, steps = F.split("host", "\\.", -1), F.split("path", "/", -1)
    several = F.least(F.size(parts), F.lit(labels))
    suffixes = F.transform(F.sequence(F.lit(1), several), lambda k: F.array_join(F.slice(parts, F.size(parts) - k + 1, k), "."))
    deep = F.least(F.size(steps) - 1, F.lit(slashes))
    prefixes = F.transform(F.sequence(F.lit(0), deep), lambda k: F.concat(F.array_join(F.slice(steps, F.lit(1), k), "/"), F.when(k > 0, "/").otherwise("")))
    return urls.select("host", "path", F.explode(suffixes).alias("suffix")).select("host", "path", "suffix", F.explode(prefixes).alias("folder"))


def matches(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Per row of urls (host, path) that a rule fits: the winning rule's host, path and action.

    A rule fits its host and all subdomains, if the path starts with the rule's. The longest wins (characters of host and path); of equally long ones that of the longer host.
    An expression meets the rules of its short prefix; the full digest, the host and the whole rule path confirm. A rule whose path ends inside a folder is met by that folder.
    """
    table = stored(rule_table(rules))
    bound = table.agg(F.count("*").alias("n"), F.max(F.size(F.split("rule_host", "\\.", -1))).alias("labels"), F.max(F.size(F.split("rule_path", "/", -1)) - 1).alias("slashes")).first()
    each = expressions(urls, bound["labels"] or 0, bound["slashes"] or 0) if bound["n"] else expressions(urls.limit(0), 1, 0)
    each = each.withColumn("digest", _digest(F.col("suffix"), F.col("folder"))).withColumn("_short", F.substring("digest", 1, SHORT))
    met = each.join(F.broadcast(table) if bound["n"] <= BROADCAST_RULES else table, F.col("_short") == F.col("short"))
    sure = met.filter((F.col("digest") == F.col("rule_digest")) & (F.col("suffix") == F.col("rule_host")) & F.expr("startswith(path, rule_path)"))
    rank = F.struct((F.length("rule_host") + F.length("rule_path")).alias("size"), F.length("rule_host").alias("own"), "rule_host", "rule_path", "action")
    best = sure.groupBy("host", "path").agg(F.max(rank).alias("b"))
    return best.select("host", "path", F.concat("b.rule_host", "b.rule_path").alias("rule"), F.col("b.action").alias("action"))


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", otherwise: str = "allow") -> DataFrame:
    """Per row of pages: id, host, path, rule (null if none fits) and verdict, that of the rule or `otherwise`.

    A null URL or one without `://` has an empty host and path, which only a rule of empty host fits. Rows that repeat an id or URL are judged each; other columns are not read.
    Each different host and path is expanded once, however many pages have it, and its verdict joined back: a hot URL is one row on one side
    and rows that adaptive execution splits on the other.
    """
    rows = pages.select(F.col(id_col).alias("_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    found = matches(rows.select("host", "path").distinct(), rules)
    out = rows.join(found, ["host", "path"], "left")
    return out.select(F.col("_id").alias(id_col), "host", "path", "rule", F.coalesce("action", F.lit(otherwise)).alias("verdict"))


#: The rules that the query applies: action, host, path.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def default_rules(spark) -> DataFrame:
    return spark.createDataFrame(RULES, "action string, host string, path string")
