"""Line dedup: drop lines that many documents repeat, keeping each in one document. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.common import BLANKS, ascii_lower, stored, text_of

MIN_CHARS, MIN_DOCUMENTS = 40, 5


def line_key(line: Column) -> Column:
    """Comparison form of a line: blanks stripped at both ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def _hashes(key: Column) -> tuple[Column, Column]:
    """128 bits for a key, in two longs: 10^12 different lines meet by chance with odds of 10^-15."""
    return F.xxhash64(key).alias("h"), F.xxhash64(F.lit(1), key).alias("g")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS, keep: list[str] = ()) -> DataFrame:
    """Per row of docs: id, n_lines, n_dropped, the kept text (column `kept`) and the columns of `keep`.

    A key of at least min_chars code points that at least min_documents ids hold loses its lines everywhere but in the largest id
    that holds it. A null or empty text is one empty line. Rows that repeat an id count as one document; each row keeps its own lines.
    A null id is a document of its own that sorts below all others. Other columns are not read.

    Only hashes of long lines are exploded. Counts are combined before their shuffle; a line that a third of all documents hold is one
    key there, and on the join back a skewed key on the side that adaptive execution splits. Texts are shuffled once, to meet the
    positions to drop, with the small side built into a hash table so that no text is sorted.
    """
    rows = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"), F.coalesce(id_col, F.lit(-(2**63))).alias("_n"), F.struct(*keep, F.lit(None).alias("_")).alias("_keep")).withColumn("_sum", F.xxhash64("_text"))
    lines = F.split("_text", "\n", -1)
    keyed = F.transform(lines, lambda x, i: F.struct(i.alias("pos"), line_key(x).alias("key")))
    hashed = F.transform(F.filter(keyed, lambda x: F.char_length(x["key"]) >= min_chars), lambda x: F.struct(x["pos"].alias("pos"), *_hashes(x["key"])))
    each = rows.select("_n", "_sum", F.inline(hashed))
    held = each.groupBy("h", "g").agg(F.countDistinct("_n").alias("_documents"), F.max("_n").alias("_keeper")).filter(F.col("_documents") >= min_documents)
    # Stored, for a join whose two sides are both dealt for it: only then is a line of very many rows split over tasks.
    gone = each.join(stored(held.select("h", "g", "_keeper")), ["h", "g"]).filter(F.col("_n") != F.col("_keeper"))
    gone = gone.groupBy("_n", "_sum").agg(F.collect_set("pos").alias("_gone"))
    # Positions that stay come from one pass with a hash set, and the split text is bound once, so the work is linear in a text's lines.
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_gone"))
    kept = F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(F.transform(F.array(F.struct(lines.alias("all"), stay.alias("stay"))), lambda x: F.array_join(F.transform(x["stay"], lambda i: F.get(x["all"], i)), "\n"))[0])
    return rows.join(gone.hint("shuffle_hash"), ["_n", "_sum"], "left").select(
        F.col("_id").alias(id_col), F.size(lines).cast("long").alias("n_lines"), F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_dropped"), kept.alias("kept"), *(F.col("_keep")[c].alias(c) for c in keep)
    )
