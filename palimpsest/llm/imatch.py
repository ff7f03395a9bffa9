"""Document fingerprints by I-Match: hashes of the sorted terms that randomised parts of a mid-frequency lexicon keep.

DataFrame functions only. The lexicon holds the terms whose share of documents lies in a band [low, high]: such terms carry content and recur.
It can't outgrow (mean distinct terms of a document) / low entries whatever the number of documents, because the shares of all terms add up to that mean:
about 25,000 for a mean of 250 and low = 0.01. That bound is why it may travel in the plan as a set of constants.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.llm.common import text_of

#: Share of documents that a lexicon term must be in: idf between ln 10 and ln 100.
LOW, HIGH = 0.01, 0.1
#: The lexicon is dealt at random into the first number of subsets, and each of those again, to the second number in all; the finer ones survive more edits.
FAMILIES = (8, 32)
#: A non-word run; words are ASCII letters and digits and everything beyond ASCII.
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def term_hashes(text: Column) -> Column:
    """Distinct terms of a text as 64-bit hashes."""
    words = F.filter(F.split(F.lower(text), GAP), lambda w: w != "")
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def lexicon(docs: DataFrame, text_col: str = "text", low: float = LOW, high: float = HIGH) -> list[int]:
    """Hashes of the terms in the band, over all documents; a term must be in two documents at least."""
    n = docs.count()
    terms = docs.select(F.explode(term_hashes(text_of(text_col))).alias("h"))
    band = terms.groupBy("h").count().filter((F.col("count") >= max(2, low * n)) & (F.col("count") <= high * n))
    return sorted(r[0] for r in band.select("h").collect())


def _signed(df: DataFrame, text: Column, band: list[int], name: str) -> DataFrame:
    """df with a signature of `text`: one hash for each lexicon subset, null where the text has no term of it; last, one hash of all its terms.

    The last is for texts without any lexicon term, which the subsets can't tell apart.
    """

    coarse, fine = FAMILIES
    bits = [coarse - 1, fine - coarse]  # of a term's hash: they name its subset, and the finer part of that

    def dealt(terms: Column, mask: int) -> Column:
        step = mask & -mask
        return F.transform(F.array(*(F.lit(k) for k in range(0, mask + 1, step))), lambda k: F.filter(terms, lambda h: h.bitwiseAND(F.lit(mask)) == k))

    def hashed(part: Column) -> Column:
        return F.when(F.size(part) > 0, F.xxhash64(part))

    subsets = F.transform(dealt(F.col("_kept"), bits[0]), lambda p: F.concat(F.array(hashed(p)), F.transform(dealt(p, bits[1]), hashed)))
    inside = F.expr(f"filter(_terms, h -> h IN ({','.join(map(str, band or [0]))}))")
    sig = F.concat(F.flatten(subsets), F.array(F.xxhash64("_terms")))
    return df.withColumn("_terms", F.array_sort(term_hashes(text))).withColumn("_kept", inside).withColumn(name, sig).drop("_terms", "_kept")


def printed(sig: Column) -> Column:
    """Hex digits of a signature, eight for each subset and 16 for the last; dashes where a subset is empty."""
    return F.concat(
        F.array_join(F.transform(F.slice(sig, F.lit(1), F.size(sig) - 1), lambda h: F.coalesce(F.lower(F.lpad(F.hex(F.shiftrightunsigned(h, 32)), 8, "0")), F.lit("-" * 8))), ""),
        F.lower(F.lpad(F.hex(F.element_at(sig, -1)), 16, "0")),
    )


def likeness(a: Column, b: Column) -> Column:
    """Share of the subsets non-empty in either signature on which both agree; 1 for equal signatures, 0 if nothing is shared or b is missing."""
    pairs = F.arrays_zip(F.slice(a, F.lit(1), F.size(a) - 1).alias("x"), F.slice(b, F.lit(1), F.size(b) - 1).alias("y"))
    some = F.size(F.filter(pairs, lambda p: p["x"].isNotNull() | p["y"].isNotNull()))
    same = F.size(F.filter(pairs, lambda p: p["x"] == p["y"]))
    return F.when(b.isNull(), 0.0).when(F.element_at(a, -1) == F.element_at(b, -1), 1.0).when(some > 0, same / some).otherwise(0.0)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", band: list[int] | None = None) -> DataFrame:
    """id, text, `fingerprint` (array of longs, null for an empty subset) of every row; the lexicon is taken from docs unless given."""
    band = lexicon(docs, text_col) if band is None else band
    return _signed(docs.select(F.col(id_col), text_of(text_col).alias("text")), F.col("text"), band, "fingerprint")


def with_next(docs: DataFrame, id_col: str, cols: list[str], buckets: int) -> DataFrame:
    """Rows with `next_<col>` of the row that follows by id, after the last the first. No window spans more than one of `buckets` id ranges.

    Range bounds are ids of the table, so each range's first row is known by its id: a copy of it goes to the range before as well,
    behind that range's own rows, and the first row of all behind the last range. Rows that share an id follow each other in the order of the
    columns' hash; null ids come first.
    """
    docs = docs.withColumn("_at", F.coalesce(id_col, F.lit(-(2**63))))
    r = docs.agg(F.min("_at").alias("least"), F.percentile_approx("_at", [i / buckets for i in range(1, buckets)], 10 * buckets).alias("at")).first()
    if r["least"] is None:
        bounds = [0]
    else:
        bounds = sorted({r["least"], *r["at"]})
    n, opening = len(bounds), F.expr(f"array({','.join(f'CAST({b} AS BIGINT)' for b in bounds)})")
    # Bounds that are at most the id; array_position finds the range that a bound itself opens.
    own = F.size(F.filter(opening, lambda b: b <= F.col("_at"))) - 1
    opens = F.array_position(opening, F.col("_at")).cast("int") - 1
    before = F.when(opens >= 0, F.pmod(opens - 1, F.lit(n)))
    places = F.array_compact(F.array(F.struct(own.alias("_range"), F.lit(0).alias("_guest")), F.when(before.isNotNull(), F.struct(before.alias("_range"), F.lit(1).alias("_guest")))))
    dealt = docs.select("*", F.inline(places))
    order = Window.partitionBy("_range").orderBy("_guest", "_at", F.xxhash64(*cols))
    for c in cols:
        dealt = dealt.withColumn(f"next_{c}", F.lead(c).over(order))
    return dealt.filter("_guest = 0").drop("_range", "_guest", "_at")


def edited_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited form, whose last quarter is the start of the next document.

    A null text is empty. Repeated rows stay, each followed by the next of them. In a table of one row the row follows itself. Extra columns
    are not read. Whole texts are shuffled once, by id range.
    """
    spark = docs.sparkSession
    buckets = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    band = lexicon(docs, text_col)
    signed = fingerprints(docs, id_col, text_col, band)
    pairs = with_next(signed, id_col, ["text", "fingerprint"], buckets)
    n, size = F.char_length("text"), F.floor(F.char_length("text") / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - size), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), size))
    pairs = _signed(pairs.withColumn("edited", edited), F.col("edited"), band, "edited_fingerprint")
    return pairs.select(
        id_col, n.cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        printed(F.col("fingerprint")).alias("fingerprint"), printed(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"), likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
