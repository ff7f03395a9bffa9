"""Language identification by compression: the language whose zstandard dictionary makes a text smallest."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.llm.common import text_of

#: The fit sees at most so many rows of a language. Their whole texts are cut into pieces of so many code points, of which a dictionary holds a random choice, so many bytes in all.
SAMPLE_ROWS, SAMPLE_PIECE, DICTIONARY_BYTES = 400, 400, 1 << 17
LEVEL = 6
#: Bytes that are compressed at a time, each time with the dictionary afresh: what it saves is bounded, so in one go its share of a text's size would fall with the length.
PIECE_BYTES = 1 << 15
#: A text is rejected if the best language saves less than this share of the second-best size.
MIN_MARGIN = 0.005
UNKNOWN = "und"
#: Letters, and signs such as numerals, which their category tells from letters.
SIGN = re.compile(r"[^\W\d_]")
OTHERS = re.compile(r"[\W\d_]+")


def words_only(text: str) -> bytes:
    """Lower-cased letters with one space for whatever stands between them: junk between words says nothing about their language."""
    return OTHERS.sub(" ", text.lower()).encode()


def has_letter(text: str) -> bool:
    """Whether a character of the text is of a letter's category; ², ½, Ⅷ and ① are not."""
    return any(unicodedata.category(m[0])[0] == "L" for m in SIGN.finditer(text))


def fit_dictionaries(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_rows: int = SAMPLE_ROWS) -> dict[str, bytes]:
    """Raw-content dictionaries by language, from a bounded sample of the labelled rows where `train` holds.

    Rows are drawn by a hash of their id, about twice sample_rows of each language, of which the first sample_rows stay. Pieces from anywhere in their texts fill a dictionary in the
    order of a hash; only those reach the driver.
    """
    rows = docs.filter(train & F.col(lang_col).isNotNull() & (F.length(text_of(text_col)) > 0)).select(F.col(lang_col).alias("lang"), F.xxhash64(id_col, text_col).alias("at"), F.col(text_col).alias("text"))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return {}
    share = F.create_map(*(F.lit(x) for k, n in counts.items() for x in (k, min(1.0, 2 * sample_rows / n + 20 / n))))
    drawn = rows.filter(F.pmod("at", F.lit(1_000_003)) / 1_000_003 < share[F.col("lang")])
    first = drawn.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("at", "text"))).filter(F.col("n") <= sample_rows)
    pieces = first.select("lang", "at", F.posexplode(F.regexp_extract_all("text", F.lit(f"(?s).{{1,{SAMPLE_PIECE}}}"), 0)).alias("m", "text")).withColumn("at", F.xxhash64("at", "m"))
    chosen = pieces.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("at", "text"))).filter(F.col("n") <= 2 * DICTIONARY_BYTES // SAMPLE_PIECE)
    texts: dict[str, list[str]] = {}
    for r in chosen.orderBy("lang", "n").collect():
        texts.setdefault(r["lang"], []).append(r["text"])
    whole = {k: words_only(" ".join(v))[:DICTIONARY_BYTES].decode("utf-8", "ignore").encode() for k, v in texts.items()}
    return dict(sorted(whole.items(), key=lambda x: (-counts[x[0]], x[0])))


def classify(dictionaries: dict[str, bytes]):
    """A function from a text to (language, score, rejected); ties go to the language that comes first, that of the most training rows."""
    names = list(dictionaries)
    packers = []
    for k in names:
        d = zstandard.ZstdCompressionDict(dictionaries[k], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=LEVEL)
        packers.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_dict_id=False))

    def of(text: str | None) -> tuple[str, float, bool]:
        if not text or not names or not has_letter(text):
            return UNKNOWN, 0.0, True
        data = words_only(text)
        pieces = [data[i : i + PIECE_BYTES] for i in range(0, len(data), PIECE_BYTES)]
        sizes = [sum(len(p.compress(x)) for x in pieces) for p in packers]
        best = min(range(len(sizes)), key=lambda i: (sizes[i], i))
        rest = sizes[:best] + sizes[best + 1 :]
        margin = 1 - sizes[best] / min(rest) if rest else 1.0
        return names[best], margin, margin < MIN_MARGIN

    return of


def identify(docs: DataFrame, dictionaries: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text", keep: list[str] = ()) -> DataFrame:
    """Per row: id, the columns of `keep`, lang_pred, score (share of the second-best size that the best saves) and rejected; a column of `keep` that has a result's name gives way to it.

    Every row is judged on its own: repeated rows and ids and null ids come out as they went in, and other columns are not read.

    A text that is null or has no letter is `und` and rejected, as is every text if no dictionary was learned. Whole texts are compressed, one
    at a time and in pieces of PIECE_BYTES whose sizes are summed. The dictionaries travel as a broadcast: a bounded number of bytes for each language.
    """
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of = classify(shared.value)
        for b in batches:
            got = [of(t) for t in b.pop("_text")]
            b["lang_pred"], b["score"], b["rejected"] = ([g[i] for g in got] for i in range(3))
            yield b

    rows = docs.select(id_col, *(c for c in keep if c not in ("lang_pred", "score", "rejected")), F.col(text_col).alias("_text"))
    return rows.mapInPandas(run, ", ".join(f"`{n}` {t}" for n, t in rows.drop("_text").dtypes) + ", lang_pred string, score double, rejected boolean")
