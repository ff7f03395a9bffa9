"""Token counts by a two-tier lookup: a broadcast table of frequent pre-token lengths, then each worker's own cache of what it encoded."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.common import text_of

#: The table of frequent pre-tokens is filled from at most so many rows and code points of each, and holds at most so many entries. It is a cache: counts don't depend on it.
SAMPLE_ROWS, SAMPLE_CHARS, TABLE_ENTRIES = 4_000, 20_000, 50_000
#: A worker's cache is emptied beyond so many entries; longer pre-tokens aren't kept.
CACHE_ENTRIES, CACHE_CHARS = 400_000, 48
#: A run of spaces and the word behind it. No piece of the vocabulary joins a word to a following space, so pre-tokens are encoded apart.
PRE_TOKEN = re.compile(r" *[^ ]+| +$")
SPACE = "▁"


def _model(path: str):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    if any(re.search(f"[^{SPACE}]{SPACE}", p) or re.match(f"{SPACE}{SPACE}+[^{SPACE}]", p) for p in pieces):
        raise ValueError("a piece of this vocabulary crosses pre-tokens")
    return model


class PreTokens:
    """Lengths of pre-tokens, from the frequent ones' table or encoded once and remembered."""

    def __init__(self, path: str, frequent: dict[str, int]):
        self.model, self.frequent, self.seen = _model(path), frequent, {}

    def count(self, text: str) -> int:
        """Tokens of a whole text; the model puts one space in front of it and treats its own space sign as a space."""
        if not text:
            return 0
        words = text.replace(SPACE, " ").split(" ")
        if "" in words:
            words = [w[1:] if w[0] == " " else w for w in PRE_TOKEN.findall(" " + text.replace(SPACE, " "))]
            if words[-1] == "":  # one space that ends the text: the model would put none in front of nothing
                return 1 + self._sum(words[:-1])
        return self._sum(words)

    def _sum(self, words: list[str]) -> int:
        n = list(map(self.frequent.get, words))
        rest = [w for w, k in zip(words, n) if k is None]
        if not rest:
            return sum(n)
        got = list(map(self.seen.get, rest))
        new = [w for w, k in zip(rest, got) if k is None]
        total = sum(k for k in n if k is not None) + sum(k for k in got if k is not None)
        if new:
            lengths = [len(x) for x in self.model.encode(new, num_threads=1)]
            total += sum(lengths)
            if len(self.seen) > CACHE_ENTRIES:
                self.seen.clear()
            self.seen.update((w, k) for w, k in zip(new, lengths) if len(w) <= CACHE_CHARS)
        return total


def frequent_lengths(docs: DataFrame, path: str, text_col: str = "text") -> dict[str, int]:
    """Lengths of the most frequent pre-tokens in a bounded draw of rows; the draw is spread over all partitions."""
    rows = docs.select(F.substring(text_col, 1, SAMPLE_CHARS).alias("t"), F.xxhash64(text_col).alias("at"))
    n = max(1, docs.count())
    some = rows.filter(F.pmod("at", F.lit(1_000_003)) / 1_000_003 < SAMPLE_ROWS / n).limit(2 * SAMPLE_ROWS)
    words = some.select(F.explode(F.split("t", " ")).alias("w")).filter((F.col("w") != "") & (F.char_length("w") <= CACHE_CHARS))
    top = [r["w"] for r in words.groupBy("w").count().orderBy(F.desc("count"), "w").limit(TABLE_ENTRIES).collect()]
    return dict(zip(top, map(len, _model(path).encode(top, num_threads=1)))) if top else {}


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096) -> DataFrame:
    """Per row: id, n_bytes (UTF-8), n_tokens and over_limit; a null text is empty and has no tokens.

    Each row is counted on its own: repeated rows and ids and null ids come out as they went in, and extra columns are not read. An empty table gives an empty result.
    Nothing is shuffled. Every worker holds the broadcast table and a bounded cache; whole texts are counted one at a time.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, path, text_col))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = PreTokens(path, shared.value)
        for b in batches:
            b["n_tokens"] = [words.count(t) for t in b.pop("_text")]
            yield b

    rows = docs.select(id_col, F.octet_length(text_of(text_col)).cast("long").alias("n_bytes"), text_of(text_col).alias("_text"))
    counted = rows.mapInPandas(run, ", ".join(f"`{n}` {t}" for n, t in rows.drop("_text").dtypes) + ", n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
