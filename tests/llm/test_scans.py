"""License scans, language ID and token counts against brute force or held-out accuracy."""

import re

import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

from palimpsest.llm import langid, license_scan, token_counts
from palimpsest.llm.common import remainder

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
MODEL = public_tokenizers.path("piece_bpe_32k.model")


def brute_base(t):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    at, labels = [], set()
    for phrase, label in license_scan.PHRASES.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i : i + len(p)] == p:
                at.append(i)
                labels.add(label)
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def test_base_places(more_docs, edge, empty):
    for df in (more_docs, edge):
        got = license_scan.scan_licenses(df).collect()
        want = sorted([(r.doc_id, *brute_base(r.text)) for r in df.collect()], key=repr)
        assert sorted([(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got], key=repr) == want
        assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in got)
    assert license_scan.scan_licenses(empty).collect() == []


def test_spans_with_gaps(spark):
    text = "before " * 9 + "Permission is hereby granted, free of charge, to ANY person obtaining a copy of this software and some associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense"
    rows = [(1, text), (2, "Licensed under CC BY-NC 4.0."), (3, "permission is granted to any person with a copy"), (4, "mit mit license mit license")]
    got = {r.doc_id: r for r in license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].labels == "mit" and got[1].spans[0].start == 9 and got[1].score > 0.7
    assert got[2].labels == "cc-by-nc" and got[2].score == 1.0
    assert got[3].labels == "" and got[3].score == 0.0
    assert (got[4].n_base, got[4].first_word, got[4].last_word) == (2, 1, 3)


def brute_spans(words):
    """Labels and score of a text's words by the rule, template by template."""
    labels, score = set(), 0.0
    for phrase, label in license_scan.PHRASES.items():
        p = phrase.split()
        if any(words[i : i + len(p)] == p for i in range(len(words))):
            labels.add(label)
            score = 1.0
    for label, text in license_scan.TEMPLATES:
        t, g = text.split(" "), license_scan.GRAM
        place = {}
        for k in range(len(t) - g + 1):
            place.setdefault(tuple(t[k : k + g]), []).append(k)
        diagonals = {}
        for i in range(len(words) - g + 1):
            for k in place.get(tuple(words[i : i + g]), ()):
                diagonals.setdefault(i - k, set()).add(k)
        groups = []
        for d in sorted(diagonals):
            if groups and d - groups[-1][-1] <= license_scan.NEIGHBOURS:
                groups[-1].append(d)
            else:
                groups.append([d])
        for group in groups:
            at = set().union(*(diagonals[d] for d in group))
            covered = len({k + x for k in at for x in range(g)})
            start, end = min(d + min(diagonals[d]) for d in group), max(d + max(diagonals[d]) for d in group) + g
            if covered >= license_scan.MIN_COVER * len(t) and covered >= license_scan.MIN_DENSITY * (end - start):
                labels.add(label)
                score = max(score, min(1.0, covered / len(t)))
    return ",".join(sorted(labels)), score


def test_labels_and_score(spark, more_docs):
    """Against a plain scan, over texts of the table and whole, cut and changed licences."""
    rows = [(r.doc_id, r.text) for r in more_docs.limit(300).collect()]
    for n, (_, text) in enumerate(license_scan.TEXTS):
        words = text.split()
        rows += [(10_000 + 4 * n, text), (10_001 + 4 * n, "x y " + " ".join(words[: len(words) * 2 // 3]) + " z"), (10_002 + 4 * n, " ".join(w if k % 9 else "other" for k, w in enumerate(words))), (10_003 + 4 * n, text + " and " + text)]
    got = {r.doc_id: (r.labels, round(r.score, 9)) for r in license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    lower = [(i, WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))) for i, t in rows]
    assert got == {i: (labels, round(score, 9)) for i, w in lower for labels, score in [brute_spans(w)]}
    assert sum(bool(x) for x, _ in got.values()) > 30


def test_sizes_decide_the_language(more_docs):
    """Predictions and margins are those of plain compression with each dictionary, piece by piece."""
    import zstandard

    learned = langid.fit_dictionaries(more_docs, remainder("doc_id", 4) != 2)
    some = more_docs.limit(150)
    for r in langid.identify(some, learned, keep=["text"]).collect():
        data = langid.OTHERS.sub(" ", (r.text or "").lower()).encode()
        sizes = {}
        for k, d in learned.items():
            packer = zstandard.ZstdCompressor(level=langid.LEVEL, dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_content_size=False, write_dict_id=False)
            sizes[k] = sum(len(packer.compress(data[i : i + langid.PIECE_BYTES])) for i in range(0, len(data), langid.PIECE_BYTES))
        first, second = sorted(sizes.values())[:2]
        assert sizes[r.lang_pred] == first and abs(r.score - (1 - first / second)) < 1e-9


def test_signs_are_no_letters(spark, more_docs):
    learned = langid.fit_dictionaries(more_docs, remainder("doc_id", 4) != 2)
    df = spark.createDataFrame([(1, "² ½ Ⅷ ①"), (2, "12_34"), (3, "² a")], "doc_id long, text string").withColumns({"score": F.lit("x"), "rejected": F.lit(1)})
    got = {r.doc_id: r.lang_pred for r in langid.identify(df, learned, keep=["score", "rejected"]).collect()}
    assert got[1] == got[2] == "und" != got[3]


def test_language_held_out(more_docs):
    held_out = remainder("doc_id", 4) == 2
    learned = langid.fit_dictionaries(more_docs, ~held_out)
    assert all(len(x) <= langid.DICTIONARY_BYTES for x in learned.values())
    got = langid.identify(more_docs.withColumn("held_out", held_out), learned, keep=["held_out", "lang"]).collect()
    known = [r for r in got if r.held_out and r.lang and not r.rejected]
    assert len(known) > 200 and sum(r.lang == r.lang_pred for r in known) / len(known) > 0.98
    assert sum(r.rejected for r in got) < 0.02 * len(got)


def test_language_edges(edge, empty, more_docs):
    learned = langid.fit_dictionaries(more_docs, remainder("doc_id", 4) != 2)
    got = {r.doc_id: r for r in langid.identify(edge, learned).collect()}
    for i in (0, 1, 2):
        assert (got[i].lang_pred, got[i].score, got[i].rejected) == ("und", 0.0, True)
    assert all(r.lang_pred in {*learned, "und"} and 0 <= r.score <= 1 for r in got.values())
    assert langid.identify(edge, {}).filter("lang_pred <> 'und'").count() == 0
    assert langid.fit_dictionaries(empty, remainder("doc_id", 4) != 2) == {}
    assert langid.identify(empty, learned).collect() == []


def test_long_clean_texts_stay(spark, more_docs):
    """Several MB of one language are as clear as a short text: more than the dictionary and the compressor's window hold."""
    learned = langid.fit_dictionaries(more_docs, remainder("doc_id", 4) != 2)
    texts = {}
    for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("lang", "text").collect():
        if r.lang in learned and r.text:
            texts.setdefault(r.lang, []).append(r.text)
    rows = []
    for i, (lang, parts) in enumerate(sorted(texts.items())):
        one = "\n".join(parts)[:8_000_000]
        rows += [(2 * i, one[:20_000], lang), (2 * i + 1, one, lang)]
    assert sum(len(r[1]) > 3_000_000 for r in rows) >= 2
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in langid.identify(df, learned, keep=["lang"]).collect()}
    assert len(got) == 2 * len(learned) and all(r.lang_pred == r.lang and not r.rejected for r in got.values())
    assert all(got[i + 1].score > 0.02 for i in range(0, len(rows), 2))


def test_token_counts(docs, edge, empty):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for df in (docs, edge):
        got = sorted((tuple(r) for r in token_counts.count_tokens(df, MODEL).collect()), key=repr)
        want = sorted([(r.doc_id, len((r.text or "").encode()), n := len(model.encode(r.text or "")), n > 4096) for r in df.collect()], key=repr)
        assert got == want
    assert token_counts.count_tokens(empty, MODEL).collect() == []


def test_token_counts_odd_spaces():
    counter = token_counts.PreTokens(MODEL, {"a": 1})
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for t in (" ", "  ", "a", " a", "a ", "a  b", "▁a", "a▁▁b ", "\na\n b", "\t", "  x   ", "é" * 3, "a\x00b", "</s> <unk>", "      indented     text  ", "　a b"):
        assert counter.count(t) == len(model.encode(t)), repr(t)
