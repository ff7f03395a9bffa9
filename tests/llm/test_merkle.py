"""Manifest, proofs and tamper checks against a plain tree in Python."""

import hashlib
import zlib

import pytest

from palimpsest.llm import merkle

from .test_native import lower


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(values):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(leaves):
    """Root and, per leaf, its siblings as (before, after) up to the root."""
    levels = [list(leaves)]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][i : i + 8])) for i in range(0, len(levels[-1]), 8)])
    paths = []
    for i in range(len(leaves)):
        path = []
        for nodes in levels[:-1]:
            run = i - i % 8
            path.append(("".join(nodes[run:i]), "".join(nodes[i + 1 : run + 8])))
            i //= 8
        paths.append(path)
    return levels[-1][0], paths


def brute(rows):
    by = {}
    for r in rows:
        by.setdefault(r[2], []).append((r[0], leaf(r), r))
    subs, own = {}, []
    for lang, members in by.items():
        members.sort(key=lambda m: (m[0] is not None, m[0] or 0, m[1]))
        subs[lang], paths = tree([m[1] for m in members])
        own += [(lang, m, p) for m, p in zip(members, paths)]
    order = sorted(subs, key=lambda x: (x is not None, (x or "").encode()))
    root, tops = tree([subs[x] for x in order])
    out = []
    for lang, (i, digest, r), path in own:
        path = path + tops[order.index(lang)]
        start = digest
        if zlib.crc32(str(i if i is not None else "").encode()) % 3 == 0:
            start = leaf((*r[:4], None if r[4] is None else lower(r[4])))
        for a, b in path:
            start = h(a + start + b)
        out.append((i, digest, subs[lang], root, h("".join(a + b for a, b in path)), start, start == root))
    return sorted(out, key=repr)


def rows_of(df):
    return [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in df.collect()]


COLS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def got(df):
    out = merkle.check_tampering(df)
    assert out.columns == COLS
    return sorted((tuple(r) for r in out.collect()), key=repr)


def test_documents(more_docs):
    found = got(more_docs)
    assert found == brute(rows_of(more_docs))
    changed = sum(not x[-1] for x in found)
    assert 0.2 * len(found) < changed < 0.4 * len(found)


def test_odd_rows(edge, empty):
    assert got(edge) == brute(rows_of(edge)) and got(empty) == []


@pytest.mark.parametrize("n", [1, 2, 8, 9, 63, 64, 65, 513, 4097])
def test_tree_sizes(spark, n):
    """One tree of each height and of ragged runs, beside a tree of one leaf and one without lang."""
    rows = [(i, "s", "en", i, f"Text {i}") for i in range(n)] + [(n, None, "de", None, None), (n + 1, "s", None, 3, "Ohne"), (n + 2, "s", "\U0001f600", 1, "X"), (n + 3, "s", "￿", 1, "Y")]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert got(df.repartition(5)) == brute(rows)


def test_many_trees_and_copies(spark):
    """More trees than a block holds, and rows that repeat: copies take neighbouring places."""
    rows = [(i % 150, "s", f"l{i % 70}", 1, f"T{i % 150}") for i in range(1200)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert got(df) == brute(rows)


def test_changes_are_seen(spark):
    """A proof fails for any changed column, whatever the change."""
    rows = [(i, "s", "en", 5, "Abc D") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    from pyspark.sql import functions as F

    for change in ({"source": F.lit("t")}, {"n_chars": F.col("n_chars") + 1}, {"text": F.lit(None).cast("string")}):
        other = merkle.digest_of(*(change.get(c, F.col(c)) for c in merkle.COLUMNS))
        out = merkle.manifest(df, merkle.COLUMNS, "lang", "doc_id", other)
        assert out.filter(merkle.fold(F.col("leaf"), F.col("path")) != F.col("root")).isEmpty()
        assert out.filter(merkle.fold(F.col("changed_leaf"), F.col("path")) == F.col("root")).isEmpty()
