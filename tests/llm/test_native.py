"""Fingerprints and line dedup against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

from palimpsest.llm import imatch, line_dedup

BLANKS = " \t\n\x0b\x0c\r"


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def brute_lines(rows, chars=40, many=5):
    held = defaultdict(set)
    for i, t in rows:
        for x in (t or "").split("\n"):
            held[lower(x.strip(BLANKS))].add(-(2**63) if i is None else i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        gone = [len(k := lower(x.strip(BLANKS))) >= chars and len(held[k]) >= many and max(held[k]) != i for x in lines]
        out.append((i, len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone) if not g)))
    return sorted(out, key=repr)


def lines_of(df, **kw):
    return sorted((tuple(r) for r in line_dedup.dedup_lines(df, **kw).collect()), key=repr)


def test_line_dedup(docs, edge, empty):
    assert lines_of(docs) == brute_lines([(r.doc_id, r.text) for r in docs.collect()])
    assert lines_of(edge, min_chars=1, min_documents=2) == brute_lines([(r.doc_id, r.text) for r in edge.collect()], 1, 2)
    assert lines_of(empty) == []


def test_line_dedup_hot_line(spark):
    rows = [(i, f"A line that very many documents hold, at {'any'} place \nown {i}\n a line THAT very many documents hold, at any place") for i in range(40)]
    assert lines_of(spark.createDataFrame(rows, "doc_id long, text string")) == brute_lines(rows)


def test_line_dedup_many_lines(spark):
    """A document of 100,000 repeated lines is done in time linear in its lines."""
    long = "\n".join(f"A line of some length that several documents repeat {k}" for k in range(100_000))
    rows = [(i, long) for i in range(6)]
    assert lines_of(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)) == brute_lines(rows)


def brute_edits(rows):
    rows = sorted(rows, key=lambda r: r[0])
    out = []
    for n, (i, t) in enumerate(rows):
        t, nxt = t or "", rows[(n + 1) % len(rows)][1] or ""
        k = len(t) // 4
        out.append((i, len(t), hashlib.sha256((t[: len(t) - k] + nxt[:k]).encode()).hexdigest()))
    return sorted(out)


def test_fingerprints(docs, empty):
    got = imatch.edited_pairs(docs, buckets=7).collect()
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == brute_edits([(r.doc_id, r.text) for r in docs.collect()])
    by_text = defaultdict(set)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in got:
        by_text[texts[r.doc_id]].add(r.fingerprint)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert all(len(x) == 1 for x in by_text.values())
    assert sum(r.near_edited for r in got) > 5 * sum(r.near_next for r in got)
    assert imatch.edited_pairs(empty).collect() == []


def test_fingerprints_edges(edge, spark):
    rows = edge.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id", "text"])
    got = imatch.edited_pairs(rows, buckets=5).collect()
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == brute_edits([(r.doc_id, r.text) for r in rows.collect()])
    assert imatch.edited_pairs(edge, buckets=3).count() == edge.count()
    same = {r.doc_id: r for r in got}
    assert same[3].fingerprint == same[4].fingerprint and same[3].near_next == 1.0
    one = imatch.edited_pairs(spark.createDataFrame([(5, "abcdefgh")], "doc_id long, text string"), buckets=4).collect()
    assert one[0].edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest()


def brute_prints(texts):
    """Fingerprints by the rule: band of terms, subsets by hash bits, chained hashes of sorted terms."""

    def signed(x):
        return x - 2**64 if x >= 2**63 else x

    def chain(terms):
        h = 42
        for t in terms:
            h = xxhash.xxh64_intdigest(t.to_bytes(8, "little", signed=True), seed=h)
        return h

    def terms(t):
        return {signed(xxhash.xxh64_intdigest(w.encode(), seed=42)) for w in re.split(imatch.GAP, (t or "").lower()) if w}

    df, n = Counter(h for t in texts for h in terms(t)), len(texts)
    band = {h for h, c in df.items() if max(2, imatch.LOW * n) <= c <= imatch.HIGH * n}

    def one(text):
        every = sorted(terms(text))
        kept, parts = [h for h in every if h in band], []
        for k in range(imatch.FAMILIES[0]):
            coarse = [h for h in kept if h & 7 == k]
            parts += [coarse] + [[h for h in coarse if h & 24 == m] for m in (0, 8, 16, 24)]
        return [chain(p) if p else None for p in parts] + [chain(every)]

    return one


def brute_likeness(a, b):
    if a[-1] == b[-1]:
        return 1.0
    pairs = [(x, y) for x, y in zip(a[:-1], b[:-1]) if x is not None or y is not None]
    return sum(x == y for x, y in pairs) / len(pairs) if pairs else 0.0


def test_fingerprints_against_brute_force(docs):
    rows = sorted((r.doc_id, r.text or "") for r in docs.collect())
    one = brute_prints([t for _, t in rows])
    got = {r.doc_id: r for r in imatch.edited_pairs(docs, buckets=3).collect()}
    for n, (i, text) in enumerate(rows):
        after = rows[(n + 1) % len(rows)][1]
        k = len(text) // 4
        edited = text[: len(text) - k] + after[:k]
        mine, its, theirs = one(text), one(edited), one(after)
        for want, shown in ((mine, got[i].fingerprint), (its, got[i].edited_fingerprint)):
            assert shown == "".join("-" * 8 if h is None else f"{h >> 32:08x}" for h in want[:-1]) + f"{want[-1]:016x}"
        assert abs(got[i].near_edited - brute_likeness(mine, its)) < 1e-12 and abs(got[i].near_next - brute_likeness(mine, theirs)) < 1e-12


def test_lexicon_is_the_band(docs):
    df = Counter(w for r in docs.collect() for w in {w for w in re.split(imatch.GAP, r.text.lower()) if w})
    n = docs.count()
    assert len(imatch.lexicon(docs)) == sum(max(2, imatch.LOW * n) <= c <= imatch.HIGH * n for c in df.values())
