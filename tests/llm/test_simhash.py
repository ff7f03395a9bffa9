"""SimHash groups against all pairs."""

import itertools
import re
from pathlib import Path

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import functions as F

from palimpsest.llm import simhash
from palimpsest.llm.components import connected


def brute_print(t, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    grams = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) if hs else 0


def brute_groups(prints):
    """prints: (id, fingerprint); component by repeated sweeps over all pairs."""
    label = {i: i for i, _ in prints}
    near = [(a, b) for n, (a, x) in enumerate(prints) for b, y in prints[:n] if (x ^ y).bit_count() <= 3]
    changed = True
    while changed:
        changed = False
        for a, b in near:
            m = min(label[a], label[b])
            if label[a] != m or label[b] != m:
                label[a] = label[b] = m
                changed = True
    return label


def test_groups(docs, edge, empty):
    for df in (docs, edge.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id", "text"])):
        rows = df.collect()
        prints = [(r.doc_id, brute_print(r.text)) for r in rows]
        got = simhash.groups(df).collect()
        assert sorted((r.doc_id, r.f0 % 2**64) for r in got) == sorted(prints)
        assert {r.doc_id: r.component_id for r in got} == brute_groups(prints)
    assert simhash.groups(edge).count() == edge.count()
    assert simhash.groups(empty).collect() == []


def test_blocks_cover_five_shared_bytes():
    assert len(simhash.BLOCKS) == 14
    assert all(any(set(b) <= set(five) for b in simhash.BLOCKS) for five in itertools.combinations(range(8), 5))


def test_postings_against_all_pairs(monkeypatch):
    """Dense, sparse and mixed postings, over several batches and with early looks at components, reach what all pairs reach."""
    rng = np.random.default_rng(3)
    for trial in range(6):
        monkeypatch.setattr(simhash, "FIRST_LOOK", 2 + 3 * trial)
        monkeypatch.setattr(simhash, "LONG_POSTING", (2048, 30)[trial % 2])
        low = rng.integers(0, 1 << (8 + 3 * trial), 500).astype(np.uint64)
        f = np.unique(low << np.uint64(8 * (trial % 5)) ^ np.uint64(0xABCDEF0123))
        rows = sorted((hash((n, int(x) & sum(0xFF << 8 * p for p in block))), int(x)) for n, block in enumerate(simhash.BLOCKS) for x in f)
        frame = pd.DataFrame({"key": [k for k, _ in rows], "f0": np.array([x for _, x in rows], np.uint64).view(np.int64)})
        out = pd.concat(simhash._postings(iter([frame[i : i + 333] for i in range(0, len(frame), 333)]), simhash.EXACT))
        got = brute_groups_of_links(f.tolist(), list(zip(out["a"].to_numpy(np.int64).view(np.uint64).tolist(), out["b"].to_numpy(np.int64).view(np.uint64).tolist())))
        assert got == brute_groups([(x, x) for x in f.tolist()])


def test_long_postings_lose_no_pair():
    """Fingerprints that agree in four, five, six bytes, searched in parts and whole, have the same components."""
    rng = np.random.default_rng(9)
    for free in (4, 3, 2, 1):
        places = np.sort(rng.choice(8, free, replace=False))
        f = np.full(400, 0x1234567890ABCDEF, np.uint64)
        for p in places:
            f ^= rng.integers(0, 256 if free < 4 else 16, 400).astype(np.uint64) << np.uint64(8 * int(p))
        f = np.unique(f)
        links = simhash.Links()
        simhash.LONG_POSTING, before = 50, simhash.LONG_POSTING
        try:
            simhash._search(np.zeros(len(f), np.int64), f, simhash.EXACT, links)
        finally:
            simhash.LONG_POSTING = before
        a, b = links.thin()
        assert brute_groups_of_links(f.tolist(), list(zip(a.tolist(), b.tolist()))) == brute_groups([(x, x) for x in f.tolist()])


def brute_groups_of_links(nodes, links):
    label = {x: x for x in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(label[a], label[b])
            if label[a] != m or label[b] != m:
                label[a] = label[b] = m
                changed = True
    return label


def test_rows_are_told_by_id_and_text(spark):
    """A copy goes, another text of the same id stays; rows that repeat id and text leave one; clashing columns stay as they are."""
    a, b, c = (" ".join(f"{x}{k}" for k in range(40)) for x in "abc")
    rows = [(1, a, 0), (2, a, 1), (2, b, 2), (None, b, 3), (None, c, 4), (None, c, 5), (3, None, 6), (4, " ", 7), (2, b, 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, rep int").withColumn("times", F.lit("x"))
    got = simhash.deduplicate(df)
    assert got.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == sorted([(1, a), (2, b), (None, c), (3, None)], key=repr)
    near = {(r.doc_id, r.component_id) for r in simhash.groups(df, simhash.NEAR).collect()}
    assert near == {(1, 1), (2, 1), (2, 2), (None, 2), (None, None), (3, 3), (4, 3)}


def test_near_plan_finds_near_copies(spark):
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(5000)]
    rows = []
    for g in range(60):
        base = list(rng.choice(words, 300))
        rows.append((2 * g, " ".join(base)))
        for at in (20, 150, 280):
            base[at] = "changed"
        rows.append((2 * g + 1, " ".join(base)))
    got = {r.doc_id: r.component_id for r in simhash.groups(spark.createDataFrame(rows, "doc_id long, text string"), simhash.NEAR).collect()}
    assert sum(got[2 * g + 1] == 2 * g for g in range(60)) >= 58
    assert all(got[i] // 2 == i // 2 for i in got)


def test_components(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(5, 3), (3, 5), (9, 9), (7, 5)]
    got = {r.node: r.component for r in connected(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {3: 3, 5: 3, 7: 3}
    assert connected(spark.createDataFrame([], "a long, b long")).collect() == []


def test_numbers_of_shingles_rule_pairs_out(spark):
    """Short texts have fingerprints close to that of no words; sets that can't be 0.8 alike aren't linked, equal ones are."""
    words = [f"w{i}" for i in range(60)]
    texts = [None, "", "..."] + [" ".join(words[i : i + 6]) for i in range(0, 54, 2)] + [" ".join(words), " ".join(words[:-1]), " ".join(words)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.groups(df, simhash.NEAR).collect()}
    n = len(texts)
    assert got[1] == 0 and got[n - 1] == got[n - 2] == n - 3
    assert all(got[i] == i for i in range(2, n - 3))


def _pairs(shared, n, count, seed):
    """Rows 2g and 2g + 1: n shingles of five words each, of which so many are the same."""
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(count):
        base = [f"g{g}w{x}" for x in rng.integers(0, 10**9, n + 4)]
        other = base[: shared + 4] + [f"h{g}w{x}" for x in rng.integers(0, 10**9, n - shared)]
        rows += [(2 * g, " ".join(base)), (2 * g + 1, " ".join(other))]
    return rows


def test_near_plan_at_the_similarity(spark):
    """Pairs at a similarity of exactly 0.8 are linked, those just below (79 / 101, 792 / 1008) never."""
    for shared, n, linked in ((80, 90, True), (800, 900, True), (79, 90, False), (792, 900, False)):
        count = 400 if n < 100 else 100
        got = {r.doc_id: r.component_id for r in simhash.groups(spark.createDataFrame(_pairs(shared, n, count, n), "doc_id long, text string"), simhash.NEAR).collect()}
        found = sum(got[2 * g + 1] == 2 * g for g in range(count))
        assert found >= 0.995 * count if linked else found == 0
        assert all(got[i] in (i, i - i % 2) for i in got)


def test_many_alike_rows(spark, monkeypatch):
    """With one look the search over shingles finds what the postings left out."""
    monkeypatch.setattr(simhash, "LOOKS", 1)
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join([*words[:150], *(f"x{i}y{k}" for k in range(9))])) for i in range(60)] + [(100 + i, " ".join([*words[:150], *(f"x{i}y{k}" for k in range(40))])) for i in range(60)]
    got = {r.doc_id: r.component_id for r in simhash.groups(spark.createDataFrame(rows, "doc_id long, text string"), simhash.NEAR).collect()}
    sets = {i: set(simhash.shingle_hashes(t, 5)) for i, t in rows}
    label = {i: i for i in sets}
    near = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    for _ in range(5):
        for a, b in near:
            label[a] = label[b] = min(label[a], label[b])
    assert got == label and len(near) > 1000


def test_exact_plan_links_the_same(more_docs, spark):
    """The search by prefixes alone gives the components of the fingerprints' plan, which by its bit model may lose one pair in 20,000; large groups of near copies are linked by few pairs."""
    near, exact = ({r.doc_id: r.component_id for r in simhash.groups(more_docs, plan).select("doc_id", "component_id").collect()} for plan in (simhash.NEAR, simhash.PREFIX))
    assert near == exact and len(set(exact.values())) < 0.95 * len(exact)
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join([*words, f"x{i}"])) for i in range(300)] + [(1000 + i, " ".join(f"y{i}z{k}" for k in range(30))) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    prints, classes = simhash._similar(df, simhash.PREFIX, "doc_id", "text")
    assert classes.select("component").distinct().count() == 51
    sets = spark.createDataFrame([(simhash.set_hash(m := simhash.shingle_set(simhash.shingle_hashes(t, 5))), m.tolist()) for _, t in rows], "shingles long, members array<long>")
    assert simhash._hubs(simhash._prefixes(sets, simhash.PREFIX), simhash.PREFIX).count() < 300 * 60
    got = simhash.groups(spark.createDataFrame(_pairs(80, 90, 200, 5), "doc_id long, text string"), simhash.PREFIX).collect()
    assert all(r.component_id == r.doc_id - r.doc_id % 2 for r in got)


def test_repeats_do_not_part_like_sets(spark):
    """A phrase twice or five times has the same six shingles; long repeated passages leave the similarity of sets as it is."""
    rows = []
    for g in range(50):
        phrase, base = [f"g{g}p{k}" for k in range(6)], [f"g{g}w{k}" for k in range(60)]
        rows += [(4 * g, " ".join(phrase * 2)), (4 * g + 1, " ".join(phrase * 5)), (4 * g + 2, " ".join([*base, *base[:12] * 9])), (4 * g + 3, " ".join([*base, *base[:12]]))]
    sets = {i: set(simhash.shingle_hashes(t, 5)) for i, t in rows}
    assert all(sets[i] == sets[i + 1] and len(sets[i]) == 6 and len(sets[i + 2] & sets[i + 3]) >= 0.8 * len(sets[i + 2] | sets[i + 3]) for i in range(0, 200, 4))
    got = {r.doc_id: r.component_id for r in simhash.groups(spark.createDataFrame(rows, "doc_id long, text string"), simhash.NEAR).collect()}
    assert got == {i: i - i % 2 for i in got}


def test_prefix_filter_loses_nothing(spark):
    """All pairs of a similarity of at least 0.8 and of different components are among those proposed, whatever the sets."""
    rng = np.random.default_rng(8)
    sets = {}
    for i in range(220):
        base = np.arange(40 * (i % 7), 40 * (i % 7) + int(rng.integers(1, 40)))
        gone = rng.random(len(base)) < rng.choice([0, 0.05, 0.2])
        sets[i] = sorted({*base[~gone].tolist(), *rng.integers(1000, 1400, int(rng.integers(0, 4))).tolist()}) or [i]
    df = spark.createDataFrame([(i, m) for i, m in sets.items()], "shingles long, members array<long>")
    labels = spark.createDataFrame([(i, i % 3) for i in range(30)], "node long, component long")
    label = {i: i % 3 if i < 30 else i for i in sets}
    got = {(r.a, r.b) for r in simhash._rest(simhash._prefixes(df, simhash.NEAR), labels, simhash.NEAR).collect()}
    want = {(a, b) for a in sets for b in sets if a < b and label[a] != label[b] and 5 * len({*sets[a]} & {*sets[b]}) >= 4 * len({*sets[a]} | {*sets[b]})}
    assert len(want) > 100 and want <= got
    assert {(r.a, r.b) for r in simhash._verified(simhash._rest(simhash._prefixes(df, simhash.NEAR), labels, simhash.NEAR), df, simhash.NEAR).collect()} == want


def test_prefixes_of_long_texts_take_little_disk(spark, monkeypatch):
    """Where every slot is in use, as over a large corpus, what the exact search stores stays below the sets themselves, however long they are; what sets share is among it."""
    monkeypatch.setattr(simhash, "SLOT_BITS", 8)
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(-(2**63), 2**63 - 1, 3000)) for _ in range(12)]
    sets[1] = np.unique(np.r_[sets[0][:2900], sets[1][:100]])
    df = spark.createDataFrame([(i, m.tolist()) for i, m in enumerate(sets)], "shingles long, members array<long>")
    found = simhash._prefixes(df, simhash.NEAR)
    size = sum(Path(f.removeprefix("file:").replace("///", "/")).stat().st_size for f in found.inputFiles())
    assert size < 8 * sum(map(len, sets))
    labels = spark.createDataFrame([], "node long, component long")
    assert [(r.a, r.b) for r in simhash._rest(found, labels, simhash.NEAR).collect()] == [(0, 1)]
