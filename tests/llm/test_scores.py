"""Suffix-tree scores, top-k search and sampled segmentations against brute force."""

import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from palimpsest.llm import sampling, suffix_tree, topk
from palimpsest.llm.common import remainder

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def brute_base(rows):
    tokens = [(i, zlib.crc32(str("" if i is None else i).encode()) % 5 == 1, (t or "").encode().lower().split() + [b""]) for i, t in rows]
    c = Counter(w for _, held, ws in tokens if not held for w in ws)
    n, v = sum(c.values()), len(c)
    return [(i, held, len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), 6)) for i, held, ws in tokens]


def base_of(df):
    got = suffix_tree.score(df, remainder("doc_id", 5) == 1).collect()
    assert all(r.score <= 0 and math.isfinite(r.score) for r in got)
    return sorted([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got], key=repr), got


def test_base_scores(docs, edge, empty, monkeypatch):
    monkeypatch.setattr(suffix_tree, "TABLE_ENTRIES", 50)
    for df in (docs, edge):
        assert base_of(df)[0] == sorted(brute_base([(r.doc_id, r.text) for r in df.collect()]), key=repr)
    assert base_of(empty)[0] == []


def shards_of(kept, ends):
    return [suffix_tree.loaded(bytes(r.data)) for r in suffix_tree.shard_tables(kept, ends).orderBy("shard").collect()]


def test_tree_learns(more_docs):
    """Held-out texts cost well below a model of single bytes, whose cost is what a tree of the root alone gives."""
    train, held = (more_docs.filter((remainder("doc_id", 5) == 1) == x) for x in (False, True))
    texts = [suffix_tree.lowered(r.text) for r in held.collect()]
    kept = suffix_tree.retained(suffix_tree.context_counts(train)).cache()
    whole, root = (suffix_tree.Shards([], [lambda t=t: t]) for f in (kept, kept.filter("state = 0")) for t in shards_of(f, []))
    assert whole.scores(texts).sum() > 0.6 * root.scores(texts).sum()


def test_gram_counts(monkeypatch):
    monkeypatch.setattr(suffix_tree, "BLOCK", 50)
    rng = np.random.default_rng(0)
    texts = [bytes(rng.integers(97, 100, n).tolist()) for n in (0, 3, 120, 7, 55, 301, 1)]
    want = Counter()
    for t in texts:
        s = [0] * suffix_tree.DEPTH + [b + 1 for b in t] + [257]
        for i in range(suffix_tree.DEPTH, len(s)):
            want[sum(s[i - j] << 9 * j for j in range(suffix_tree.DEPTH + 1))] += 1
    codes, counts = suffix_tree.gram_counts(iter(texts))
    assert dict(zip(codes.tolist(), counts.tolist())) == want


def brute_tree(texts):
    """Contexts that pass the rule, by counting every one of each length."""
    count = {}
    for t in texts:
        s = [0] * suffix_tree.DEPTH + [b + 1 for b in suffix_tree.lowered(t)] + [257]
        for i in range(suffix_tree.DEPTH, len(s)):
            for d in range(suffix_tree.DEPTH + 1):
                count.setdefault(tuple(s[i - d : i]), Counter())[s[i]] += 1
    kept = {(): count[()]}
    for c, n in count.items():
        total, parent = sum(n.values()), count[c[1:]] if c else None
        if c and total >= suffix_tree.MIN_COUNT:
            nats = sum(x / total * math.log(x / total * sum(parent.values()) / parent[a]) for a, x in n.items())
            if nats >= suffix_tree.MIN_NATS and nats * total >= suffix_tree.MIN_TOTAL_NATS:
                kept[c] = n
    return kept


def test_retention(docs, monkeypatch):
    """The tree kept is that of the divergence test over all contexts; more text keeps more of it."""
    monkeypatch.setattr(suffix_tree, "MIN_COUNT", 5)
    sizes = []
    for part in (docs.filter("doc_id % 8 = 0"), docs):
        got = {}
        for r in suffix_tree.retained(suffix_tree.context_counts(part)).collect():
            d = r.state >> 9 * suffix_tree.DEPTH
            got.setdefault(tuple(r.state >> 9 * i & 511 for i in range(d - 1, -1, -1)), Counter())[r.next] = r.n
        assert got == brute_tree([r.text or "" for r in part.collect()])
        sizes.append(len(got))
    assert sizes[1] > 1.5 * sizes[0]


def test_contexts_rest_on_their_evidence_alone(spark):
    """A context that passes the test is kept however much other text the corpus has; ten times the text keeps every one of the smaller corpus."""
    rng = np.random.default_rng(3)
    texts = ["".join(rng.choice(["qua", "que", "bad", "bed"], 30)) for _ in range(40)]
    other = ["".join(rng.choice(list("xyz "), 90)) for _ in range(360)]
    states = [{r.state for r in suffix_tree.retained(suffix_tree.context_counts(spark.createDataFrame([(t,) for t in some], "text string"))).select("state").distinct().collect()} for some in (texts, texts + other, texts * 10)]
    own = {s for s in states[0] if all(s >> 9 * i & 511 not in (0, 257) for i in range(s >> 45))}
    assert len(own) > 8 and own <= states[1] and states[0] <= states[2]


@pytest.mark.parametrize(("block", "most", "keep"), [(16, 3, 0), (100, 10, 1 << 20), (1 << 20, 50_000, 0)])
def test_scores_follow_the_longest_retained_suffix(spark, monkeypatch, block, most, keep):
    """Whatever the blocks and shards."""
    monkeypatch.setattr(suffix_tree, "KEEP_BYTES", keep)
    rng = np.random.default_rng(5)
    texts = ["".join(rng.choice(["ab", "abc", "ca", "b "], 60)) for _ in range(40)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    kept = suffix_tree.retained(suffix_tree.context_counts(df)).cache()
    dist = {}
    for r in kept.collect():
        d = r.state >> 9 * suffix_tree.DEPTH
        dist.setdefault(tuple(r.state >> 9 * i & 511 for i in range(d - 1, -1, -1)), {})[r.next] = r.n
    assert len(dist) > 5

    def prob(context, a):
        if not context:
            total = sum(dist[()].values())
            return (dist[()].get(a, 0) + suffix_tree.FLOOR) / (total + 257 * suffix_tree.FLOOR)
        if context not in dist:
            return prob(context[1:], a)
        own, total = dist[context], sum(dist[context].values())
        return (own.get(a, 0) + suffix_tree.SMOOTHING * prob(context[1:], a)) / (total + suffix_tree.SMOOTHING)

    ends = suffix_tree.shard_ends(kept, most)
    assert (len(ends) > 1) == (most < 20)
    monkeypatch.setattr(suffix_tree, "BLOCK", block)
    shards = shards_of(kept, ends)
    assert len(shards) == len(ends) + 1
    model = suffix_tree.Shards(ends, [lambda x=x: x for x in shards])
    tests = [b"", b"abcab", b"zzz ab", texts[0].encode(), b"", bytes(range(256)), b"a" * 16, b"ab" * 16]
    for t, got in zip(tests, model.scores(tests)):
        s = [0] * suffix_tree.DEPTH + [b + 1 for b in t] + [257]
        want = sum(math.log10(prob(tuple(s[i - suffix_tree.DEPTH : i]), s[i])) for i in range(suffix_tree.DEPTH, len(s)))
        assert got == pytest.approx(want, rel=1e-5)


def brute_top(rows, k):
    ok = [(i, [math.floor(64 * x) if abs(64 * x) < 2**52 else int(64 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    queries = {}
    for i, v in ok:
        queries[i] = min(v, queries.get(i, v))
    out = []
    for q, a in queries.items():
        if q % 20 == 0:
            score = {n: max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(a, b)))) for n, (c, b) in enumerate(ok) if c != q and len(a) == len(b)}
            s = sorted((-x, ok[n][0]) for n, x in score.items())[:k]
            out += [(q, n + 1, c, -x) for n, (x, c) in enumerate(s)]
    return sorted(out)


def small_shards(monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 100)
    monkeypatch.setattr(topk, "SAMPLE_ROWS", 200)
    monkeypatch.setattr(topk, "LEAF", 8)


def test_top_k(spark, monkeypatch):
    small_shards(monkeypatch)
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=6).round(1).tolist()) for i in range(400)] + [(i, [0.5] * 6) for i in range(400, 560)]
    rows += [(560, None), (561, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (562, [float("nan")] * 6), (563, [float("inf")] * 6), (580, [1.0, 2.0]), (581, [3.0, 4.0]), (None, [1.0] * 6), (600, []), (601, [])]
    rows += [(20, [9.0] * 6), (20, [-9.0] * 6), (7, [0.1] * 6)]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, id string, cell int")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got = sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % 20 == 0).collect())
    assert got == brute_top(rows, 20)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 20 == 0).collect() == []


def test_top_k_of_large_components(spark, monkeypatch):
    """Components beyond exact doubles are scored in whole numbers, and scores beyond a long stand at its ends."""
    small_shards(monkeypatch)
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=4) * 10.0 ** rng.integers(-1, 12)).tolist()) for i in range(150)] + [(160, [1e30, 0.0, 0.0, 1.0]), (161, [-1e30, 1.0, 1.0, 1.0]), (162, [3e8] * 4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % 20 == 0, k=7).collect())
    assert got == brute_top(rows, 7)


def test_top_k_prunes_clusters(spark, monkeypatch):
    """On clustered vectors cells are left out and trees score a small part of all pairs."""
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(16, 12)) * 10
    points = np.floor(64 * (centres[rng.integers(0, 16, 4000)] + rng.normal(size=(4000, 12)) * 0.3))
    tree = topk.BallTree(np.arange(4000), points)
    tree.search(np.arange(200), points[:200], np.full(200, -np.inf), 20)
    assert tree.scored < 0.2 * 200 * 4000


@pytest.fixture(scope="module")
def vocabulary():
    return sampling.Vocabulary(MODEL)


def ways(word):
    """All spellings of a word with their log weights, by recursion over the model's own pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    normal = [i for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
    rank = {model.id_to_piece(i): (i, -math.log(r + sampling.RANK_OFFSET)) for r, i in enumerate(normal)}

    def go(at):
        if at == len(word):
            yield (), 0.0
            return
        steps = [(end, (rank[word[at:end]][0],), rank[word[at:end]][1]) for end in range(at + 1, len(word) + 1) if word[at:end] in rank]
        if word[at] not in rank:
            raw = word[at].encode()
            steps.append((at + 1, tuple(model.piece_to_id(f"<0x{b:02X}>") for b in raw), -len(raw) * math.log(len(normal) + sampling.RANK_OFFSET)))
        for end, ids, w in steps:
            for rest, q in go(end):
                yield ids + rest, w + q

    return dict(go(0))


def every_way(text):
    out = {(): 0.0}
    for word in sampling.split(text):
        out = {x + y: p + q for x, p in out.items() for y, q in ways(word).items()}
    total = math.log(sum(map(math.exp, out.values())))
    return {x: p - total for x, p in out.items()}


def drawn(vocabulary, text, k, n, key="k"):
    return [[(tuple(ids.tolist()), *x) for ids, *x in got] for got in sampling.sample(vocabulary, [f"{key}{i}" for i in range(n)], [text] * n, k)]


@pytest.mark.parametrize("text", ["the", "of an", "é\U0001f600 a"])
def test_samples_follow_the_lattice(text, vocabulary):
    """First samples have the lattice's probabilities, and pairs those of draws without replacement."""
    every, n, first, pairs = every_way(text), 8000, Counter(), Counter()
    for got in drawn(vocabulary, text, 2, n):
        assert len({x[0] for x in got}) == min(2, len(every)) and got[0][2] >= got[-1][2]
        assert all(x[1] == pytest.approx(every[x[0]], abs=1e-6) and x[3] <= 0 for x in got)
        first[got[0][0]] += 1
        pairs[got[0][0], got[-1][0]] += 1
    for way, p in every.items():
        assert first[way] / n == pytest.approx(math.exp(p), abs=0.025)
        for other, q in every.items():
            if other != way:
                assert pairs[way, other] / n == pytest.approx(math.exp(p) * math.exp(q) / -math.expm1(p), abs=0.025)


def test_third_samples_follow(vocabulary):
    every, n = every_way("a of"), 8000
    third = Counter(got[2][0] for got in drawn(vocabulary, "a of", 3, n))
    ways_ = {x: math.exp(p) for x, p in every.items()}
    for z, r in ways_.items():
        want = sum(p * q / (1 - p) * r / (1 - p - q) for x, p in ways_.items() for y, q in ways_.items() if len({x, y, z}) == 3)
        assert third[z] / n == pytest.approx(want, abs=0.025)


def test_inclusion_scores_weigh_up(vocabulary):
    """Sums over samples, each divided by its chance to be among them, estimate sums over all segmentations."""
    found = [sum(math.exp(p - q) for _, p, _, q in got) for got in drawn(vocabulary, "in the house", 4, 3000)]
    assert np.mean(found) == pytest.approx(1, abs=0.05)


def test_all_segmentations_of_a_short_text(vocabulary):
    every = every_way("of a")
    (got,) = drawn(vocabulary, "of a", len(every) + 5, 1)
    assert len(got) == len(every) and {x[0] for x in got} == set(every) and all(x[3] == 0.0 for x in got)


def test_samples_do_not_depend_on_company(vocabulary, monkeypatch):
    texts, keys = ["the house", "", "of the " * 50, "x" * 300, "an é\U0001f600"], list("abcde")
    whole = list(sampling.sample(vocabulary, keys, texts, 4))
    monkeypatch.setattr(sampling, "TOGETHER", 1)
    for got, want in zip(sampling.sample(vocabulary, keys, texts, 4), whole, strict=True):
        assert [x[0].tolist() for x in got] == [x[0].tolist() for x in want]
        assert [x[1:] for x in got] == [pytest.approx(x[1:]) for x in want]


def test_segmentations(docs, edge, empty, spark):
    got = sampling.sample_segmentations(edge, MODEL, ["doc_id"], k=2).collect()
    assert all(r.round_trip for r in got) and all(math.isfinite(r.log_inclusion) and r.log_inclusion <= 0 and r.log_prob <= 1e-9 for r in got)
    assert {r.doc_id: r.ids for r in got if r.doc_id in (0, 1)} == {0: [], 1: []}
    again = sampling.sample_segmentations(docs.limit(20).repartition(3), MODEL, ["doc_id"], k=2)
    assert sorted(map(str, again.collect())) == sorted(map(str, sampling.sample_segmentations(docs.limit(20), MODEL, ["doc_id"], k=2).collect()))
    assert sampling.sample_segmentations(empty, MODEL, ["doc_id"]).collect() == []


def test_long_words_are_like_short_ones(monkeypatch):
    """Words gone through position by position have the lattice and, by the same draws, the samples of those that go together; texts without spaces of any length are done."""
    vocabulary = sampling.Vocabulary(MODEL)
    rng = np.random.default_rng(8)
    words = ["".join(rng.choice(list("etaonis日本語\U0001f600é"), int(n))) for n in rng.integers(1, 90, 60)]
    texts = ["".join(words[:20]), " ".join(words), words[3]]
    found = []
    for long in (1000, 3):
        monkeypatch.setattr(sampling, "LONG", long)
        lattices = sampling.Lattices(vocabulary, words)
        found.append((lattices, list(sampling.sample(vocabulary, ["a", "b", "c"], texts, 3))))
    (a, samples), (b, others) = found
    assert (a.ids == b.ids).all() and (a.end == b.end).all() and np.abs(a.log_p - b.log_p).max() < 1e-6
    assert [[(x[0].tolist(), round(x[1], 4)) for x in t] for t in samples] == [[(x[0].tolist(), round(x[1], 4)) for x in t] for t in others]
    monkeypatch.setattr(sampling, "LONG", 96)
    for text in ("".join(rng.choice(list("etaonishrdlu"), 200_000)), "日本語" * 50_000, "\U0001f600" * 50_000):
        (got,) = sampling.sample(vocabulary, ["k"], [text], 3)
        assert len(got) == (3 if len(set(text)) > 3 else 1) and all(vocabulary.spells(ids, sampling.marked(text)) and math.isfinite(p) for ids, p, *_ in got)


def test_far_decisions_are_not_looked_at(vocabulary, monkeypatch):
    """Decisions that can't be among the best are left out: a long text looks at few of them, and has the samples that it has when all are looked at."""
    texts, seen, other = ["the house of many words " * 1000, "of a", "", "x" * 500], [], sampling.Lattices.other
    monkeypatch.setattr(sampling.Lattices, "other", lambda self, edge: seen.append(len(edge)) or other(self, edge))
    few, n_few = list(sampling.sample(vocabulary, list("abcd"), texts, 3)), sum(seen)
    monkeypatch.setattr(sampling, "NEAR", math.inf)
    every, n_every = list(sampling.sample(vocabulary, list("abcd"), texts, 3)), sum(seen) - n_few
    assert n_few < 0.2 * n_every
    monkeypatch.setattr(sampling, "NEAR", 1.0)  # too near to be sure: the rest is looked at after all
    for found in (every, sampling.sample(vocabulary, list("abcd"), texts, 3)):
        assert [[(x[0].tolist(), x[1:]) for x in t] for t in few] == [[(x[0].tolist(), pytest.approx(x[1:])) for x in t] for t in found]


def test_words_are_numbered_as_split():
    texts = ["a b", "", " a", "a ", "a  b a", "▁a ▁ b", "\n\ta b\n", "b", " ", "日本 a"]
    flat, counts, words = sampling.numbered(texts)
    assert counts.tolist() == [len(sampling.split(t)) for t in texts] and [words[i] for i in flat] == [w for t in texts for w in sampling.split(t)]
    assert len(set(words)) == len(words) and sampling.numbered([""])[1].tolist() == [0]
