"""One query for each operator, over its whole table, and SQL for its rows where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from palimpsest.llm import imatch, langid, license_scan, line_dedup, merkle, packing, prefix_trie, sampling, simhash, suffix_tree, token_counts, topk, url_filter
from palimpsest.llm.common import read, remainder


def op1_imatch_fingerprints(spark, sf_dir):
    return imatch.edited_pairs(read(spark, sf_dir, "documents"))


def op2_license_scan(spark, sf_dir):
    return license_scan.scan_licenses(read(spark, sf_dir, "documents")).drop("spans")


def op3_language_id(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    held_out = remainder("doc_id", 4) == 2
    learned = langid.fit_dictionaries(docs, ~held_out)
    return langid.identify(docs.withColumn("held_out", held_out), learned, keep=["held_out"])


def op4_suffix_tree_scores(spark, sf_dir):
    return suffix_tree.score(read(spark, sf_dir, "documents"), remainder("doc_id", 5) == 1)


def op5_simhash_neardup(spark, sf_dir):
    found = simhash.groups(read(spark, sf_dir, "documents"), simhash.EXACT)
    return found.select("doc_id", F.lower(F.lpad(F.hex("f0"), 16, "0")).alias("fingerprint"), "component_id")


def op6_gumbel_segmentations(spark, sf_dir):
    return sampling.sample_segmentations(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), ["doc_id"])


def op7_token_counts(spark, sf_dir):
    return token_counts.count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op8_exact_topk(spark, sf_dir):
    return topk.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op9_packing(spark, sf_dir):
    return packing.pack(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, public_tokenizers.path("byte_bpe_50k.json"))


def op10_line_dedup(spark, sf_dir):
    out = line_dedup.dedup_lines(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op11_merkle_manifest(spark, sf_dir):
    return merkle.check_tampering(read(spark, sf_dir, "documents"))


def op12_prefix_trie(spark, sf_dir):
    return prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.conversations(read(spark, sf_dir, "conversations"))))


def op13_url_filter(spark, sf_dir):
    return url_filter.judge(read(spark, sf_dir, "pages"), url_filter.default_rules(spark))


QUERIES = {name: f for name, f in sorted(globals().items()) if name.startswith("op")}

def _crc32(number: str) -> str:
    """CRC-32 of a number written in decimal, bit by bit."""
    text = f"CAST({number} AS VARCHAR)"
    byte = "list_reduce([xor(c, b)] || [0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END))"
    return f"xor(4294967295, list_reduce([CAST(4294967295 AS BIGINT)] || [CAST(ascii(substr({text}, CAST(i AS INTEGER), 1)) AS BIGINT) FOR i IN range(1, length({text}) + 1)], lambda c, b: {byte}))"


def _merkle_sql(levels: int = 12) -> str:
    """Leaves, trees and proofs level by level; `levels` of eight children each, ever enough for SQL."""
    field = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    leaf = lambda text: "sha256(" + " || ".join([field(c) for c in ("doc_id", "source", "lang", "n_chars")] + [field(text)]) + ")"
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    out = [
        f"own AS (SELECT doc_id, lang, {leaf('text')} AS leaf, CASE WHEN {_crc32('doc_id')} % 3 = 0 THEN {leaf(low)} ELSE {leaf('text')} END AS f FROM documents)",
        "r0 AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p, leaf AS d, '' AS proof FROM own)",
    ]
    def grow(name, of, by):
        rows, at = f"{name}0", "p"
        for k in range(levels):
            # A tree of one node stays; else runs of eight become one, and each row takes its run's other nodes.
            node = f"SELECT DISTINCT {by}, p, d FROM {name}{k}"
            out.append(f"{name}n{k} AS (SELECT *, count(*) OVER (PARTITION BY {by}) AS n FROM ({node}))")
            out.append(f"{name}s{k} AS (SELECT a.{by}, a.p, a.n, coalesce(string_agg(b.d, '' ORDER BY b.p) FILTER (WHERE b.p < a.p), '') AS l, coalesce(string_agg(b.d, '' ORDER BY b.p) FILTER (WHERE b.p > a.p), '') AS r "
                       f"FROM {name}n{k} a JOIN {name}n{k} b ON a.{by} IS NOT DISTINCT FROM b.{by} AND a.p // 8 = b.p // 8 GROUP BY ALL)")
            out.append(f"{name}{k + 1} AS (SELECT t.* REPLACE (CASE WHEN s.n > 1 THEN t.p // 8 ELSE t.p END AS p, CASE WHEN s.n > 1 THEN sha256(s.l || t.d || s.r) ELSE t.d END AS d, "
                       f"CASE WHEN s.n > 1 THEN sha256(s.l || t.f || s.r) ELSE t.f END AS f, CASE WHEN s.n > 1 THEN t.proof || s.l || s.r ELSE t.proof END AS proof) FROM {name}{k} t JOIN {name}s{k} s ON t.{by} IS NOT DISTINCT FROM s.{by} AND t.p = s.p)")
        return f"{name}{levels}"

    last = grow("r", "own", "lang")
    out.append("tops AS (SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS q FROM own GROUP BY lang)")
    out.append(f"u0 AS (SELECT {last}.doc_id, leaf, d AS subroot, q AS p, d, f, proof, 0 AS one FROM {last} JOIN tops ON {last}.lang IS NOT DISTINCT FROM tops.lang)")
    last = grow("u", "tops", "one")
    return f"WITH {', '.join(out)} SELECT doc_id, leaf, subroot, d AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = d AS verified FROM {last}"


ORACLES = {
    "op8_exact_topk": r"""
WITH v AS (SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS e FROM embeddings
 WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score FROM v q, v c WHERE q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20""",
    "op10_line_dedup": r"""
WITH lines AS (
 SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
many AS (SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT keyed.*, many.k IS NOT NULL AND keeper <> doc_id AS gone FROM keyed LEFT JOIN many ON keyed.k = many.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
 sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
    "op11_merkle_manifest": _merkle_sql(6),
    "op12_prefix_trie": rf"""
WITH t AS (SELECT conv_id, md5(coalesce(role, '') || chr(0) || coalesce(text, '')) AS id, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w,
 row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list(id ORDER BY p) AS ids, list(w ORDER BY p) AS ws, {_crc32("conv_id")} % 4 AS h FROM t GROUP BY conv_id),
s AS (SELECT c.conv_id, list_concat(coalesce(a.ids[1:c.h], []), c.ids[c.h + 1:]) AS ids, list_concat(coalesce(a.ws[1:c.h], []), c.ws[c.h + 1:]) AS ws FROM c LEFT JOIN c a ON a.conv_id = c.conv_id - c.conv_id % 20),
e AS (SELECT conv_id, ids, ws, unnest(range(len(ids) + 1)) AS d FROM s),
n AS (SELECT d, ids[1:d] AS k, min(conv_id) AS conv_id, count(*) AS n, any_value(CASE WHEN d > 0 THEN ws[d] ELSE 0 END) AS w,
 sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE len(ids) = d), '')) AS ends FROM e GROUP BY d, ids[1:d]),
ch AS (SELECT n.d, n.k, count(b.d) AS children FROM n LEFT JOIN n b ON b.d = n.d + 1 AND b.k[1:n.d] = n.k GROUP BY n.d, n.k),
m AS (SELECT n.*, ch.children FROM n JOIN ch ON n.d = ch.d AND n.k = ch.k),
up AS (SELECT m.*, unnest(range(d + 1)) AS a FROM m),
tot AS (SELECT a AS d, k[1:a] AS k, count(*) FILTER (WHERE children = 0) AS leaves, sum((n - 1) * w) AS saved FROM up GROUP BY a, k[1:a])
SELECT m.conv_id, m.d AS depth, b.conv_id AS parent_conv_id, m.n AS n_convs, m.children AS n_children, tot.leaves AS n_leaves, CAST(tot.saved AS BIGINT) AS saved_tokens, m.ends AS ends_sha256
FROM m JOIN tot ON m.d = tot.d AND m.k = tot.k LEFT JOIN n b ON b.d = m.d - 1 AND b.k = m.k[1:m.d - 1]""",
    "op13_url_filter": r"""
WITH u AS (SELECT page_id, url, instr(url, '://') AS k FROM pages),
r AS (SELECT page_id, CASE WHEN k > 0 THEN substr(url, k + 3) ELSE '' END AS rest FROM u),
p AS (SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM r),
rules AS (SELECT * FROM (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')) AS x(action, h, q)),
m AS (SELECT p.*, h || q AS rule, action, row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(h || q) DESC NULLS LAST) AS n
 FROM p LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q))
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM m WHERE n = 1""",
}
