"""The registered queries of this folder and, where SQL can express one, its SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from folioflow.llm import bpe, bytesdup, extraction, language, manifest, pii, quality, sharding, simhash, substring, tiling, trie, warc
from folioflow.llm.common import table
from folioflow.session import new_folder

RANKS = "byte_bpe_multi_50k.tiktoken"


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.learn(docs))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(table(spark, sf_dir, "pages"))


def op6_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf_dir, "documents")).drop("kept_text")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.classes(table(spark, sf_dir, "documents"))


def op8_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytesdup.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.law_bytes(table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.judge(table(spark, sf_dir, "documents"))
    first = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return rows.select(*first, "posterior")


def op11_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest(table(spark, sf_dir, "documents"), manifest.tampered())


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = new_folder(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), archives)
    captured = warc.captures(warc.read_records(spark, archives, payloads=False))
    return warc.resolved(captured).drop("target_uri")


QUERIES = {
    "op1_pii": op1_pii,
    "op2_language": op2_language,
    "op3_bpe": op3_bpe,
    "op4_decontaminate": op4_decontaminate,
    "op5_extract": op5_extract,
    "op6_substring": op6_substring,
    "op7_simhash": op7_simhash,
    "op8_suffix": op8_suffix,
    "op9_sharding": op9_sharding,
    "op10_quality": op10_quality,
    "op11_trie": op11_trie,
    "op12_manifest": op12_manifest,
    "op13_warc": op13_warc,
}


def _crc32(text: str) -> str:
    """CRC-32 of ASCII text, bit by bit."""
    bits = "[0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]"
    bit = "CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::UBIGINT) ELSE x // 2 END"
    byte = f"list_reduce(list_prepend(xor(crc, byte), {bits}), lambda x, step: {bit})"
    bytes_ = f"[ascii(c)::UBIGINT FOR c IN string_split({text}, '')]"
    return f"xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT, {bytes_}), lambda crc, byte: {byte}))"


def _field(value: str) -> str:
    return f"coalesce(strlen({value}) || ':' || {value}, '-')"


# The other operators' models, tokenisers, hashes and searches have no SQL form; brute force tests them.
ORACLE: dict[str, str] = {
    "op6_substring": r"""
WITH split AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
),
windows AS (
    SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS run
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM split)
),
least AS (SELECT run, min(doc_id) AS first_id FROM windows GROUP BY run),
gone AS (
    SELECT DISTINCT doc_id, i + j AS place
    FROM (SELECT w.doc_id, w.i FROM windows w JOIN least l USING (run) WHERE l.first_id < w.doc_id), range(0, 13) t(j)
),
places AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM split),
kept AS (
    SELECT p.doc_id, string_agg(p.word, ' ' ORDER BY p.place) AS text, count(*) AS n
    FROM places p ANTI JOIN gone g ON p.doc_id = g.doc_id AND p.place = g.place
    GROUP BY p.doc_id
)
SELECT s.doc_id, len(s.words) AS n_words, len(s.words) - coalesce(k.n, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM split s LEFT JOIN kept k USING (doc_id)
""",
    "op13_warc": r"""
WITH read AS (
    SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS size FROM pages
),
newest AS (SELECT html, max(page_id) AS page_id FROM read WHERE size >= 1000 GROUP BY html)
SELECT r.page_id, r.size::BIGINT AS payload_bytes, sha1(r.html) AS payload_digest,
    CASE WHEN n.page_id <> r.page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN n.page_id <> r.page_id THEN n.page_id END AS refers_to
FROM read r LEFT JOIN newest n USING (html)
""",
    "op11_trie": f"""
WITH own AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos,
        coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL
),
convs AS (SELECT conv_id, conv_id - conv_id % 5 AS base, ({_crc32("CAST(conv_id AS VARCHAR)")} % 9)::BIGINT AS h FROM (SELECT DISTINCT conv_id FROM own)),
given AS (SELECT c.conv_id, o.pos, o.role, o.text FROM convs c JOIN own o ON o.conv_id = c.base AND o.pos < c.h),
taken AS (SELECT conv_id, count(*) AS n FROM given GROUP BY 1),
turns AS (
    SELECT * FROM given
    UNION ALL
    SELECT o.conv_id, o.pos - c.h + coalesce(t.n, 0), o.role, o.text
    FROM own o JOIN convs c USING (conv_id) LEFT JOIN taken t USING (conv_id) WHERE o.pos >= c.h
),
paths AS (
    SELECT conv_id, pos + 1 AS depth, strlen(text) AS width,
        md5(string_agg(strlen(role) || ':' || role || strlen(text) || ':' || text, '') OVER (PARTITION BY conv_id ORDER BY pos)) AS node
    FROM turns
    UNION ALL
    SELECT conv_id, 0, 0, 'root' FROM convs
),
ends AS (SELECT conv_id, max(depth) AS depth FROM paths GROUP BY 1),
nodes AS (
    SELECT p.node, any_value(p.depth) AS depth, min(p.conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(p.width) AS saved,
        bool_or(e.depth > p.depth) AS longer, sha256(coalesce(string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id) FILTER (e.depth = p.depth), '')) AS ends_sha256
    FROM paths p JOIN ends e USING (conv_id) GROUP BY p.node
),
under AS (SELECT DISTINCT a.node, b.node AS lower, b.depth - a.depth AS further FROM paths a JOIN paths b ON a.conv_id = b.conv_id AND b.depth >= a.depth),
sums AS (
    SELECT u.node, count(*) FILTER (further = 1) AS n_children, count(*) FILTER (NOT n.longer) AS n_leaves, sum(n.saved) AS saved_tokens
    FROM under u JOIN nodes n ON n.node = u.lower GROUP BY 1
),
above AS (SELECT DISTINCT u.lower AS node, n.conv_id AS parent FROM under u JOIN nodes n ON n.node = u.node WHERE further = 1)
SELECT n.conv_id, n.depth, a.parent AS parent_conv_id, n.n_convs, s.n_children, s.n_leaves, s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s USING (node) LEFT JOIN above a USING (node)
""",
    "op12_manifest": f"""
WITH RECURSIVE fields AS (
    SELECT doc_id, coalesce('+' || source, '') AS tree, text,
        {_field("CAST(doc_id AS VARCHAR)")} || {_field("source")} || {_field("lang")} || {_field("CAST(n_chars AS VARCHAR)")} AS front,
        CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 5 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS later
    FROM documents
),
leaves AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
    FROM (SELECT doc_id, tree, sha256(front || {_field("text")}) AS leaf, sha256(front || {_field("later")}) AS altered FROM fields)
),
up AS (
    SELECT tree, 0 AS level, pos, leaf AS h, count(*) OVER (PARTITION BY tree) AS n FROM leaves
    UNION ALL
    SELECT tree, level + 1, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), (n + 15) // 16 FROM up WHERE n > 1 GROUP BY tree, level, pos // 16, n
),
subroots AS (SELECT tree, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS place FROM up WHERE n = 1),
trunk AS (
    SELECT 0 AS level, place AS pos, subroot AS h, count(*) OVER () AS n FROM subroots
    UNION ALL
    SELECT level + 1, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), (n + 15) // 16 FROM trunk WHERE n > 1 GROUP BY level, pos // 16, n
),
every AS (SELECT tree, level, pos, h, n FROM up UNION ALL SELECT NULL, level, pos, h, n FROM trunk),
beside AS (
    SELECT tree, level, pos, coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
        coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
    FROM every WHERE n > 1 WINDOW w AS (PARTITION BY tree, level, pos // 16 ORDER BY pos)
),
inside AS (
    SELECT doc_id, leaf, tree, 0 AS level, pos, altered AS h, '' AS proof FROM leaves
    UNION ALL
    SELECT i.doc_id, i.leaf, i.tree, i.level + 1, i.pos // 16, sha256(b.before || i.h || b.after), i.proof || b.before || b.after
    FROM inside i JOIN beside b ON b.tree = i.tree AND b.level = i.level AND b.pos = i.pos
),
outside AS (
    SELECT i.doc_id, i.leaf, s.subroot, 0 AS level, s.place AS pos, i.h, i.proof
    FROM inside i JOIN subroots s USING (tree) JOIN up u ON u.tree = i.tree AND u.level = i.level AND u.n = 1
    UNION ALL
    SELECT o.doc_id, o.leaf, o.subroot, o.level + 1, o.pos // 16, sha256(b.before || o.h || b.after), o.proof || b.before || b.after
    FROM outside o JOIN beside b ON b.tree IS NULL AND b.level = o.level AND b.pos = o.pos
)
SELECT o.doc_id, o.leaf, o.subroot, t.h AS root, sha256(o.proof) AS proof_sha256, o.h AS folded_root, o.h = t.h AS verified
FROM outside o JOIN trunk t ON t.n = 1 AND t.level = o.level
""",
}
