"""The operators' queries over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genoloom.llm import bpe, exact_dedup, jaccard_join, licenses, line_dedup, manifest, mixing, packing, pii, quality, runs, token_store, toxicity
from genoloom.llm.common import ship
from genoloom.session import shared_folder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base_spans", 256).alias("base_sha256"), "spans")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.classes(_table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link_documents(_table(spark, sf_dir, "documents")).members.select("doc_id", "n_shingles", "component_id")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(_table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_pieces", "chars_per_piece", "chars_per_token", "fallback_share", "piece_entropy")


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op10_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark)
    token_store.write_store(_table(spark, sf_dir, "documents"), path)
    return token_store.read_documents(spark, path)


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = runs.find_runs(runs.plant_repeats(docs))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.*",
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(runs.runs_line(), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = manifest.build(_table(spark, sf_dir, "documents"), claimed={"n_chars": manifest.tampered_chars()})
    return built.proofs.select("doc_id", "leaf", "subroot", "root", F.sha2("siblings", 256).alias("proof_sha256"), "folded_root", "verified")


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoded = bpe.encode_documents(_table(spark, sf_dir, "documents"), path)
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(bpe.decoded("ids", path), 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_line_dedup": op3_line_dedup,
    "op4_packing": op4_packing,
    "op5_toxicity": op5_toxicity,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_mixing": op7_mixing,
    "op8_quality": op8_quality,
    "op9_licenses": op9_licenses,
    "op10_token_store": op10_token_store,
    "op11_runs": op11_runs,
    "op12_manifest": op12_manifest,
    "op13_bpe": op13_bpe,
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOWERED = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"

# A leaf of the manifest, and the CRC-32 of a decimal doc_id, bit by bit.
_FIELDS = "sha256(" + " || ".join(
    f"coalesce(strlen({f}::VARCHAR) || ':' || {f}::VARCHAR, '-')" for f in ("doc_id", "source", "lang", "{n_chars}", "text")) + ")"
_CRC = """xor(4294967295, list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT), lambda a, c: list_reduce(range(8),
    lambda v, i: CASE WHEN (v & 1) = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, xor(a, c)), 4294967295::BIGINT))"""

ORACLES: dict[str, str] = {
    "op2_exact_dedup": f"""
        WITH d AS (SELECT doc_id, sha256({_LOWERED}) AS text_sha256, {_LOWERED} AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, text_sha256
        FROM d WINDOW w AS (PARTITION BY t)""",
    "op3_line_dedup": f"""
        WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                          unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents),
        k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_LOWER}') AS key FROM l),
        o AS (SELECT *, length(key) >= 10 AND doc_id > min(doc_id) OVER (PARTITION BY key) AS dropped FROM k)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
        FROM o GROUP BY doc_id""",
    "op6_jaccard_join": f"""
        WITH RECURSIVE d AS (SELECT doc_id, list_filter(string_split_regex({_LOWERED}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM d),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
        l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 75 * (na.n + nb.n - k)),
        e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
        r(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, (SELECT min(r.b) FROM r WHERE r.a = d.doc_id) AS component_id
        FROM d LEFT JOIN n ON n.doc_id = d.doc_id""",
    "op7_mixing": """
        WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM documents),
        s AS (SELECT source, sum(size) AS source_size, count(*) AS docs FROM d GROUP BY source),
        r AS (SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight, 3 * source_size AS cap FROM s),
        v AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM r),
        t AS (SELECT *, least(weight * max(CASE WHEN level * weight <= cap THEN level END) OVER (), cap::DOUBLE) AS target,
                CAST(ceil(docs / 2000.0) AS BIGINT) AS n_blocks FROM v),
        u AS (SELECT source, source_size, target, n_blocks, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS times FROM t),
        p AS (SELECT d.*, source_size, target, times, target - times * source_size AS remains, md5('mix-1|doc|' || coalesce(CAST(doc_id AS VARCHAR), '-')) AS key,
                CAST('0x' || substr(md5('mix-1|doc|' || coalesce(CAST(doc_id AS VARCHAR), '-')), 1, 8) AS BIGINT) % n_blocks AS block
              FROM d JOIN u ON d.source IS NOT DISTINCT FROM u.source),
        b AS (SELECT source, block, sum(size) AS words, coalesce(sum(sum(size)) OVER (PARTITION BY source
                ORDER BY md5('mix-1|block|' || coalesce(source, '-') || '|' || block), block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
              FROM p GROUP BY source, block),
        q AS (SELECT p.*, words, remains - before AS room,
                coalesce(sum(size) OVER (PARTITION BY p.source, p.block ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used
              FROM p JOIN b ON p.source IS NOT DISTINCT FROM b.source AND p.block = b.block)
        SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target,
               CAST(size * (times + CASE WHEN remains > 0 AND words <= room THEN 1 WHEN room > 0 AND used + size / 2.0 <= room THEN 1 ELSE 0 END) AS BIGINT) AS taken
        FROM q""",
    "op12_manifest": f"""
        WITH RECURSIVE d AS (SELECT doc_id, lang, {_FIELDS.format(n_chars="n_chars")} AS leaf,
                {_FIELDS.format(n_chars=f"(CASE WHEN {_CRC} % 7 = 0 THEN n_chars + 1 ELSE n_chars END)")} AS claim FROM documents),
        l AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY lang) AS n FROM d),
        t(lang, level, place, n, h) AS (SELECT lang, 0, place, n, leaf FROM l
            UNION ALL SELECT lang, level + 1, place // 2, any_value((n + 1) // 2), sha256(string_agg(h, '' ORDER BY place)) FROM t WHERE n > 1 GROUP BY lang, level, place // 2),
        s AS (SELECT lang, h AS subroot, level AS height, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, count(*) OVER () AS n FROM t WHERE n = 1),
        u(level, place, n, h) AS (SELECT 0, place, n, subroot FROM s
            UNION ALL SELECT level + 1, place // 2, any_value((n + 1) // 2), sha256(string_agg(h, '' ORDER BY place)) FROM u WHERE n > 1 GROUP BY level, place // 2),
        r AS (SELECT h AS root, level AS height FROM u WHERE n = 1),
        p AS (SELECT l.*, s.subroot, s.height, s.place AS top, r.root, unnest(range(s.height + r.height)) AS step FROM l JOIN s ON l.lang IS NOT DISTINCT FROM s.lang, r),
        q AS (SELECT *, step >= height AS up, CASE WHEN step < height THEN step ELSE step - height END AS level,
                CASE WHEN step < height THEN place >> step ELSE top >> (step - height) END AS node FROM p),
        x AS (SELECT q.*, coalesce(t.h, u.h) AS h FROM q LEFT JOIN t ON NOT up AND t.lang IS NOT DISTINCT FROM q.lang AND t.level = q.level AND t.place = xor(node, 1)
                LEFT JOIN u ON up AND u.level = q.level AND u.place = xor(node, 1)),
        y AS (SELECT lang, place, string_agg(h, '' ORDER BY step) AS proof,
                list(CASE WHEN h IS NULL THEN '-' WHEN node % 2 = 0 THEN 'R' || h ELSE 'L' || h END ORDER BY step) AS path FROM x GROUP BY lang, place),
        z AS (SELECT l.*, s.subroot, r.root, coalesce(proof, '') AS proof, list_reduce(coalesce(path, []), lambda a, b: sha256(CASE left(b, 1) WHEN '-' THEN a WHEN 'R' THEN a || b[2:] ELSE b[2:] || a END), claim) AS folded_root
              FROM l JOIN s ON l.lang IS NOT DISTINCT FROM s.lang CROSS JOIN r LEFT JOIN y ON l.lang IS NOT DISTINCT FROM y.lang AND l.place = y.place)
        SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded_root, folded_root = root AS verified FROM z""",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    return dict(ORACLES)
