"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnguard.llm import anchors, archive, cascade, dart, manifest, mixing, neighbours, ordinal, repair, sketch, spans, suffix, toxic
from txnguard.session import shared_folder
from txnguard.sources.tables import read_table


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, f"{folder}/documents.parquet")


def pii_model(docs: DataFrame) -> spans.Model:
    return spans.train(docs)


def op1_semi_markov_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    found = spans.find(docs, pii_model(docs))
    base = F.filter("spans", lambda s: s["base"])

    def joined(which: Column) -> Column:
        parts = F.transform(which, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
        return F.array_join(parts, ",")

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "row.doc_id",
        *map(count, spans.KINDS),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def op2_dart_minhash(spark: SparkSession, folder: str) -> DataFrame:
    found = dart.near_duplicates(documents(spark, folder))
    return found.select("doc_id", "class_id", "class_size")


def op3_scaled_sketch(spark: SparkSession, folder: str) -> DataFrame:
    return sketch.compare_with_next(documents(spark, folder))


def op4_difference_cover(spark: SparkSession, folder: str) -> DataFrame:
    return anchors.remove_repeats(documents(spark, folder), keep_text=False)


def op5_warc_archive(spark: SparkSession, folder: str) -> DataFrame:
    pages = read_table(spark, f"{folder}/pages.parquet")
    stored = archive.write_archive(pages, f"{shared_folder(spark)}/tables/{uuid.uuid4().hex}")
    return archive.read_archive(spark, stored).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "verified"
    )


def quality_grades(labels: DataFrame) -> DataFrame:
    """Graded ratings from the two labels: 0 poor, 1 good but toxic, 2 good."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("quality") == 1, F.when(F.col("toxic") == 1, 1).when(F.col("toxic") == 0, 2))
    return labels.select("doc_id", grade.alias("grade"))


def op6_ordinal_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    labels = read_table(spark, f"{folder}/labels.parquet").where(~held_out())
    model = ordinal.train(docs, quality_grades(labels), grades=3)
    found = ordinal.grade(docs, model)
    return found.select(
        "row.doc_id",
        held_out("row.doc_id").alias("held_out"),
        F.col("expected").alias("expected_grade"),
        F.col("at_least")[1].alias("p_at_least_1"),
        F.col("at_least")[2].alias("p_at_least_2"),
        (F.col("at_least")[1] >= 0.5).alias("selected"),
    )


def op7_water_filling(spark: SparkSession, folder: str) -> DataFrame:
    plan = mixing.plan_mix(documents(spark, folder), carried=["doc_id"])
    return plan.select("row.doc_id", "size", "source_size", "target", "taken")


def op8_suffix_array(spark: SparkSession, folder: str) -> DataFrame:
    benchmark = read_table(spark, f"{folder}/benchmark.parquet")
    found = suffix.find_matches(documents(spark, folder), benchmark)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        suffix.is_contaminated().alias("contaminated"),
        "longest",
        F.size("matches").cast("long").alias("n_matches"),
        F.sha2(F.to_json(F.array_sort("matches")), 256).alias("matches_sha256"),
    )


def held_out(id_col: str = "doc_id") -> Column:
    """The fifth of the rows, by id, whose labels no model sees."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def toxic_model(spark: SparkSession, folder: str) -> toxic.Model:
    labels = read_table(spark, f"{folder}/labels.parquet").where(~held_out())
    return toxic.train(documents(spark, folder), labels)


def op9_crf_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    found = toxic.score(docs, toxic_model(spark, folder))
    return found.select(
        "row.doc_id",
        held_out("row.doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("spans").alias("n_spans"),
    )


URL_RULES = [
    cascade.Rule("allow", "com", "/"),
    cascade.Rule("block", "example.com", "/en/"),
    cascade.Rule("allow", "www.example.com", "/en/"),
    cascade.Rule("block", "net", "/es/"),
    cascade.Rule("block", "net", "/fr/"),
]


def op10_bloom_cascade(spark: SparkSession, folder: str) -> DataFrame:
    pages = read_table(spark, f"{folder}/pages.parquet")
    return cascade.judge(pages, URL_RULES)


def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest of all documents, held against rows of which some were tampered with."""
    docs = documents(spark, folder)

    def row_leaf(n_chars: Column) -> Column:
        return manifest.leaf(F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text"))

    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    found = F.when(tampered & F.col("n_chars").isNotNull(), row_leaf(more))
    leaves = docs.select("doc_id", "lang", row_leaf(F.col("n_chars")).alias("leaf"), found.alias("found"))
    rows = manifest.build(leaves, "lang", "doc_id", "leaf", ["doc_id", "found"])
    return rows.select(
        "row.doc_id",
        "leaf",
        "subroot",
        "root",
        manifest.proof_digest(F.col("path")).alias("proof_sha256"),
        manifest.fold(F.coalesce("row.found", "leaf"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_learned_partitions(spark: SparkSession, folder: str) -> DataFrame:
    table = read_table(spark, f"{folder}/embeddings.parquet")
    return neighbours.nearest(table, F.col("vec_id") % 100 == 0)


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with faults by a hash of id and turn: rows lost, emptied, cut off, repeated, or made the user's."""
    spaced = turns.withColumns({c: F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text")})
    key = F.concat(*[x if isinstance(x, Column) else F.coalesce(F.col(x).cast("string"), F.lit(" ")) for x in ("conv_id", F.lit(":"), "turn")])
    kind = F.crc32(key) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    changed = spaced.withColumns({"text": text, "role": F.when(kind == 4, "user").otherwise(F.col("role")), "times": times})
    return changed.select("conv_id", "turn", "role", "text", F.explode(F.array_repeat(F.lit(0), F.col("times")))).drop("col")


def op13_dijkstra_repair(spark: SparkSession, folder: str) -> DataFrame:
    turns = read_table(spark, f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    found = repair.repair(damaged(turns))
    all_convs = turns.select("conv_id").distinct()
    whole = all_convs.join(found, all_convs["conv_id"].eqNullSafe(found["conv"]), "left")
    none = {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return whole.select("conv_id", *counts, *[F.coalesce(c, F.lit(x)).alias(c) for c, x in none.items()])


QUERIES = {f.__name__: f for f in (op1_semi_markov_pii, op2_dart_minhash, op3_scaled_sketch, op4_difference_cover, op5_warc_archive, op6_ordinal_quality, op7_water_filling, op8_suffix_array, op9_crf_toxicity, op10_bloom_cascade, op11_merkle_manifest, op12_learned_partitions, op13_dijkstra_repair)}
ORACLE_SQL: dict[str, str] = {
    "op5_warc_archive": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS html, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n FROM pages
        ), r AS (
            SELECT *, max(page_id) OVER (PARTITION BY html) AS response FROM p
        )
        SELECT page_id, n AS payload_bytes, sha1(html) AS payload_digest,
            CASE WHEN n >= 1000 AND page_id <> response THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN n >= 1000 AND page_id <> response THEN response END AS refers_to,
            true AS verified
        FROM r""",
    "op7_water_filling": r"""
        WITH d AS (
            SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
                md5('17:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS place
            FROM documents
        ), s AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END::DOUBLE AS w
            FROM d GROUP BY source
        ), c AS (
            SELECT *, 2.0::DOUBLE * source_size AS cap, 1.5::DOUBLE * sum(source_size) OVER () AS total FROM s
        ), o AS (
            SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                / sum(w) OVER (ORDER BY cap / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
            FROM c
        ), t AS (
            SELECT source, source_size, least(cap, w * (SELECT level FROM o WHERE level * w <= cap ORDER BY cap / w, source LIMIT 1)) AS target FROM o
        ), e AS (
            SELECT d.*, t.source_size, t.target, CAST(floor(t.target / t.source_size) AS BIGINT) AS repeats,
                coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY place, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
            FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
        )
        SELECT doc_id, size, source_size, target,
            CAST(repeats * size + greatest(0, least(size, CAST(round(target) AS BIGINT) - repeats * source_size - ahead)) AS BIGINT) AS taken
        FROM e""",
    "op10_bloom_cascade": r"""
        WITH u AS (
            SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substring(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages
        ), p AS (
            SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM u
        ), r AS (
            SELECT *, CASE
                WHEN ('.' || host) LIKE '%.www.example.com' AND path LIKE '/en/%' THEN 'www.example.com/en/'
                WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/en/%' THEN 'example.com/en/'
                WHEN ('.' || host) LIKE '%.net' AND path LIKE '/es/%' THEN 'net/es/'
                WHEN ('.' || host) LIKE '%.net' AND path LIKE '/fr/%' THEN 'net/fr/'
                WHEN ('.' || host) LIKE '%.com' AND path LIKE '/%' THEN 'com/'
                END AS rule
            FROM p
        )
        SELECT page_id, host, path, rule, rule IS NOT NULL AS listed,
            CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
        FROM r""",
    "op11_merkle_manifest": """
        WITH RECURSIVE crc_table AS (
            SELECT list(list_reduce([c] || range(8), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) ORDER BY c) AS t
            FROM range(256) r(c)
        ), docs AS (
            SELECT *, concat_ws('', coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
                    coalesce(strlen(lang) || ':' || lang, '-')) AS head,
                coalesce(strlen(text) || ':' || text, '-') AS tail,
                xor(4294967295, list_reduce([4294967295] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
                    lambda x, b: xor(x >> 8, t[1 + (xor(x, b) & 255)]))) AS crc
            FROM documents, crc_table
        ), leaves AS (
            SELECT doc_id, lang, sha256(head || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
                CASE WHEN crc % 7 = 0 THEN sha256(head || coalesce(strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-') || tail) END AS found
            FROM docs
        ), placed AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves
        ), nodes AS (
            SELECT lang, 0 AS level, pos, leaf AS hash, count(*) OVER (PARTITION BY lang) AS n FROM placed
            UNION ALL
            SELECT lang, level + 1, pos // 2, sha256(string_agg(hash, '' ORDER BY pos)), (n + 1) // 2
            FROM nodes WHERE n > 1 GROUP BY lang, level, n, pos // 2
        ), subroots AS (
            SELECT lang, hash AS subroot, level AS depth, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos FROM nodes WHERE n = 1
        ), tops AS (
            SELECT 0 AS level, pos, subroot AS hash, count(*) OVER () AS n FROM subroots
            UNION ALL
            SELECT level + 1, pos // 2, sha256(string_agg(hash, '' ORDER BY pos)), (n + 1) // 2 FROM tops WHERE n > 1 GROUP BY level, n, pos // 2
        ), steps AS (
            SELECT p.doc_id, p.lang, p.pos, n.level AS step, (p.pos >> n.level) & 1 = 1 AS onleft, s.hash AS sibling
            FROM placed p JOIN nodes n ON n.lang IS NOT DISTINCT FROM p.lang AND n.pos = p.pos >> n.level AND n.n > 1
            LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM p.lang AND s.level = n.level AND s.pos = xor(n.pos, 1)
            UNION ALL
            SELECT p.doc_id, p.lang, p.pos, r.depth + n.level, (r.pos >> n.level) & 1 = 1, s.hash
            FROM placed p JOIN subroots r ON r.lang IS NOT DISTINCT FROM p.lang JOIN tops n ON n.pos = r.pos >> n.level AND n.n > 1
            LEFT JOIN tops s ON s.level = n.level AND s.pos = xor(n.pos, 1)
        ), paths AS (
            SELECT lang, pos, sha256(coalesce(string_agg(sibling, '' ORDER BY step), '')) AS proof_sha256,
                list({l: onleft, s: coalesce(sibling, '')} ORDER BY step) AS path
            FROM steps GROUP BY lang, pos
        ), folded AS (
            SELECT p.lang, p.pos, 0 AS step, coalesce(found, leaf) AS hash FROM placed p
            UNION ALL
            SELECT f.lang, f.pos, f.step + 1, sha256(CASE WHEN s.onleft THEN coalesce(s.sibling, '') || f.hash ELSE f.hash || coalesce(s.sibling, '') END)
            FROM folded f JOIN steps s ON s.lang IS NOT DISTINCT FROM f.lang AND s.pos = f.pos AND s.step = f.step
        )
        SELECT p.doc_id, p.leaf, r.subroot, t.hash AS root, coalesce(w.proof_sha256, sha256('')) AS proof_sha256,
            f.hash AS folded_root, f.hash = t.hash AS verified
        FROM placed p JOIN subroots r ON r.lang IS NOT DISTINCT FROM p.lang CROSS JOIN (SELECT hash FROM tops WHERE n = 1) t
        LEFT JOIN paths w ON w.lang IS NOT DISTINCT FROM p.lang AND w.pos = p.pos
        JOIN (SELECT lang, pos, arg_max(hash, step) AS hash FROM folded GROUP BY lang, pos) f ON f.lang IS NOT DISTINCT FROM p.lang AND f.pos = p.pos""",
}
