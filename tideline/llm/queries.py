"""The registered query of each operator of this folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import (
    centroids, chat, hard_negatives, mixing, packing, piece_encoding, quality_rules, quality_trees, simhash, substrings, toxicity,
    vector_links, warc,
)
from tideline.llm.text import words_of
from tideline.session import working_folder, written

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return quality_trees.scored(documents, quality_trees.train(documents, table(spark, sf_dir, "labels")))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Texts are measured once; the counts are what both the cutoffs and the verdicts need.
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    measured = written(quality_rules.measured(documents).drop("text"), "measures")
    labelled = measured.join(quality_rules.good_labels(table(spark, sf_dir, "labels")), "doc_id")
    cutoffs = quality_rules.thresholds(labelled, "lang", "good")
    verdicts = quality_rules.judged(measured, cutoffs, "lang")
    return verdicts.select(
        "doc_id", *[f"measures.{name}" for name in quality_rules.BASE],
        "verdict.base_failed", "verdict.kept", "verdict.rejected_by",
    )


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.report(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return toxicity.scored(documents, toxicity.train(documents, table(spark, sf_dir, "labels")))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.sql(f"""
        SELECT CAST(-7 AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, role, '{said}' AS text
        FROM VALUES (0, 'user'), (1, 'assistant') AS t(turn, role)
    """)
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.digests(chat.formatted(turns.withColumn("content", chat.text_part("text"))))


def op6_vector_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_links.linked(table(spark, sf_dir, "embeddings"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op8_balanced_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    sized = written(documents.select("doc_id", "source", F.size(words_of("text")).cast("long").alias("words")), "sizes")
    rows, names = mixing.mixed(sized, size="words")
    return rows.select(
        "doc_id", F.col("words").alias("size"), F.col(names["source_size"]).alias("source_size"),
        F.col(names["target"]).alias("target"), (F.col("words") * F.col(names["copies"])).alias("taken"),
    )


def op9_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.grouped(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = working_folder(spark, "warc")
    warc.write_pages(table(spark, sf_dir, "pages"), f"{root}/first")
    warc.deduplicate(spark, f"{root}/first", f"{root}/deduplicated")
    return warc.resolved(spark, f"{root}/deduplicated")


def op11_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "documents").select("doc_id", "text")
    back = piece_encoding.decoded(piece_encoding.encoded(texts).drop("text"))
    return back.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    relabelled = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"), "embedding"
    )
    return hard_negatives.mined(relabelled, F.col("vec_id") % 100 == 0)


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.report(*centroids.clustered(table(spark, sf_dir, "embeddings")))


def _centroid_rounds() -> str:
    """The clustering as SQL: per round, assignments ``a<i>`` and the next centroids ``c<i + 1>``."""
    distance = "list_sum([(v.e[i] - c.e[i]) * (v.e[i] - c.e[i]) for i in range(1, 65)])"
    nearest = f"""
        SELECT r, vec_id, e, struct_extract(best, 'd') AS d, struct_extract(best, 'c') AS c FROM (
            SELECT v.r, any_value(v.vec_id) AS vec_id, any_value(v.e) AS e, min({{'d': {distance}, 'c': c.c}}) AS best
            FROM v CROSS JOIN {{0}} c GROUP BY v.r
        )
    """.replace("{'d'", "{{'d'").replace("c.c})", "c.c}})")
    steps = []
    for i in range(centroids.ROUNDS + 1):
        steps.append(f"a{i} AS MATERIALIZED ({nearest.format(f'c{i}')})")
        if i < centroids.ROUNDS:
            steps.append(f"""
                s{i} AS (SELECT c, p, CAST(floor_div AS BIGINT) AS x FROM (
                    SELECT c, p, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS floor_div
                    FROM (SELECT c, unnest(e) AS x, generate_subscripts(e, 1) AS p FROM a{i}) GROUP BY c, p
                )),
                m{i} AS (SELECT c, list(x ORDER BY p) AS e FROM s{i} GROUP BY c),
                c{i + 1} AS MATERIALIZED (SELECT c{i}.c, coalesce(m{i}.e, c{i}.e) AS e FROM c{i} LEFT JOIN m{i} USING (c))
            """)
    return ",\n".join(steps)


#: DuckDB SQL of the queries that SQL can express.
ORACLES: dict[str, str] = {
    "op3_substring_dedup": r"""
        WITH d AS (
            SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
        ), starts AS (
            SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d
        ), windows AS (
            SELECT r, i, array_to_string(w[i:i + 34], ' ') AS s FROM starts
        ), again AS (
            SELECT s FROM windows GROUP BY s HAVING count(*) > 1
        ), gone AS (
            SELECT DISTINCT r, unnest(range(i, i + 35)) AS p FROM windows WHERE s IN (SELECT s FROM again)
        ), words AS (
            SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d
        ), kept AS (
            SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS k FROM words ANTI JOIN gone USING (r, p) GROUP BY r
        )
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
               sha256(coalesce(k, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (r)
    """,
    "op5_chat_format": r"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
        ), e AS (
            SELECT *, replace(replace(text, '~', '~0'), '<', '~1') AS body,
                   replace(replace(replace(role, '~', '~0'), '<', '~1'), chr(10), '~2') AS head FROM t
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, body)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, body) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(length('<|turn|>') + length(head) + 1 + length(body) + length('<|end|>')) AS BIGINT) AS formatted_chars
        FROM e GROUP BY conv_id
    """,
    "op6_vector_links": """
        WITH RECURSIVE v AS (
            SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
        ), u AS (
            SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS n FROM v
        ), links AS (
            SELECT a.vec_id AS i, b.vec_id AS j FROM u a JOIN u b
            ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND a.n > 0 AND b.n > 0
               AND list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.98
        ), reach AS (
            SELECT vec_id AS i, vec_id AS j FROM v UNION SELECT reach.i, links.j FROM reach JOIN links ON reach.j = links.i
        ), roots AS (
            SELECT i, min(j) AS component_id FROM reach GROUP BY i
        ), counts AS (
            SELECT i, count(*) AS n FROM links GROUP BY i
        )
        SELECT v.vec_id, coalesce(counts.n, 0) AS n_links, component_id, v.vec_id = component_id AS kept
        FROM v JOIN roots ON v.vec_id = roots.i LEFT JOIN counts ON v.vec_id = counts.i
    """,
    "op12_hard_negatives": """
        WITH v AS (
            SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS e
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
        ), s AS MATERIALIZED (
            SELECT a.r, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
            FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.r <> b.r AND len(a.e) = len(b.e)
        ), p AS (
            SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS k FROM s WHERE same QUALIFY k <= 5
        ), n AS (
            SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
                   row_number() OVER (PARTITION BY p.r, p.k ORDER BY s.score DESC, s.vec_id) AS rank
            FROM p JOIN s ON p.r = s.r AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score
            QUALIFY rank <= 5
        )
        SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n
    """,
    "op13_centroids": f"""
        WITH v AS MATERIALIZED (
            SELECT row_number() OVER () AS r, vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS e
            FROM embeddings WHERE len(embedding) = 64 AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
        ), c0 AS MATERIALIZED (
            SELECT CAST(row_number() OVER (ORDER BY h) - 1 AS INTEGER) AS c, e
            FROM (SELECT sha256('2:' || CAST(vec_id AS VARCHAR)) AS h, e FROM v WHERE vec_id IS NOT NULL ORDER BY h, e LIMIT 40)
        ), {_centroid_rounds()},
        t AS (SELECT c, CAST(sum(d) AS BIGINT) AS cluster_inertia FROM a5 GROUP BY c)
        SELECT vec_id, c AS cluster, CAST(d AS BIGINT) AS distance, cluster_inertia,
               (SELECT CAST(sum(d) AS BIGINT) FROM a5) AS inertia, sha256(array_to_string(c5.e, ',')) AS centroid_sha256
        FROM a5 JOIN t USING (c) JOIN c5 USING (c)
    """,
    "op10_warc_revisits": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes FROM pages
        ), d AS (
            SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
                   max(page_id) OVER (PARTITION BY html) AS latest FROM p
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND page_id < latest THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id < latest THEN latest END AS refers_to
        FROM d
    """,
}

ALL: tuple[Query, ...] = (
    op1_quality_trees, op2_quality_rules, op3_substring_dedup, op4_toxicity, op5_chat_format, op6_vector_links,
    op7_packing, op8_balanced_mix, op9_simhash_groups, op10_warc_revisits, op11_piece_encoding, op12_hard_negatives,
    op13_centroids,
)


def registered() -> dict[str, Query]:
    return {query.__name__: query for query in ALL}


def statements() -> dict[str, str]:
    return dict(ORACLES)
