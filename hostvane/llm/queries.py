"""The corpus operators applied, with their production parameters, to the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from hostvane.llm import alignment, decontaminate, langid, licenses, lines, negatives, packed_output, packing, pii, simhash, token_counts, topk, warc
from hostvane.llm.registry import ORACLES, QUERIES, query  # noqa: F401
from hostvane.llm.shared import table


def _values(rows) -> str:
    return ", ".join(str(row) for row in rows)


#: Phrases by their words; notices by all stretches around each unchanged part, compared by edit distance.
LICENSE_SQL = rf"""
    WITH doc AS (
      SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    line AS (SELECT row_number() OVER () AS r, doc_id, w, CASE WHEN len(w) > 0 THEN ' ' || array_to_string(w, ' ') || ' ' ELSE '' END AS l
             FROM doc),
    phrase(label, p) AS (VALUES {_values(licenses.PHRASES)}),
    base AS (
      SELECT r, label, unnest(list_filter(range(0, len(w)),
        lambda i: array_to_string(w[i + 1 : i + len(string_split(p, ' '))], ' ') = p)) AS place
      FROM line JOIN phrase ON contains(l, ' ' || p || ' ')),
    bases AS (SELECT r, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
                     list(DISTINCT label) AS base_list FROM base GROUP BY r),
    notice(label, n, k) AS (VALUES {_values(licenses.NOTICES)}),
    part AS (
      SELECT label, n, k, length(n) * j // (k + 1) AS a,
             substr(n, length(n) * j // (k + 1) + 1, length(n) * (j + 1) // (k + 1) - length(n) * j // (k + 1)) AS seed
      FROM (SELECT *, unnest(range(0, k + 1)) AS j FROM notice)),
    cut AS (SELECT r, l, part.*, string_split(l, seed) AS pieces FROM line JOIN part ON contains(l, seed)),
    hit AS (
      SELECT r, l, label, n, k, a, unnest(list_transform(range(1, len(pieces)), lambda j:
        list_sum(list_transform(pieces[1:j], lambda x: length(x)))::BIGINT + (j - 1) * length(seed) + 1)) AS place FROM cut),
    started AS (SELECT *, unnest(range(place - a - k, place - a + k + 1)) AS s FROM hit),
    stretch AS (SELECT *, unnest(range(length(n) - k, length(n) + k + 1)) AS m FROM started WHERE s >= 1),
    edited AS (SELECT r, label, n, min(levenshtein(substr(l, s, m), n)) AS e FROM stretch
               WHERE s + m - 1 <= length(l) GROUP BY r, label, n, k HAVING e <= k),
    near AS (SELECT r, list(DISTINCT label) AS near_list, max(1 - e::DOUBLE / length(n)) AS best FROM edited GROUP BY r)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
           coalesce(array_to_string(list_sort(base_list), ','), '') AS base_labels,
           array_to_string(list_sort(list_distinct(list_concat(coalesce(base_list, []), coalesce(near_list, [])))), ',') AS labels,
           CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0::DOUBLE) END AS score
    FROM line LEFT JOIN bases USING (r) LEFT JOIN near USING (r)
    """


@query(LICENSE_SQL)
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents")).drop("spans")


@query()
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query()
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.train(docs))


@query()
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    deduplicated = lines.line_dedup(table(spark, sf_dir, "documents"), with_passages=True)
    return deduplicated.select("doc_id", "text", "removed_chunks", "removed_chars")


@query()
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


@query()
def op7_packed_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written as matrices, and every piece read back from them."""
    return packed_output.packed_pieces(packed_output.write_packed(table(spark, sf_dir, "documents")))


@query(
    """
    WITH page AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
    hashed AS (SELECT page_id, octet_length(encode(payload)) AS size, sha1(payload) AS hex,
                      min(page_id) OVER (PARTITION BY payload) AS first FROM page),
    -- base 32: five hexadecimal digits are four digits of five bits
    quarter AS (SELECT *, list_transform(range(0, 8), lambda g: ('0x' || substr(hex, g::INT * 5 + 1, 5))::BIGINT) AS parts
                FROM hashed)
    SELECT page_id, size::BIGINT AS payload_bytes,
           array_to_string(list_transform(range(0, 32), lambda d: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
             ((parts[d // 4 + 1] >> (15 - 5 * (d % 4))) & 31)::INT + 1, 1)), '') AS payload_digest,
           CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
    FROM quarter
    """
)
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write_archives(table(spark, sf_dir, "pages"))
    records = warc.read_records(index, payloads=False)
    damaged = F.raise_error(F.format_string("damaged record of page %d", "page_id")).cast("boolean")
    records = records.where(F.when(F.col("intact"), True).otherwise(damaged))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query(
    """
    WITH v AS (
      SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    ),
    scored AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
               FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """
)
def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), is_query=F.col("vec_id") % 50 == 0)


@query()
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query(
    """
    WITH v AS (
      SELECT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END) AS label,
             list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
      WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    ),
    scored AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_dot_product(a.e, c.e)::BIGINT AS score
               FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id),
    positive AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
                 QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT anchor_id, positive_id,
           row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
           vec_id AS negative_id, positive_score, score AS negative_score
    FROM positive JOIN scored USING (anchor_id)
    WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
    QUALIFY rank <= 5
    """
)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A seventh of the labels is changed first, as the contract says."""
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, noisy)


@query()
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return alignment.alignments(table(spark, sf_dir, "documents"), derive={"groups_sha256": digest})


@query()
def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.sha2(joined(F.filter("spans", lambda s: s["base"])), 256)
    return found.select("doc_id", *[f"n_{kind}" for kind in pii.KINDS], base.alias("base_sha256"), joined("spans").alias("spans"))


@query()
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
