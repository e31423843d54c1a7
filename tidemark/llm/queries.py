"""Registered queries of this subpackage, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    ball_tree,
    exact_dedup,
    importance,
    jaccard_join,
    language_id,
    license_scan,
    line_crf,
    packing,
    periodic_runs,
    pii,
    templates,
    tokens,
    toxicity,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language(spark, sf_dir):
    return language_id.identify(_table(spark, sf_dir, "documents"))


def op2_quality_resampling(spark, sf_dir):
    targets = _table(spark, sf_dir, "labels").where("quality = 1")
    return importance.resample(_table(spark, sf_dir, "documents"), targets)


def op3_pii(spark, sf_dir):
    return pii.digest(pii.detect(_table(spark, sf_dir, "documents")))


def op4_packing(spark, sf_dir):
    return packing.pack(_table(spark, sf_dir, "documents"))


def op5_licenses(spark, sf_dir):
    return license_scan.licences(_table(spark, sf_dir, "documents"))


def op6_decontamination(spark, sf_dir):
    return templates.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_exact_dedup(spark, sf_dir):
    found = exact_dedup.decide(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op8_jaccard_join(spark, sf_dir):
    return jaccard_join.groups(_table(spark, sf_dir, "documents"), n=3, percent=90)


def op9_toxicity(spark, sf_dir):
    return toxicity.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_token_counts(spark, sf_dir):
    return tokens.count_documents(_table(spark, sf_dir, "documents"))


def op11_quality_rules(spark, sf_dir):
    return line_crf.label_lines(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_ranked_search(spark, sf_dir):
    return ball_tree.rank(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_periodic_runs(spark, sf_dir):
    planted = periodic_runs.plant_runs(_table(spark, sf_dir, "documents"))
    return periodic_runs.digest(periodic_runs.detect(planted))


QUERIES = {
    query.__name__: query
    for query in (
        op1_language,
        op2_quality_resampling,
        op3_pii,
        op4_packing,
        op5_licenses,
        op6_decontamination,
        op7_exact_dedup,
        op8_jaccard_join,
        op9_toxicity,
        op10_token_counts,
        op11_quality_rules,
        op12_ranked_search,
        op13_periodic_runs,
    )
}

# The engines' own lower-casing covers more than A-Z, so the SQL spells the alphabet out.
_NORMAL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

ORACLES = {
    "op7_exact_dedup": f"""
        WITH d AS (SELECT doc_id, sha256({_NORMAL}) AS text_sha256 FROM documents)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, text_sha256
        FROM d WINDOW g AS (PARTITION BY text_sha256)""",
    "op12_ranked_search": f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_NORMAL}, '{_TERM}') AS terms FROM documents),
        s AS (SELECT count(*) AS docs, CAST(sum(len(terms)) AS BIGINT) AS total FROM d WHERE len(terms) > 0),
        i AS (SELECT item_id, unnest(regexp_extract_all({_NORMAL}, '{_TERM}')) AS term FROM benchmark),
        q AS (SELECT item_id, term, count(*) AS c FROM i GROUP BY ALL),
        t AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d)
              WHERE term IN (SELECT term FROM q) GROUP BY ALL),
        w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
              FROM t, s GROUP BY term),
        v AS (SELECT r, term, (1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * len(terms) * docs) // total)) AS x
              FROM t JOIN d USING (r), s),
        p AS (SELECT item_id, r, CAST(sum(c * w * x) AS BIGINT) AS score
              FROM q JOIN w USING (term) JOIN v USING (term) GROUP BY ALL HAVING score > 0)
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score
        FROM p JOIN d USING (r) QUALIFY rank <= 20""",
}
