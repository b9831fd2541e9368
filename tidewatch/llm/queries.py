"""Queries of the operators of this subpackage over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewatch.llm import ann_tree, centroid_clusters, decontaminate, jaccard_join, language_id, lexical_search, license_scan, line_dedup, maxent_lm, mixing, substring_dedup, suffix_dedup, url_filter
from tidewatch.llm.frames import table
from tidewatch.llm.sql import centroid_clusters_sql, lexical_search_sql, line_dedup_sql, mixing_sql, url_filter_sql

#: rules of op6: host, path, verdict
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
             ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
#: op7: every token of the corpus handed out by these weights, in at most three epochs
MIX = {"share": (1, 1), "max_epochs": 3, "seed": 7,
       "weights": {"domain": {"d0": 4, "d1": 3, "d2": 2, "d3": 1}, "language": {"en": 4, "de": 2, "fr": 2, "es": 1},
                   "origin": {"src0": 2}}}


def _digest(out: DataFrame) -> DataFrame:
    """Word counts, and the hash of the kept words joined by one space."""
    words = F.regexp_replace(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+", " ")
    return out.select("doc_id", "n_words", "n_removed",
                      F.sha2(F.btrim(words, F.lit(" ")), 256).alias("kept_sha256"), "spans")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return _digest(suffix_dedup.remove_repeats(docs))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = license_scan.scan(docs, license_scan.train(docs))
    return found.select("doc_id", F.size("licences").cast("long").alias("n_licences"),
                        F.array_sort(F.array_distinct("licences.family")).alias("families"), "licences")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontaminate.find_items(docs, table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", (F.size("matches") > 0).alias("contaminated"),
                      F.size("matches").cast("long").alias("n_items"),
                      F.col("matches.item_id").alias("item_ids"), "matches")


def op4_ann_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann_tree.search(vectors, vectors.where("vec_id % 20 = 0"), k=20)


def op5_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from nine tenths of the documents, scores all of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rest = F.crc32(F.col("doc_id").cast("string")) % 10
    held = docs.withColumn("held_out", F.coalesce(rest == 0, F.lit(False)))
    return maxent_lm.score(held, rest != 0).select("doc_id", "held_out", *maxent_lm.RESULT)


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES).drop("url")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return mixing.mix(docs, **MIX).select("doc_id", "domain", "lang", "source", "n_tokens", "epoch")


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_join.components(docs, k=3, num=90, den=100)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from three quarters of the documents, judges all of them."""
    docs = table(spark, sf_dir, "documents")
    rest = F.crc32(F.col("doc_id").cast("string")) % 4
    model = language_id.learn(docs.where(rest != 2).select("text", "lang"))
    found = language_id.identify(docs.select("doc_id", F.coalesce(rest == 2, F.lit(False)).alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", F.size("spans").alias("n_spans"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return _digest(substring_dedup.remove_repeats(docs))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lexical_search.search(docs, table(spark, sf_dir, "benchmark"), k=10)


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clusters.cluster(table(spark, sf_dir, "embeddings"), k=8, rounds=10)


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_dedup.drop_lines(docs, min_chars=40, min_docs=5)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


QUERIES = {f.__name__: f for f in (op1_suffix_dedup, op2_license_scan, op3_decontaminate, op4_ann_tree, op5_maxent_lm, op6_url_filter, op7_mixing, op8_jaccard_join, op9_language_id, op10_substring_dedup, op11_lexical_search, op12_centroid_clusters, op13_line_dedup)}

ORACLE: dict[str, str] = {
    "op6_url_filter": url_filter_sql(URL_RULES, url_filter.ORDER, url_filter.ALPHABET, url_filter.HELD_OUT),
    "op7_mixing": mixing_sql(**MIX),
    "op11_lexical_search": lexical_search_sql(k=10),
    "op12_centroid_clusters": centroid_clusters_sql(k=8, rounds=10),
    "op13_line_dedup": line_dedup_sql(min_chars=40, min_docs=5),
}
