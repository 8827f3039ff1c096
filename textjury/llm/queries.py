"""One query per corpus operator, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textjury.llm import (
    decontamination,
    filter_audit,
    html_text,
    language_id,
    licenses,
    line_dedup,
    mixing,
    neighbours,
    personal_data,
    prefix_trie,
    simhash,
    token_counts,
    toxicity,
)
from textjury.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


@query
def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights 5, 2, 1 by source rank, 150 % of all words, at most two passes over a source.

    The rows come range-sorted by the training position of the document's first read.
    """
    mixed = mixing.training_order(mixing.mix(table(spark, sf_dir, "documents")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


SQL["op6_source_mixing"] = mixing.MIX_SQL


@query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of at least ten code points stay in the smallest document that holds them."""
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


SQL["op5_line_dedup"] = line_dedup.DEDUP_SQL


@query
def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """3-word shingles, links at two or fewer differing bits."""
    grouped = simhash.simhash_components(table(spark, sf_dir, "documents"))
    return grouped.select("doc_id", simhash.hex_fingerprint("fp").alias("fingerprint"), "component_id")


@query
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of ten words, exact phrases."""
    found = decontamination.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weak supervision from the labels outside the held-out third."""
    scored = toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id",
        (~toxicity.learnable()).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


@query
def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page at its host's consensus path."""
    found = html_text.main_text(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


@query
def op3_token_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact lengths of all whole texts in tokens, with suffix sums for every context limit."""
    return token_counts.token_histogram(table(spark, sf_dir, "documents"))


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned from the rows outside the held-out fifth."""
    docs = table(spark, sf_dir, "documents")
    found = language_id.predict(docs, language_id.fit(docs))
    return found.select("doc_id", (~language_id.learnable()).alias("held_out"), "lang_pred", "score")


@query
def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every row whose id is divisible by 20."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    joined = {name: F.array_join(name, ",") for name in ("sentence_ids", "licenses")}
    return found.withColumns(joined)


SQL["op10_license_scan"] = licenses.licenses_sql()


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of rebuilt conversations."""
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


SQL["op11_prefix_trie"] = prefix_trie.TRIE_SQL


@query
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters in all 120 orders, per source."""
    return filter_audit.filter_interactions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


SQL["op12_filter_audit"] = filter_audit.AUDIT_SQL


@query
def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E-mail and network addresses, card and phone numbers, and the added kinds."""
    return personal_data.digest(personal_data.personal_data(table(spark, sf_dir, "documents")))


SQL["op13_personal_data"] = personal_data.personal_data_sql()
