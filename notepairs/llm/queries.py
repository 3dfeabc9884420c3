"""Queries of the corpus operators over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from notepairs.llm import (
    bpe, class_lm, divergence, exact, interaction, langid, mincut_html, mixing, oracles, ownership, pivots, preference, quality, simhash,
)


def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_mincut_html(spark, sf_dir):
    return mincut_html.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op2_simhash_near_dedup(spark, sf_dir):
    return simhash.near_groups(documents(spark, sf_dir)).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def op3_preference_format(spark, sf_dir):
    # The table has no preferences: the rejected side ends in a neighbour's reply.
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    pairs = preference.neighbour_pairs(turns)
    return pairs.select(
        "pair_id", "prefix_turns", "prompt", preference.completion(F.col("chosen")).alias("chosen"), preference.mask(F.col("chosen")).alias("chosen_mask"),
        preference.completion(F.col("rejected")).alias("rejected"), preference.mask(F.col("rejected")).alias("rejected_mask"), "usable",
    )


def _held_out(docs, folds):
    return F.pmod(F.crc32(docs["doc_id"].cast("string").cast("binary")), F.lit(folds)) == 1


def op4_class_bigrams(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return class_lm.score_texts(docs, held_out=_held_out(docs, 5)).drop("row_key")


def op5_compression_language(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return langid.predict(docs, held_out=_held_out(docs, 3))


def op6_secret_ownership(spark, sf_dir):
    # The table names no repositories: a source is an owner, a hundred neighbouring documents of one language a repository of it.
    docs = documents(spark, sf_dir)
    repository = F.concat_ws("/", "source", "lang", F.expr("doc_id div 100").cast("string"))
    return ownership.scan(docs, repository=repository, owner=docs["source"])


def op7_mixing(spark, sf_dir):
    plan = mixing.mixture(documents(spark, sf_dir)).orderBy("position", "doc_id")
    return plan.select("doc_id", "size", "source_size", "target", "taken", "position")


def bpe_digests(docs):
    """Token counts and digests of the ids and of the decoded bytes of every document."""
    return bpe.encode(docs, decoded=True).select(
        "doc_id", bpe.n_ids(F.col("ids")).alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op8_byte_bpe(spark, sf_dir):
    return bpe_digests(documents(spark, sf_dir))


def op9_exact_dedup(spark, sf_dir):
    return exact.exact_groups(documents(spark, sf_dir)).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op10_quality_rules(spark, sf_dir):
    return quality.line_quality(documents(spark, sf_dir)).drop("surviving_words", "cleaned")


def op11_filter_interactions(spark, sf_dir):
    return interaction.audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op12_source_divergence(spark, sf_dir):
    return divergence.divergence(documents(spark, sf_dir))


def op13_pivot_search(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return pivots.search(vectors, queries=vectors["vec_id"] % 20 == 0)


QUERIES = {
    "op1_mincut_html": op1_mincut_html,
    "op2_simhash_near_dedup": op2_simhash_near_dedup,
    "op3_preference_format": op3_preference_format,
    "op4_class_bigrams": op4_class_bigrams,
    "op5_compression_language": op5_compression_language,
    "op6_secret_ownership": op6_secret_ownership,
    "op7_mixing": op7_mixing,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_quality_rules": op10_quality_rules,
    "op11_filter_interactions": op11_filter_interactions,
    "op12_source_divergence": op12_source_divergence,
    "op13_pivot_search": op13_pivot_search,
}

SQL = {
    "op3_preference_format": oracles.PREFERENCE,
    "op6_secret_ownership": oracles.SECRETS,
    "op7_mixing": oracles.MIXING,
    "op9_exact_dedup": oracles.EXACT_DEDUP,
    "op10_quality_rules": oracles.QUALITY_RULES,
    "op11_filter_interactions": oracles.INTERACTIONS,
    "op12_source_divergence": oracles.DIVERGENCE,
    "op13_pivot_search": oracles.SEARCH,
}
