"""The registered queries over the operators, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitmap.llm import bwt_dedup, chat_windows, fill_middle, graph_ann, hard_negatives, jaccard_join, mixing, pii_crf, quality_classifier, quality_rules, rlz_dedup, toxic_spans
from visitmap.llm.bwt_dedup import dedup_by_merged_transforms
from visitmap.llm.chunk_bpe import encode_corpus
from visitmap.llm.jaccard_join import JaccardJoin
from visitmap.llm.rlz_dedup import dedup_by_parsing


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_bpe() -> str:
    """The public tokenizer's file, where the package that has it is installed."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.Mix(spark, table(spark, sf_dir, "documents"))
    return mix.taken().select("doc_id", "size", "source_size", "target", "taken")


def op2_rlz_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_by_parsing(spark, table(spark, sf_dir, "documents"), length=35)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_pruned_graph_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return graph_ann.nearest(spark, vectors, vectors.where("vec_id % 100 = 0"))


def op4_chunk_reuse_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = encode_corpus(spark, table(spark, sf_dir, "documents"), word_bpe(), decode_to="decoded")
    return out.select("doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_bwt_merge_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_by_merged_transforms(spark, table(spark, sf_dir, "documents"), length=50)
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op6_semi_markov_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii_crf.find_personal_data(spark, table(spark, sf_dir, "documents"), carry=["doc_id"])
    base = F.filter("spans", lambda s: s["base"])
    count = lambda k: F.size(F.filter(base, lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return out.select("doc_id", *[count(k) for k in pii_crf.KINDS], F.sha2(pii_crf.span_text(base), 256).alias("base_sha256"),
                      pii_crf.span_text(F.col("spans")).alias("spans"))


def op7_random_indexing_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_token_combination_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = JaccardJoin(spark, table(spark, sf_dir, "documents")).members()
    return members.select(F.col("key").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id")


def op9_budgeted_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", control), (-1, 1, "assistant", control)], turns.schema)
    return chat_windows.read_back(spark, chat_windows.format_conversations(spark, turns.unionByName(own)))


def op10_adaptive_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.judge_documents(spark, table(spark, sf_dir, "documents"), keep_columns=["doc_id"])
    return out.select("doc_id", *[F.col("counts")[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")], "base_failed", "kept")


def op11_chain_field_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxic_spans.ToxicSpans(spark, docs, labels, learn=~toxic_spans.held_out(F.col("key")))
    return model.score(docs).select("doc_id", toxic_spans.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op12_spanning_tree_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.HardNegatives(spark, table(spark, sf_dir, "embeddings").withColumn("label", label)).negatives()


def op13_displacement_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_middle.restore(fill_middle.fill_in_middle(table(spark, sf_dir, "documents")))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_source_mixing, op2_rlz_substring_dedup, op3_pruned_graph_neighbours, op4_chunk_reuse_bpe, op5_bwt_merge_dedup, op6_semi_markov_pii,
    op7_random_indexing_quality, op8_token_combination_jaccard, op9_budgeted_chat_windows, op10_adaptive_quality_rules, op11_chain_field_toxicity, op12_spanning_tree_hard_negatives,
    op13_displacement_fill_middle)}

ORACLES: dict[str, str] = {
    "op1_source_mixing": mixing.ORACLE, "op2_rlz_substring_dedup": rlz_dedup.ORACLE, "op5_bwt_merge_dedup": bwt_dedup.ORACLE,
    "op8_token_combination_jaccard": jaccard_join.ORACLE, "op12_spanning_tree_hard_negatives": hard_negatives.ORACLE,
    "op13_displacement_fill_middle": fill_middle.ORACLE}
