"""Each operator as a query over the given tables, with its production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mixlens.llm import (
    chat,
    contamination,
    lines,
    merkle,
    mixing,
    near_dup,
    quality,
    sharding,
    substrings,
    token_files,
    topk,
    toxicity,
    vectors,
    whitening,
)
from mixlens.llm.common import read, written
from mixlens.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to 150 % of their words, sources weighing 5, 2, 1 by turns."""
    rows, _ = mixing.mix(read(spark, sf_dir, "documents"), (5, 2, 1), {"taken": 1.5}, 2.0)
    return rows.select(
        "doc_id", "size", "source_size", F.col("taken_target").alias("target"), (F.col("size") * F.col("taken_times")).alias("taken")
    )


@query
def op2_format_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one that says control strings, formatted and read back."""
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit("</s>[INST] ok [/INST]")
    roles = F.element_at(F.array(F.lit("user"), F.lit("assistant")), (F.col("id") + 1).cast("int"))
    own = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), roles.alias("role"), said.alias("text"))
    return chat.digests(chat.format_conversations(turns.unionByName(own)))


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, votes and verdict of all documents."""
    return quality.assess(read(spark, sf_dir, "documents"))


@query
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the passages of 13 words that start in a document of smaller id."""
    rows = substrings.remove_repeats(read(spark, sf_dir, "documents"))
    removed = F.aggregate("repeats", F.lit(0), lambda n, r: n + r["end"] - r["first"])
    return rows.select(
        "doc_id", "n_words", removed.cast("long").alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256")
    )


@query
def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the class of near copies that each belongs to."""
    return near_dup.classes(read(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_copies")


@query
def op6_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token ids in byte planes, read back."""
    import public_tokenizers

    path = scratch_path(spark, "tokens")
    docs = read(spark, sf_dir, "documents")
    token_files.write_tokens(docs, path, public_tokenizers.path("word_bpe_49k.json"), end_id=2, by_word=True)
    return token_files.read_tokens(spark, path)


@query
def op7_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of 8 racks and 4 regions, and where one more shard would put them."""
    tree = sharding.balanced_tree(16)
    docs = sharding.thin(read(spark, sf_dir, "documents"))
    placed = sharding.assign(sharding.assign(docs, tree), sharding.grown(tree), "grown_shard")
    rows = sharding.with_slots(written(placed.withColumn("law", F.lit("key")), "shards"))
    return rows.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


@query
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with each benchmark item of which it holds 80 % of the five-word shingles."""
    docs, items = read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    return contamination.search(docs, items).select("doc_id", "item_id", "shared", "size")


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of all documents, learned from labelled ones that are not held out."""
    docs = read(spark, sf_dir, "documents")
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"),
    )


@query
def op10_near_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without lines that equal an earlier one up to two edits, or short ones that equal it."""
    rows = lines.remove_near_lines(read(spark, sf_dir, "documents"), short_equal=True)
    ids = F.array_join(F.col("first_ids").cast("array<string>"), ",").alias("first_ids")
    return rows.select("doc_id", "n_lines", "n_removed", ids, F.sha2("kept", 256).alias("kept_sha256"))


@query
def op11_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 greatest inner products of every twentieth embedding with all others."""
    rows = vectors.on_grid(read(spark, sf_dir, "embeddings"), 64)
    return topk.top_k(rows, F.col("vec_id") % 20 == 0, 20)


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their proofs in a manifest by language, a seventh of them tampered with before they are verified."""
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    docs = read(spark, sf_dir, "documents").select(*columns)
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).alias("n_chars")
    tampered = merkle.leaf_digest(*[more if c == "n_chars" else F.col(c) for c in columns])
    chosen = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    claimed = docs.withColumn("tampered", F.when(chosen & F.col("n_chars").isNotNull(), tampered))
    leaf = merkle.leaf_digest(*[F.col(c) for c in columns])
    made = merkle.proofs(merkle.manifest(claimed, "lang", ["doc_id"], leaf, ["doc_id", "tampered"]))
    root = merkle.folded(F.coalesce("row.tampered", "leaf"), F.col("path"))
    found = made.select(
        "row.doc_id", "leaf", "subroot", "root", merkle.path_digest(F.col("path")).alias("proof_sha256"), root.alias("folded_root")
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


@query
def op13_whiten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings on the four leading components of their covariance, whitened."""
    rows = read(spark, sf_dir, "embeddings")
    whitened = whitening.whiten(rows, whitening.fit(rows))
    return whitened.withColumn("deviation", F.expr("try_cast(deviation as bigint)"))
