"""The registered queries of this package, with production parameters, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tapeglass.llm import (
    bm25_packing, chat, digest, huffman, kd_search, line_templates, merkle_log, neighbour_quality, sharding, simhash, tiling,
    turn_repair, url_templates,
)
from tapeglass.llm.common import table
from tapeglass.session import scratch_folder

SHARDS = 8
SHINGLE, DISTANCE = 4, 4
LEAF_COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
QUERY_EVERY, NEAREST = 20, 20
CONTROL = "\\### Assistant: </turn> ok"
RULES = [
    url_templates.Rule("org", "/", "allow"),
    url_templates.Rule("example.org", "/es/", "block"),
    url_templates.Rule("example.org", "/en/1", "block"),
    url_templates.Rule("com", "/fr/", "allow"),
    url_templates.Rule("com", "/de/", "block"),
]


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op8_tokenizer() -> tuple[str, str, int]:
    return _tokenizer("byte_bpe_50k.json"), "kept", 0


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), sharding.uniform_tree(SHARDS))


def op2_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = table(spark, sf_dir, "documents"), scratch_folder(spark, "huffman")
    back = huffman.huffman_round_trip(docs, path, _tokenizer("word_bpe_49k.json"), "dropped", 2)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest.edited_fingerprints(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), SHINGLE, DISTANCE)


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["conv_id", "turn", "role", "text"]
    extra = spark.createDataFrame(
        [(-7, 0, "user", CONTROL), (-7, 1, "assistant", CONTROL)], "conv_id long, turn long, role string, text string"
    )
    return chat.read_back(chat.format_turns(table(spark, sf_dir, "conversations").select(columns).union(extra)))


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_templates.judge_urls(table(spark, sf_dir, "pages"), RULES)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bm25_packing.pack(table(spark, sf_dir, "documents"), *op8_tokenizer())


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    voters = neighbour_quality.fit(docs, table(spark, sf_dir, "labels"))
    scores = neighbour_quality.quality_scores(docs, voters)
    predicted = (F.col("score") >= neighbour_quality.ACCEPT_FROM).cast("int")
    return scores.select("doc_id", neighbour_quality.held_out().alias("held_out"), "score", predicted.alias("predicted"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_templates.without_recurring_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "text", "dropped_lines")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lowered = F.translate("text", url_templates.UPPER, url_templates.LOWER)
    tampered = merkle_log.leaf_digest(*(lowered if c == "text" else F.col(c) for c in LEAF_COLUMNS))
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    found = merkle_log.manifest(docs, LEAF_COLUMNS, carried={"tampered": F.when(hit, tampered)})
    folded = merkle_log.folded(F.coalesce("tampered", "leaf"), F.col("left"), F.col("right"))
    proof = merkle_log.proof_digest(F.col("left"), F.col("right"))
    made = found.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), folded.alias("folded_root"))
    return made.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return turn_repair.repair_plans(turn_repair.damaged(turns), turns)


def op13_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    asks = F.col("vec_id") % QUERY_EVERY == 0
    found = kd_search.top_products(table(spark, sf_dir, "embeddings"), asks, NEAREST)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def queries() -> dict:
    own = [
        op1_sharding, op2_token_ids, op3_fingerprints, op4_decontamination, op5_simhash, op6_chat, op7_urls,
        op8_packing, op9_quality, op10_line_dedup, op11_merkle, op12_turn_repair, op13_nearest,
    ]
    return {query.__name__: query for query in own}
