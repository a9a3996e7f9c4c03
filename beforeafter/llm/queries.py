"""One registered query per operator, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beforeafter.llm import (
    bpe, html_text, licenses, lm_scoring, mixing, prefix_trie, quality_classifier, quality_rules, sharding, simhash, spelling,
    text, url_rules, vector_dedup,
)
from beforeafter.staging import broadcast_if_small, stage

#: Fixed values of the URL contract: rule and verdict.
URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
N_SHARDS = 8
VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
GOOD_SCORE = 0.7
#: Fixed value of the conversation contract: ids from one multiple to the next.
FAMILY = 20
#: Fixed values of the spelling contract.
LEAST_LETTERS, LEAST_COUNT, SLIP_EVERY = 6, 5, 199


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all page URLs."""
    rows = ", ".join(f"('{rule}', '{verdict}')" for rule, verdict in URL_RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {rows} AS rules(rule, verdict)")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_rules.judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-entropy difference of every document: documents labelled good, those held
    out for tests aside, against all documents."""
    key = F.col("doc_id")
    good = table(spark, sf_dir, "labels").filter((F.col("quality") == 1) & ~quality_classifier.held_out(key))
    good = good.select(key.alias("_good")).distinct()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = docs.join(broadcast_if_small(good), key == F.col("_good"), "left").select(
        "doc_id", "text", F.col("_good").isNotNull().alias("is_target")
    )
    return lm_scoring.score_by_counts(marked, "is_target", carry=["doc_id"])


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed by words: weights 5, 2, 1, at most two epochs."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"), text.word_count(F.col("text")), carry=["doc_id", "source"])
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "copies"
    )


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures, base rules and the voted verdict of every document."""
    judged = quality_rules.judge_quality(table(spark, sf_dir, "documents"), carry=["doc_id"])
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("doc_id", *base, "base_failed", "kept", "posterior")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of the bytes they decode to."""
    texts = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.round_trip(texts, VOCABULARY, public_tokenizers.PATTERN)
    return coded.select("doc_id", *token_digests())


def token_digests() -> list[Column]:
    return [
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    ]


def op7_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all vectors: equal labels, cosine 0.93 or more."""
    return vector_dedup.classes_of(table(spark, sf_dir, "embeddings"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents: 3-word shingles, 3 bits."""
    return simhash.classes(table(spark, sf_dir, "documents"))


def scored(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    voters = quality_classifier.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality_classifier.add_score(docs, voters)


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by its nearest labelled ones."""
    docs = scored(spark, table(spark, sf_dir, "documents").select("doc_id", "text"), sf_dir)
    held = quality_classifier.held_out(F.col("doc_id")).alias("held_out")
    return docs.select("doc_id", held, "score").withColumn("predicted", (F.col("score") >= GOOD_SCORE).cast("int"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents dealt to eight shards of equal row counts."""
    content = F.coalesce("text", F.lit(""))
    sized = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(content) + 1).cast("long").alias("size"),
        F.crc32(content).alias("text_crc32"),
    )
    order = [F.col(c).asc_nulls_first() for c in ("doc_id", "text_crc32", "size")]
    dealt = sharding.shards(stage(sized, "shard-rows"), N_SHARDS, order)
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "row_no",
    )


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix trie of all conversations, each with its family's first turns."""
    conv = F.col("conv_id")
    head = F.crc32(conv.cast("string")) % 4
    turns, convs = prefix_trie.grafted(
        prefix_trie.coded_turns(table(spark, sf_dir, "conversations")), conv - conv % FAMILY, head, most=3
    )
    return prefix_trie.nodes(stage(turns, "trie-grafted"), convs)


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices of every document."""
    scanned = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return scanned.withColumn("score", F.round("score", 6))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all documents, with the contract's slips."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.explode(spelling.runs(F.col("text"), LEAST_LETTERS)).alias("run"))
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")))
    at = (F.col("h") % F.length("run")).cast("int")
    slipped = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = docs.withColumn("h", h).select(F.when(F.col("h") % SLIP_EVERY == 0, slipped).otherwise(F.col("run")).alias("word"))
    return spelling.forms(spelling.word_counts(words, LEAST_LETTERS, LEAST_COUNT))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": op1_url_filter,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_html": op3_html,
    "op4_mixing": op4_mixing,
    "op5_quality_rules": op5_quality_rules,
    "op6_bpe": op6_bpe,
    "op7_vector_dedup": op7_vector_dedup,
    "op8_simhash": op8_simhash,
    "op9_sharding": op9_sharding,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_license_scan": op12_license_scan,
    "op13_spelling": op13_spelling,
}
