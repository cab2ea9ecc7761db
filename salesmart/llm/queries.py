"""The corpus operators over their whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm import (
    chat,
    collocations,
    decontamination,
    fingerprints,
    lexical,
    line_dedup,
    mixing,
    near_dedup,
    passages,
    pitman_yor,
    secrets,
    sharding,
    toxicity,
)
from salesmart.llm.common import table, whole_text

#: In the weights of op9, no source is read more than so many times.
MIX = mixing.Target(repeats=2.0)


#: From this share of votes on, a candidate counts as a secret.
SECRET_SCORE = 0.5


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate of every document with its score; secrets themselves are not shown.

    The tables hold no labelled findings: two thirds of the documents are labelled by format.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    path = F.concat_ws("/", "lang", "source")
    found = secrets.candidates(docs, path)
    learned = found.filter(~toxicity.held_out(F.col("doc_id")))
    scanner = secrets.fit_scanner(docs, secrets.labelled_by_format(learned))
    return secrets.scan(found, scanner).select(
        "doc_id",
        "place",
        F.char_length("candidate").alias("n_chars"),
        F.sha2(F.encode("candidate", "UTF-8"), 256).alias("candidate_sha256"),
        "score",
        (F.col("score") >= SECRET_SCORE).alias("secret"),
    )


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item that a document holds, at the window most like it."""
    return decontamination.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    ).drop("distance")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Law `bytes`: eight contiguous shards by doc_id."""
    text = F.col("text")
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        sharding.text_size(text).alias("size"),
        F.crc32(F.encode(whole_text(), "UTF-8")).alias("text_crc32"),
    )
    return sharding.assign_shards(rows, F.col("size")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the formatted conversations say when they are read back."""
    said = "\\### Assistant: </turn> ok"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    done = chat.format_conversations(rows.unionByName(added))
    read = done.select(
        "conv_id",
        "valid",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss(F.col("segments")).alias("loss"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
    said = F.transform(
        "turns",
        lambda t: F.concat(F.coalesce(t["role"], F.lit("")), F.lit("\n"), t["text"], F.lit("\n")),
    )
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.encode(F.array_join(said, ""), "UTF-8"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.encode("loss", "UTF-8"), 256).alias("loss_sha256"),
        "formatted_chars",
        "valid",
    )


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_next(table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of words that several documents have, and which of them go."""
    return passages.repeated_spans(table(spark, sf_dir, "documents")).drop("row")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What line dedup leaves of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.drop_repeated_lines(docs).select(
        "doc_id",
        "n_lines",
        "n_removed",
        F.char_length(whole_text()).alias("clean_chars"),
        F.md5(F.encode(whole_text(), "UTF-8")).alias("clean_md5"),
    )


def op9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reading of every document, with its place in the mix."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mixing.mix_sources(docs, MIX)
    return mixed.select(
        "doc_id",
        "source",
        F.col("mix_tokens").alias("tokens"),
        "mix_pass",
        "mix_order",
        "mix_weight",
    )


#: From this score on, a text counts as toxic.
TOXIC_SCORE = 0.7


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score for every document; the third that is held out teaches nothing."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(~toxicity.held_out(F.col("doc_id")))
    model = toxicity.fit_toxicity(docs, labels)
    return toxicity.score_toxicity(docs, model).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= TOXIC_SCORE).cast("int").alias("predicted"),
    )


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of each language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log10 probability of every text; a seventh of the documents teaches nothing."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    return pitman_yor.score_texts(docs, held_out, stored=True)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secrets": op1_secrets,
    "op2_decontamination": op2_decontamination,
    "op3_sharding": op3_sharding,
    "op4_near_dedup": op4_near_dedup,
    "op5_chat_format": op5_chat_format,
    "op6_fingerprints": op6_fingerprints,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_line_dedup": op8_line_dedup,
    "op9_mix": op9_mix,
    "op10_toxicity": op10_toxicity,
    "op11_lexical_search": op11_lexical_search,
    "op12_collocations": op12_collocations,
    "op13_pitman_yor": op13_pitman_yor,
}
