"""The registered queries of the text operators; each derives its columns from its operator's output."""

from __future__ import annotations

import uuid

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from savora.llm import (
    alignment,
    bpe,
    decontaminate,
    exact_dedup,
    factorization,
    licenses,
    minhash,
    records,
    repeats,
    runs,
    simhash,
    surrogates,
)
from savora.llm.text import prepare
from savora.session import shared_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _remainder(by: int):
    return F.crc32(F.col("doc_id").cast("string")) % by


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents; labels of remainder 1 of 3 are held out."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    machine = factorization.fit_quality(docs, labels.where(_remainder(3) != 1))
    return _scored(docs, machine, _remainder(3) == 1)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents; labels of remainder 0 of 5 are held out."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    machine = factorization.fit_toxicity(docs, labels.where(_remainder(5) != 0))
    return _scored(docs, machine, _remainder(5) == 0)


def _scored(docs: DataFrame, machine: factorization.Machine, held_out) -> DataFrame:
    return factorization.with_score(docs.select("doc_id", "text", "n_chars"), machine).select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of documents inside ten-word windows of benchmark items."""
    found = decontaminate.overlaps(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), window=10)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op4_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with personal data replaced."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    return surrogates.with_surrogates(docs, b"a key for the check only")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents equal but for white space."""
    groups = exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without strings of 400 bytes that start anywhere else, too."""
    left = repeats.without_repeats(_table(spark, sf_dir, "documents"), length=400)
    return left.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op7_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as token records and read back."""
    path = f"{shared_dir(prepare(spark))}/records-{uuid.uuid4().hex}"
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    records.write_records(_table(spark, sf_dir, "documents"), f"{path}/data", tokenizer, end_id=1)
    records.write_index(spark, f"{path}/data", f"{path}/index")
    index = spark.read.parquet(f"{path}/index").select("doc_id", "shard", "offset", "start")
    read = records.read_records(spark, f"{path}/data").select(
        "shard", "offset", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )
    return index.join(read, ["shard", "offset"]).select("doc_id", "start", "n_tokens", "ids_crc32")


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in all documents."""
    return licenses.license_notices(_table(spark, sf_dir, "documents"))


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents with 85 % of their three-word shingles in common."""
    return minhash.near_groups(_table(spark, sf_dir, "documents"), minhash.Near(words=3, percent=85))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded."""
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    coded = bpe.round_trip(_table(spark, sf_dir, "documents"), vocabulary)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose fingerprints differ in two bits or fewer."""
    groups = simhash.close_groups(_table(spark, sf_dir, "documents"), words=3, blocks=simhash.Blocks(distance=2))
    return groups.select("doc_id", "fingerprint", "component_id")


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of all documents, one document in ten made periodic from some word on."""
    docs = _table(spark, sf_dir, "documents")
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    n = F.size(words)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    again = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    periodic = F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(again, F.lit(1), n - a)), " ")
    text = F.when((h % 10 == 0) & (n > 0), periodic).otherwise(F.col("text"))
    found = runs.word_runs(docs.select("doc_id", text.alias("text")), least=12)
    first = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start.cast("string"), r.length.cast("string"), r.period.cast("string")), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-first["start"]).alias("start"),
        first["length"].alias("length"),
        (-first["period"]).alias("period"),
        F.floor(1000 * first["length"] / (-first["period"])).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded by two tokenizers and aligned, with corpus-wide counts of linked ids."""
    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return alignment.link_statistics(_table(spark, sf_dir, "documents"), *paths)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of the corpus pipeline, one after the other."""
    return corpus_pipeline.run(prepare(spark), sf_dir)


QUERIES = {
    "op1_quality": op1_quality,
    "op2_toxicity": op2_toxicity,
    "op3_decontaminate": op3_decontaminate,
    "op4_surrogates": op4_surrogates,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_repeats": op6_repeats,
    "op7_records": op7_records,
    "op8_licenses": op8_licenses,
    "op9_minhash": op9_minhash,
    "op10_bpe": op10_bpe,
    "op11_simhash": op11_simhash,
    "op12_runs": op12_runs,
    "op13_alignment": op13_alignment,
    "pipeline": pipeline,
}
