"""Full-text index, BM25 retrieval and the weighted sum of ranking signals.

The weights, BM25 constants and normalisation are this package's choice; the source of the feature
names the signals and modes only.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from savora.functions.columns import tokens
from savora.operators.nearest import rank_per
from savora.plans.skew import bounded_broadcast, fits_broadcast, spread
from savora.session import stage

K1 = 1.2
B = 0.75
INDEX_BUCKETS = 1024
# Scores of one task, and most tasks.
SCORES_PER_TASK = 2_000_000
MAX_PARTITIONS = 20_000

# Weight of each signal, and the signals each mode uses.
WEIGHTS = {"lexical": 0.4, "semantic": 0.3, "quality": 0.2, "tag": 0.1, "affinity": 0.2}
MODES = {
    "lexical": {"lexical": 1.0},
    "semantic": {"semantic": 1.0},
    "quality": {"lexical": 0.5, "quality": 0.5},
    "hybrid": WEIGHTS,
    "ablation_no_sem": {s: w for s, w in WEIGHTS.items() if s != "semantic"},
}


def terms(column: Column) -> Column:
    return tokens(F.lower(column))


def postings(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", only: DataFrame | None = None
) -> DataFrame:
    """``(term, doc_id, tf, dl)`` rows of the whole texts, from one pass.

    Every document also gives one row with a null term, which carries its length even if no term of
    it is kept. With ``only(term)`` other terms are dropped before the shuffle.
    """
    given = spread(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text")))
    parsed = given.select("doc_id", terms(F.col("_text")).alias("_terms"))
    counted = parsed.where(F.size("_terms") > 0).select(
        "doc_id",
        F.size("_terms").cast("bigint").alias("dl"),
        F.explode(F.array_append("_terms", F.lit(None).cast("string"))).alias("term"),
    )
    if only is not None:
        wanted = only.select(F.col("term").alias("_wanted")).unionByName(
            docs.sparkSession.range(1).select(F.lit(None).cast("string").alias("_wanted"))
        )
        counted = counted.join(
            bounded_broadcast(wanted), counted["term"].eqNullSafe(F.col("_wanted")), "left_semi"
        )
    return (
        counted.groupBy("term", "doc_id", "dl")
        .agg(F.count("*").alias("tf"))
        .select("term", "doc_id", "tf", "dl")
    )


def document_lengths(index: DataFrame) -> DataFrame:
    return index.where(F.col("term").isNull()).select("doc_id", "dl")


def corpus_stats(index: DataFrame) -> DataFrame:
    """One row: number of documents with text, and their mean length."""
    return document_lengths(index).agg(F.count("*").alias("n_docs"), F.avg("dl").alias("avgdl"))


def document_frequencies(index: DataFrame) -> DataFrame:
    return index.where(F.col("term").isNotNull()).groupBy("term").agg(F.count("*").alias("df"))


@dataclass(frozen=True)
class Index:
    """Postings, ``term, df``, and one row ``n_docs, avgdl``."""

    postings: DataFrame
    frequencies: DataFrame
    stats: DataFrame


def write_index(index: DataFrame, path: str, buckets: int = INDEX_BUCKETS) -> None:
    """Store postings and frequencies by term bucket and sorted by term, document lengths, and corpus statistics.

    ``index`` comes from :func:`postings` and is read four times, so it should be stored or staged. The number
    of buckets is stored with the statistics. Rows are dealt out by ranges of bucket, term and document, so a
    frequent term has as many writers as its rows need.
    """
    bucket = F.pmod(F.hash("term"), F.lit(buckets)).alias("bucket")
    parts = {
        "postings": (index.where(F.col("term").isNotNull()), ["bucket", "term", "doc_id"]),
        "frequencies": (document_frequencies(index), ["bucket", "term"]),
    }
    for name, (rows, order) in parts.items():
        dealt = rows.select("*", bucket).repartitionByRange(*order).sortWithinPartitions(*order)
        dealt.write.partitionBy("bucket").mode("overwrite").parquet(f"{path}/{name}")
    document_lengths(index).write.mode("overwrite").parquet(f"{path}/lengths")
    stats = corpus_stats(index).withColumn("buckets", F.lit(buckets))
    stats.write.mode("overwrite").parquet(f"{path}/stats")


def read_index(spark: SparkSession, path: str, only: DataFrame | None = None) -> Index:
    """Read a stored index; with ``only(term)`` just the buckets that can hold these terms."""
    stats = spark.read.parquet(f"{path}/stats")
    kind = spark.read.parquet(f"{path}/lengths").schema["doc_id"].dataType.simpleString()
    postings = spark.read.schema(f"term string, doc_id {kind}, tf bigint, dl bigint, bucket int").parquet(f"{path}/postings")
    frequencies = spark.read.schema("term string, df bigint, bucket int").parquet(f"{path}/frequencies")
    if only is not None:
        buckets = stats.first()["buckets"]
        wanted = only.select(F.pmod(F.hash("term"), F.lit(buckets)).alias("b")).distinct()
        # At most ``buckets`` numbers.
        held = F.col("bucket").isin([row.b for row in wanted.collect()])
        postings, frequencies = postings.where(held), frequencies.where(held)
    return Index(postings.drop("bucket"), frequencies.drop("bucket"), stats.drop("buckets"))


def query_terms(queries: DataFrame, query_id: str = "query_id", text: str = "text") -> DataFrame:
    """Distinct lower-cased terms of each query."""
    return queries.select(
        F.col(query_id).alias("query_id"),
        F.explode(F.array_distinct(terms(F.col(text)))).alias("term"),
    )


def bm25_scores(index: DataFrame | Index, wanted: DataFrame, k1: float = K1, b: float = B) -> DataFrame:
    """``(query_id, doc_id, lexical)`` for every document that shares a term with the query.

    ``index`` must hold the postings of the ``wanted(query_id, term)`` terms and, if it is not a stored
    one, all null-term rows. Postings are dealt out by document if the terms' weights fit a broadcast, so a document's
    scores are summed where its postings are, and a ranking can drop most of them before it shuffles.
    """
    if not isinstance(index, Index):
        index = Index(index, document_frequencies(index), corpus_stats(index))
    n_docs = index.stats.select("n_docs").scalar().cast("double")
    avgdl = index.stats.select("avgdl").scalar()
    wanted_terms = wanted.select("term").distinct()
    df = index.frequencies.join(wanted_terms, "term", "left_semi")
    idf = F.log(F.lit(1.0) + (n_docs - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighted = wanted.join(df, "term").select("query_id", "term", idf.alias("idf"))
    norm = F.lit(k1) * (F.lit(1.0 - b) + F.lit(b) * F.col("dl") / avgdl)
    found = index.postings
    if fits_broadcast(weighted):
        scores = (index.stats.first()["n_docs"] or 0) * wanted.select("query_id").distinct().count()
        tasks = max(index.postings.sparkSession.sparkContext.defaultParallelism, ceil(scores / SCORES_PER_TASK))
        # A stored index also holds other terms, which need not move.
        found = found.join(F.broadcast(weighted.select("term")), "term", "left_semi")
        found, weighted = found.repartition(min(tasks, MAX_PARTITIONS), "doc_id"), F.broadcast(weighted)
    return (
        found.join(weighted, "term")
        .groupBy("query_id", "doc_id")
        .agg(F.sum(F.col("idf") * F.col("tf") / (F.col("tf") + norm)).alias("lexical"))
    )


def bm25(
    docs: DataFrame,
    queries: DataFrame,
    pool: int = 100,
    doc_id: str = "doc_id",
    text: str = "text",
    query_id: str = "query_id",
    query_text: str = "text",
    k1: float = K1,
    b: float = B,
    places: int = 6,
) -> DataFrame:
    """``(query_id, doc_id, lexical, rank)``: the best ``pool`` documents per query.

    Only postings of query terms are staged. Scores are rounded to ``places`` before ranking, ties go to the smaller
    document id. Queries of the same terms are asked once, and of documents with equal texts one is scored; the
    hits are handed on to the others.
    """
    asked = query_terms(queries, query_id, query_text).groupBy("query_id").agg(F.sort_array(F.collect_list("term")).alias("_terms"))
    asked = stage(asked.withColumn("_asked", F.min("query_id").over(Window.partitionBy("_terms"))), "asked")
    wanted = asked.where(F.col("query_id") == F.col("_asked")).select("query_id", F.explode("_terms").alias("term"))
    full = stage(postings(docs, doc_id, text, only=wanted.select("term").distinct()), "postings")
    members = stage(equal_documents(docs, doc_id, text), "equal-documents")
    copies = members.where(F.col("doc_id") != F.col("_first"))
    if copies.isEmpty():
        hits = bm25_top(full, wanted, pool, k1, b, places)
    else:
        scored = full.join(copies.select("doc_id"), "doc_id", "left_anti")
        index = Index(scored, document_frequencies(full), corpus_stats(full))
        hits = with_copies(bm25_top(index, wanted, pool, k1, b, places), members, pool)
    shared = asked.select("query_id", "_asked")
    return (
        hits.withColumnRenamed("query_id", "_asked").join(shared, "_asked").select("query_id", "doc_id", "lexical", "rank")
    )


def equal_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, _first)``: the smallest id among the documents of the same texts."""
    digests = docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("doc_id"), F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("_digest"))
    # An id that occurs twice is a document of two texts.
    whole = digests.groupBy("doc_id").agg(F.array_join(F.sort_array(F.collect_list("_digest")), " ").alias("_content"))
    first = whole.groupBy("_content").agg(F.min("doc_id").alias("_first"), F.count("*").alias("_n"))
    # Only texts that occur again are joined; a document without copies is its own first.
    again = whole.join(bounded_broadcast(first.where("_n > 1").drop("_n")), "_content", "left")
    return again.select("doc_id", F.coalesce("_first", "doc_id").alias("_first"))


def with_copies(hits: DataFrame, members: DataFrame, pool: int) -> DataFrame:
    """The best ``pool`` documents per query from the best ``pool`` of those that stand for their copies.

    Those with ``pool`` documents in front of them, all of better scores, are left out; of the others no more than ``pool``
    copies can be hits.
    """
    size = members.groupBy("_first").agg(F.count("*").alias("_size"))
    copies = rank_per(members.withColumn("_one", F.lit(1)), "_first", "doc_id", "_one", pool).select("_first", F.col("doc_id").alias("_copy"))
    best = stage(hits.drop("rank").withColumnRenamed("doc_id", "_first"), "first-hits")
    best = best.join(size, "_first")
    up_to = F.sum("_size").over(Window.partitionBy("query_id").orderBy(F.desc("lexical")))
    level = F.sum("_size").over(Window.partitionBy("query_id", "lexical"))
    best = best.withColumn("_before", up_to - level).where(F.col("_before") < pool).select("query_id", "_first", "lexical")
    opened = best.join(copies, "_first").select("query_id", F.col("_copy").alias("doc_id"), "lexical")
    return rank_per(opened, "query_id", "doc_id", "lexical", pool)


def bm25_top(
    index: DataFrame | Index, wanted: DataFrame, pool: int = 100, k1: float = K1, b: float = B, places: int = 6
) -> DataFrame:
    scored = bm25_scores(index, wanted, k1, b).withColumn("lexical", F.round("lexical", places))
    return rank_per(scored, "query_id", "doc_id", "lexical", pool)


def quality(rating: Column) -> Column:
    """Smoothed rating as a signal in [0, 1]."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), (rating - 1.0) / 4.0))


def combine_scores(
    candidates: DataFrame,
    weights: Mapping[str, float] = WEIGHTS,
    query_id: str = "query_id",
) -> DataFrame:
    """Add ``score``: weighted mean of the signals, each scaled to [0, 1] within its query.

    A signal that is constant within a query gives 0; a missing value counts as 0. The ranges come
    from one grouped aggregate, so no query's candidates are gathered.
    """
    signals = list(weights)
    filled = candidates.withColumns({s: F.coalesce(F.col(s), F.lit(0.0)) for s in signals})
    ranges = filled.groupBy(query_id).agg(
        *(F.min(s).alias(f"_lo_{s}") for s in signals), *(F.max(s).alias(f"_hi_{s}") for s in signals)
    )

    def scaled(s: str) -> Column:
        low, high = F.col(f"_lo_{s}"), F.col(f"_hi_{s}")
        return F.when(high > low, (F.col(s) - low) / (high - low)).otherwise(F.lit(0.0))

    total = sum(weights.values())
    score = sum((scaled(s) * F.lit(w / total) for s, w in weights.items()), F.lit(0.0))
    return (
        filled.join(ranges, query_id)
        .withColumn("score", score)
        .drop(*(f"_{edge}_{s}" for edge in ("lo", "hi") for s in signals))
    )


def rank_by_mode(
    candidates: DataFrame,
    mode: str = "hybrid",
    top_k: int = 10,
    query_id: str = "query_id",
    item_id: str = "recipe_id",
    places: int = 6,
) -> DataFrame:
    """``score`` and ``rank`` of candidates under a mode of :data:`MODES`, the best ``top_k`` per query."""
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode}; choose one of {sorted(MODES)}")
    scored = combine_scores(candidates, MODES[mode], query_id)
    scored = scored.withColumn("score", F.round("score", places))
    return rank_per(scored, query_id, item_id, "score", top_k)


