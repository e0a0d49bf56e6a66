"""BM25 search that scores only documents that can reach a query's last hit.

Documents are dealt into blocks of similar length. Beside the postings the index stores, for each term and for each term
and block, the greatest share any document gets from the term. Sums of such shares bound what the terms
of a query that were not looked at yet can add to a document.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from savora.operators.nearest import rank_per
from savora.operators.search import INDEX_BUCKETS, K1, MAX_PARTITIONS, SCORES_PER_TASK, B, corpus_stats, document_lengths, query_terms
from savora.plans.skew import bounded_broadcast, never_broadcast
from savora.session import stage

DOCS_PER_BLOCK = 64


def _band(length: Column) -> Column:
    """Half a power of two of lengths."""
    return F.floor(2 * F.log2(length)).cast("int")


def write_bounded_index(
    index: DataFrame, path: str, buckets: int = INDEX_BUCKETS, docs_per_block: int = DOCS_PER_BLOCK, k1: float = K1, b: float = B
) -> None:
    """Store postings with each document's share, bounds, frequencies and statistics.

    ``index`` comes from :func:`savora.operators.search.postings` and is read several times, so it should be stored
    or staged. Postings are dealt out as they are stored, once for themselves and once for the bounds. The share of a posting is its part of BM25 without the term's weight. A document's block
    follows from its length and id, so the postings are not shuffled to find it. Bounds have one row for each
    term and block.
    """
    bands = document_lengths(index).groupBy(_band(F.col("dl")).alias("band")).agg(F.count("*").alias("n"))
    # A length has at most 128 bands.
    bands = F.broadcast(stage(bands.select("band", F.ceil(F.col("n") / docs_per_block).alias("blocks")), "bands"))
    stats = stage(corpus_stats(index), "stats")
    norm = F.lit(k1) * (F.lit(1.0 - b) + F.lit(b) * F.col("dl") / stats.select("avgdl").scalar())
    bucket = F.pmod(F.hash("term"), F.lit(buckets)).alias("bucket")
    block = F.shiftleft(F.col("band").cast("bigint"), 40) + F.pmod(F.xxhash64("doc_id"), F.col("blocks"))
    rows = (
        index.where(F.col("term").isNotNull())
        .withColumn("band", _band(F.col("dl")))
        .join(bands, "band")
        .select("term", "doc_id", block.alias("block"), (F.col("tf") / (F.col("tf") + norm)).alias("share"), bucket)
    )
    order = ["bucket", "term", "block"]

    def write(name: str, dealt: DataFrame) -> DataFrame:
        dealt.write.partitionBy("bucket").mode("overwrite").parquet(f"{path}/{name}")
        return index.sparkSession.read.schema(dealt.schema).parquet(f"{path}/{name}")

    write("postings", rows.repartitionByRange(*order).sortWithinPartitions(*order))
    # Rows of a term and block are in one place already, and those of a term lie side by side in what is stored.
    by_block = rows.select(*order, "share").repartitionByRange(*order).groupBy(*order)
    bounds = write("bounds", by_block.agg(F.max("share").alias("bound"), F.count("*").alias("n")).sortWithinPartitions(*order))
    by_term = bounds.groupBy("bucket", "term").agg(F.sum("n").alias("df"), F.max("bound").alias("bound"))
    write("frequencies", by_term.repartitionByRange("bucket", "term").sortWithinPartitions("bucket", "term"))
    kind = index.schema["doc_id"].dataType.simpleString()
    stats.withColumns({"buckets": F.lit(buckets), "docs_per_block": F.lit(docs_per_block), "kind": F.lit(kind)}).write.mode("overwrite").parquet(f"{path}/stats")


@dataclass(frozen=True)
class Opened:
    """Ranked hits, and the rows of postings that were scored for them, ``query_id, term, doc_id``."""

    hits: DataFrame
    postings: DataFrame


def bounded_top(
    spark: SparkSession, path: str, queries: DataFrame, pool: int = 100, query_id: str = "query_id", text: str = "text", places: int = 6
) -> Opened:
    """``(query_id, doc_id, lexical, rank)`` as :func:`savora.operators.search.bm25` gives them.

    A query's terms come by falling bound. Documents are scored by the first of them, which make up half of the
    sum of bounds; the last of the hits so far is a score to reach, as what a document has can only grow. Terms are
    essential as long as they and all after them could make up that score: a document with none of these
    cannot reach it. Of the documents with essential terms those go on that can reach it with the bounds
    of their block for the other terms, and only they are looked up under the latter. Stop words are looked up for few
    documents, therefore. A query with fewer hits than ``pool`` has essential terms only.
    """
    stats = spark.read.parquet(f"{path}/stats").first()
    wanted = query_terms(queries, query_id, text)
    numbers = wanted.select(F.pmod(F.hash("term"), F.lit(stats["buckets"])).alias("b")).distinct()
    held = F.col("bucket").isin([row.b for row in numbers.collect()])  # as many as there are buckets at most
    schemas = {
        "postings": f"term string, doc_id {stats['kind']}, block bigint, share double, bucket int",
        "bounds": "term string, block bigint, bound double, n bigint, bucket int",
        "frequencies": "term string, df bigint, bound double, bucket int",
    }
    postings, bounds, frequencies = (spark.read.schema(s).parquet(f"{path}/{part}").where(held) for part, s in schemas.items())
    df = F.col("df")
    idf = F.log(F.lit(1.0) + (F.lit(float(stats["n_docs"])) - df + 0.5) / (df + 0.5))
    weighted = wanted.join(frequencies, "term").select("query_id", "term", idf.alias("idf"), (idf * F.col("bound")).alias("most"))
    falling = Window.partitionBy("query_id").orderBy(F.desc("most"), "term")
    rest = F.sum("most").over(falling.rowsBetween(0, Window.unboundedFollowing))  # of the term and all after it
    weighted = weighted.withColumn("rest", rest)
    weighted = stage(weighted.withColumn("whole", F.max("rest").over(Window.partitionBy("query_id"))), "weighted")
    slack = 2 * 10.0**-places

    scores = stats["n_docs"] * weighted.select("query_id").distinct().count()
    tasks = min(max(spark.sparkContext.defaultParallelism, ceil(scores / SCORES_PER_TASK)), MAX_PARTITIONS)

    def found(terms: DataFrame) -> DataFrame:
        """Postings of these terms, dealt out by document."""
        wanted_terms = stage(terms.select("term").distinct(), "wanted-terms")
        return postings.join(bounded_broadcast(wanted_terms), "term").select("term", "doc_id", "block", "share").repartition(tasks, "doc_id")

    def rows_of(terms: DataFrame) -> DataFrame:
        """Queries join where a document's postings are, so its sums need no shuffle."""
        chosen = bounded_broadcast(stage(terms.select("query_id", "term", "idf"), "terms"))
        part = (F.col("idf") * F.col("share")).alias("part")
        return found(terms).join(chosen, "term").select("query_id", "term", "doc_id", "block", part)

    first = F.col("rest") > F.col("whole") / 2

    def partial(rows: DataFrame) -> DataFrame:
        return rows.groupBy("query_id", "doc_id", "block").agg(F.sum("part").alias("partial"))

    reached = rank_per(partial(rows_of(weighted.where(first))), "query_id", "doc_id", "partial", pool).where(F.col("rank") == pool)
    floor = stage(reached.select("query_id", (F.col("partial") - slack).alias("floor")), "floors")
    weighted = weighted.join(bounded_broadcast(floor), "query_id", "left")
    essential = F.col("floor").isNull() | (F.col("rest") >= F.col("floor"))
    read = rows_of(weighted.where(essential | first))
    others = stage(weighted.where(~essential & ~first).select("query_id", "term", "idf", "floor"), "others")

    # What the other terms can add to a document of a block.
    more = bounds.join(bounded_broadcast(others), "term").groupBy("query_id", "block").agg(F.sum(F.col("idf") * F.col("bound")).alias("more"))
    open_ = (
        partial(read)
        .join(bounded_broadcast(floor), "query_id", "left")
        .join(bounded_broadcast(stage(more, "more")), ["query_id", "block"], "left")
        .where(F.col("floor").isNull() | (F.col("partial") + F.coalesce("more", F.lit(0.0)) >= F.col("floor")))
        .select("query_id", "doc_id", "partial")
    )
    open_ = stage(open_, "open")
    # Postings of the other terms meet the open documents by document; which of them a query asks for is known there.
    asked = bounded_broadcast(others.select("query_id", "term", "idf"))
    held = found(others).groupBy("doc_id").agg(F.collect_list(F.struct("term", "share")).alias("_held"))
    looked_up = (
        open_.select("query_id", "doc_id").join(bounded_broadcast(others.select("query_id").distinct()), "query_id", "left_semi")
        .repartition(tasks, "doc_id").join(never_broadcast(held), "doc_id")
        .select("query_id", "doc_id", F.inline("_held"))
        .join(asked, ["query_id", "term"])
        .select("query_id", "term", "doc_id", (F.col("idf") * F.col("share")).alias("part"))
    )
    added = looked_up.groupBy("query_id", "doc_id").agg(F.sum("part").alias("part"))
    scored = (
        open_.withColumnRenamed("partial", "part")
        .unionByName(added)
        .groupBy("query_id", "doc_id")
        .agg(F.round(F.sum("part"), places).alias("lexical"))
    )
    names = ["query_id", "term", "doc_id"]
    every = read.select(*names).unionByName(looked_up.select(*names))
    return Opened(rank_per(scored, "query_id", "doc_id", "lexical", pool), every)
