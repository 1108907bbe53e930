"""Exact dedup: frequent digests are told apart map-side, the rest by an ordinary shuffle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from queuelog.llm.common import staged, table

#: Counters of a Misra-Gries summary, and groups of tasks whose summaries meet before the last merge.
COUNTERS, MERGES = 1024, 64


def digest_of(text: Column, normalise: Callable[[Column], Column] | None = None) -> Column:
    """SHA-256 of the normalised text in UTF-8, lowercase hex; null counts as empty."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    return F.sha2((normalise(text) if normalise else text).cast("binary"), 256)


def frequent(rows: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Candidates ``digest``, at most ``counters``: every digest with a large enough share of ``rows``, and others.

    Spark's frequent-items state is a Misra-Gries summary: a bounded set of counters that are lowered
    together whenever they run out. Each task sums up its own rows, groups of tasks merge next, and a
    last merge reads ``MERGES`` summaries, however many tasks there were."""
    part = F.pmod(F.spark_partition_id(), F.lit(MERGES))
    states = rows.groupBy(part.alias("part")).agg(F.expr(f"approx_top_k_accumulate(digest, {counters})").alias("state"))
    merged = states.groupBy(F.col("part") < 0).agg(F.expr(f"approx_top_k_combine(state, {counters})").alias("state"))
    found = F.expr(f"approx_top_k_estimate(state, {counters})")
    return merged.select(F.explode(found).alias("found")).select(F.col("found.item").alias("digest"))


def _winners(rows: DataFrame) -> DataFrame:
    best = F.max(F.struct("doc_id", "row"))
    return rows.groupBy("digest").agg(best.alias("best"), F.count("*").alias("group_size"))


def _marks(docs: DataFrame, normalise, doc_id: str, text: str, counters: int) -> DataFrame:
    rows = docs.select(F.col(doc_id).alias("doc_id"), digest_of(F.col(text), normalise).alias("digest"))
    rows = staged(rows.withColumn("row", F.monotonically_increasing_id()), "digests")
    total = rows.count()
    hits = rows.join(F.broadcast(staged(frequent(rows, counters), "frequent")), "digest", "left_semi")
    heavy = staged(_winners(hits).where(F.col("group_size") * counters > total), "heavy")
    # the whole of a frequent group is known where its rows lie; groups left hold total / counters rows at most
    marked = rows.join(F.broadcast(heavy), "digest")
    rest = rows.join(F.broadcast(heavy.select("digest")), "digest", "left_anti")
    return marked.unionByName(rest.join(_winners(rest), "digest"))


def exact_duplicates(
    docs: DataFrame, *, normalise: Callable[[Column], Column] | None = None, doc_id: str = "doc_id", text: str = "text",
    counters: int = COUNTERS,
) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row of ``docs``.

    Texts are equal when identical after ``normalise``, an expression (none: no change); null counts
    as empty. Of equal texts the row with the largest doc_id stays, and only one row does: of rows
    with one doc_id and equal texts any one, of rows without doc_id only where the group has no other.
    Other columns are ignored.

    Digests are written once, with a number for each row. Misra-Gries names at most ``counters``
    candidates, which are counted exactly; those verified as more than 1/``counters`` of all rows are
    broadcast (that many rows at most) and settle their groups without a shuffle. The others
    are grouped by digest and joined back; a hot one cannot be among them.
    """
    rows = _marks(docs, normalise, doc_id, text, counters)
    return rows.select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("best.row")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def deduplicated(
    docs: DataFrame, *, normalise: Callable[[Column], Column] | None = None, doc_id: str = "doc_id", text: str = "text",
    counters: int = COUNTERS,
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; see ``exact_duplicates``.

    Texts are shuffled only where rows repeat doc_id and text both."""
    marks = staged(exact_duplicates(docs, normalise=normalise, doc_id=doc_id, text=text, counters=counters), "marks")
    marks = marks.select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_digest"), F.col("keep_id").alias("_keep"), F.col("kept").alias("_kept"))
    same = F.col(doc_id).eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_digest"))
    twice = marks.where(~F.col("_kept") & F.col("_id").eqNullSafe(F.col("_keep"))).select("_id", "_digest").distinct()
    rows = docs.withColumn("_own", digest_of(F.col(text), normalise)).join(marks.where("_kept").select("_id", "_digest"), same, "left_semi")
    once = rows.join(twice, same, "left_anti")
    one = rows.join(twice, same, "left_semi").dropDuplicates([doc_id, "_own"])
    return once.unionByName(one).select(*docs.columns)


def op12_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


OP12_SQL = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY text) AS keep_id, count(*) OVER (PARTITION BY text) AS group_size,
  row_number() OVER (PARTITION BY text ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(text) AS text_sha256
FROM t
"""
