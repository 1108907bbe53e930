"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repeats."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from queuelog.llm.common import WORD, staged, table
from queuelog.operators.indexing import dense_index

#: Documents that one step of the fractional draw orders; a source is dealt into so many more.
STRATUM = 2000


def n_words(text: Column) -> Column:
    """Words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def _ranked(sources: DataFrame, partitions: int) -> DataFrame:
    """``sources`` with ``rank`` from 0 by code point of the source, null last. Sorted in ranges:
    only one count per range meets in a single task."""
    parts = sources.repartitionByRange(partitions, F.col("source").asc_nulls_last())
    parts = staged(parts.withColumn("part", F.spark_partition_id()), "ranked")
    before = parts.groupBy("part").count().withColumn(
        "base", F.sum("count").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    )
    inside = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last()))
    return parts.join(before.select("part", F.coalesce("base", F.lit(0)).alias("base")), "part").select(
        *sources.columns, (F.col("base") + inside - 1).alias("rank")
    )


def water_fill(sources: DataFrame, total: Decimal, epochs: int) -> DataFrame:
    """``sources`` (source_size, weight) with ``target``: ``total`` shared by weight, no target above
    ``epochs`` times its size. Sources over their cap are clamped and the excess goes to the others
    by weight, until none is over. Sums are exact integers; each round brings one row of them back.
    """
    cap = F.col("source_size").cast("decimal(38,0)") * epochs
    fixed = F.lit(False)
    left, weight, clamped = total, None, -1
    while True:
        row = sources.agg(
            F.sum(F.when(~fixed, F.col("weight"))).alias("weight"),
            F.sum(F.when(fixed, F.col("source_size").cast("decimal(38,0)"))).alias("size"),
            F.count(F.when(fixed, 1)).alias("n"),
        ).first()
        weight, left = row["weight"], total - epochs * (row["size"] or 0)
        if row["n"] == clamped or weight is None:
            break
        clamped = row["n"]
        fixed = F.col("weight") * F.lit(left).cast("decimal(38,0)") >= cap * F.lit(int(weight))
    share = (F.col("weight") * F.lit(left).cast("decimal(38,0)")).cast("double") / F.lit(float(weight or 1))
    return sources.withColumn("target", F.when(fixed, cap.cast("double")).otherwise(share))


def _taken(
    docs: DataFrame, *, weights: tuple[int, ...] = (1, 2, 3), share: float = 1.0, epochs: int = 3, seed: str = "mix",
    text: str = "text", doc_id: str = "doc_id", source: str = "source",
) -> DataFrame:
    draw = F.coalesce(F.col(doc_id).cast("string"), F.md5(F.col(text).cast("binary")), F.lit(""))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), n_words(F.col(text)).alias("size"),
        F.md5(F.concat(F.lit(seed), draw).cast("binary")).alias("_draw"),
    )
    rows = staged(rows, "sizes")
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    ranked = _ranked(sources, 8)
    ranked = staged(ranked.withColumn("weight", F.array(*map(F.lit, weights))[(F.col("rank") % len(weights)).cast("int")].cast("decimal(20,0)")), "sources")
    total = ranked.agg(F.sum(F.col("source_size").cast("decimal(38,0)"))).first()[0] or Decimal(0)
    filled = water_fill(ranked, (total * Decimal(str(share))).to_integral_value(), epochs)
    filled = filled.select(
        F.col("source").alias("_source"), "source_size", "target",
        F.ceil(F.col("n_docs") / STRATUM).alias("_strata"),
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)).alias("_rate"),
    )
    rows = rows.join(filled, F.col("source").eqNullSafe(F.col("_source")))
    rows = rows.withColumn("_stratum", F.conv(F.substring("_draw", 1, 8), 16, 10).cast("bigint") % F.col("_strata"))
    stratum = Window.partitionBy("_source", "_stratum")
    order = stratum.orderBy("_draw", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto, whole = F.sum("size").over(order), F.floor("_rate")
    part = F.sum("size").over(stratum) * (F.col("_rate") - whole)
    extra = (F.col("size") > 0) & (2 * upto - F.col("size") <= 2 * part) & (part > 0)
    return rows.withColumn("copies", (whole + extra.cast("int")).cast("bigint"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """Words that a mix takes of each document: ``doc_id, size, source_size, target, taken, copies``.

    Options: ``weights`` (1, 2, 3), ``share`` 1.0, ``epochs`` 3, ``seed``, and the column names ``text``,
    ``doc_id``, ``source``. Sources in code point order (null, a source of its own, last) weigh ``weights`` in turn and share
    ``share`` of all words, none more than ``epochs`` times its own. With rate r = target / size of a
    source, each of its documents comes floor(r) times; the rest is drawn: documents lie in strata of
    about ``STRATUM`` by a seeded hash of the id (of the text where there is none), ordered by the hash,
    and one more copy is taken from the start of a stratum up to the point nearest to its part of the
    words. A stratum thus misses its part by half a document at most, and reruns agree. A hot source has
    many strata. Null text has size 0; a document with size 0 takes nothing. Repeated rows count as
    rows. Other columns are ignored.
    """
    rows = _taken(docs, **options)
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix themselves, each as often as it is taken.

    Copies are joined to rows by id, source and size. Where several rows have these in common, they share
    their copies, all of them and as evenly as can be; such rows are written once with numbers of their own."""
    names = docs.columns
    key, origin = options.get("doc_id", "doc_id"), options.get("source", "source")
    group = F.struct(F.col("doc_id"), F.col("source"), F.col("size"))
    copies = _taken(docs, **options).groupBy(F.to_json(group).alias("_key")).agg(F.sum("copies").alias("_all"), F.count("*").alias("_rows"))
    copies = staged(copies.where("_all > 0"), "copies")
    own = F.struct(F.col(key).alias("doc_id"), F.col(origin).alias("source"), n_words(F.col(options.get("text", "text"))).alias("size"))
    rows = docs.withColumn("_key", F.to_json(own))
    again = F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))
    out = rows.join(copies.where("_rows = 1").withColumn("_copies", F.col("_all")), "_key")
    several = copies.where("_rows > 1")
    if not several.isEmpty():
        met = staged(rows.join(several, "_key").withColumn("_row", F.monotonically_increasing_id()), "several")
        turn = dense_index(met.select("_key", "_all", "_rows", "_row"), ["_key"], ["_row"], "_turn")
        part = F.floor(F.col("_all") / F.col("_rows")) + (F.col("_turn") < F.col("_all") % F.col("_rows")).cast("int")
        turn = turn.select("_row", part.alias("_copies")).where("_copies > 0")
        out = out.select(*names, "_copies").unionByName(met.join(turn, "_row").select(*names, "_copies"))
    return out.withColumn("_copy", again).select(*names)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("copies")


OP4_SQL = """
WITH rows AS (
  SELECT doc_id, text, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS n_docs FROM rows GROUP BY source),
w AS (
  SELECT *, CAST(1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS BIGINT) AS weight FROM s),
r AS (
  SELECT *, CAST(sum(source_size) OVER () AS HUGEINT) AS total,
    coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / weight, weight, source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
    sum(weight) OVER (ORDER BY 3 * source_size / weight, weight, source NULLS LAST
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
  FROM w),
f AS (SELECT *, weight * (total - capped) >= 3 * source_size * open AS at_cap FROM r),
level AS (
  SELECT coalesce(sum(3 * source_size) FILTER (at_cap), 0) AS capped, sum(weight) FILTER (NOT at_cap) AS open FROM f),
t AS (
  SELECT f.source, source_size, n_docs,
    CASE WHEN at_cap THEN CAST(3 * source_size AS DOUBLE)
      ELSE CAST(weight * (total - level.capped) AS DOUBLE) / CAST(level.open AS DOUBLE) END AS target
  FROM f, level),
d AS (
  SELECT rows.doc_id, rows.source, size, source_size, target,
    CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
    md5('mix' || coalesce(CAST(doc_id AS VARCHAR), md5(text), '')) AS draw,
    CAST(ceil(n_docs / 2000) AS BIGINT) AS strata
  FROM rows JOIN t ON rows.source IS NOT DISTINCT FROM t.source),
e AS (
  SELECT *, CAST('0x' || substr(draw, 1, 8) AS BIGINT) % strata AS stratum FROM d),
g AS (
  SELECT *, sum(size) OVER (PARTITION BY source, stratum ORDER BY draw, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto,
    CAST(sum(size) OVER (PARTITION BY source, stratum) AS DOUBLE) * (rate - floor(rate)) AS part
  FROM e)
SELECT doc_id, size, source_size, target,
  CAST(size * (floor(rate) + CASE WHEN size > 0 AND 2 * upto - size <= 2 * part AND part > 0 THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM g
"""
