"""Line deduplication by site-relative frequency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from queuelog.llm.common import staged, table


def _key(line: Column) -> Column:
    return F.unhex(F.md5(F.trim(line, F.lit(" \t\r")).cast("binary")))


def _blank(line: Column) -> Column:
    return F.trim(line, F.lit(" \t\r")) == ""


def boilerplate_lines(docs: DataFrame, host: str, text: str, ratio: float, min_pages: int) -> DataFrame:
    """``host, key`` of the lines on more than ``ratio`` of a host's pages, ``min_pages`` at least.

    A page counts once for a line. Only 16-byte keys are shuffled, counted before the shuffle. A host
    has at most (lines per page) / ratio such lines, whatever its number of pages.
    """
    lines = F.split(F.col(text), "\n")
    keys = F.array_distinct(F.transform(F.filter(lines, lambda x: ~_blank(x)), _key))
    pages = docs.select(F.col(host).alias("host"), keys.alias("keys"))
    on = pages.select("host", F.explode("keys").alias("key")).groupBy("host", "key").agg(F.count("*").alias("on_pages"))
    total = pages.groupBy("host").agg(F.count("*").alias("pages")).withColumnRenamed("host", "_host")
    on = on.where(F.col("on_pages") >= min_pages).join(total, F.col("host").eqNullSafe(F.col("_host")))
    return on.where(F.col("on_pages").cast("double") / F.col("pages") > ratio).select("host", "key")


def drop_boilerplate(
    docs: DataFrame, *, ratio: float = 0.05, min_pages: int = 3, host: str = "source", text: str = "text"
) -> DataFrame:
    """``docs`` with ``n_lines, n_dropped`` and without the lines that are boilerplate of their host.

    Lines end at \\n and are compared without spaces, tabs and \\r around them; blank lines always stay.
    Null hosts form one host. A null text stays null with no lines; a text of boilerplate only becomes
    empty, its row stays. Repeated rows count as pages of their own. Columns named ``n_lines`` or
    ``n_dropped`` are replaced; all others are passed on.
    """
    found = boilerplate_lines(docs, host, text, ratio, min_pages)
    sets = staged(found.groupBy("host").agg(F.sort_array(F.collect_list("key")).alias("_drop")), "boilerplate")
    sets = sets.withColumnRenamed("host", "_host")
    rows = docs.drop("n_lines", "n_dropped").join(sets, F.col(host).eqNullSafe(F.col("_host")), "left").drop("_host")
    lines = F.split(F.col(text), "\n")
    kept = F.filter(lines, lambda x: _blank(x) | ~F.array_contains(F.col("_drop"), _key(x)))
    rows = rows.withColumn("_lines", lines).withColumn("_kept", F.when(F.col("_drop").isNull(), F.col("_lines")).otherwise(kept))
    n = F.coalesce(F.size("_lines"), F.lit(0))
    counts = {
        "n_lines": F.when(F.col(text).isNull(), 0).otherwise(n).cast("bigint"),
        "n_dropped": F.when(F.col(text).isNull(), 0).otherwise(n - F.size("_kept")).cast("bigint"),
        text: F.when(F.col("_drop").isNull(), F.col(text)).otherwise(F.array_join("_kept", "\n")),
    }
    return rows.withColumns(counts).drop("_lines", "_kept", "_drop")


def op3_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_boilerplate(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", "text")


OP3_SQL = """
WITH p AS (SELECT row_number() OVER () AS r, doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents),
l AS (
  SELECT DISTINCT r, source, trim(u, ' ' || chr(9) || chr(13)) AS line
  FROM (SELECT r, source, unnest(lines) AS u FROM p)),
b AS (
  SELECT c.source, c.line
  FROM (SELECT source, line, count(*) AS n FROM l WHERE line <> '' GROUP BY ALL) c
  JOIN (SELECT source, count(*) AS pages FROM documents GROUP BY source) t ON c.source IS NOT DISTINCT FROM t.source
  WHERE n >= 3 AND CAST(n AS DOUBLE) / pages > 0.05),
s AS (SELECT source, list(line) AS drops FROM b GROUP BY source),
k AS (
  SELECT p.doc_id, p.text, p.lines,
    list_filter(p.lines, lambda x: NOT list_contains(coalesce(drops, []), trim(x, ' ' || chr(9) || chr(13)))) AS kept
  FROM p LEFT JOIN s ON p.source IS NOT DISTINCT FROM s.source)
SELECT doc_id, CAST(coalesce(len(lines), 0) AS BIGINT) AS n_lines,
  CAST(coalesce(len(lines) - len(kept), 0) AS BIGINT) AS n_dropped,
  CASE WHEN text IS NOT NULL THEN coalesce(array_to_string(kept, chr(10)), '') END AS text
FROM k
"""
