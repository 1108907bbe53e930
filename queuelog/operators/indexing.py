"""Dense row numbers per group that never put a whole group into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from queuelog.functions.formats import TIME_STANDARDS
from queuelog.model import same_key_join, scratch_path

#: A sort bucket aims at this many rows; a task sorts one bucket, so its memory does not grow with the input.
ROWS_PER_BUCKET = 200_000
#: Number of buckets at most; beyond it buckets grow and spill.
MAX_BUCKETS = 10_000
_SAMPLES_PER_BUCKET = 20


def _position(key: Column, splits: Column, n: int) -> Column:
    """How many of the ``n`` ascending ``splits`` are at most ``key``, by binary search."""
    steps = [1 << i for i in reversed(range(n.bit_length()))]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, step: F.when(
            (at + step <= n) & (F.get(splits, at + step - 1) <= key), at + step
        ).otherwise(at),
    )


def _splits(keys: DataFrame, total: int, buckets: int) -> list[str]:
    """Keys (as JSON) that cut the input into about equal parts, from a sample chosen by hash.

    The sample holds about ``_SAMPLES_PER_BUCKET`` keys per bucket whatever the input's size,
    and the same input gives the same one.
    """
    modulus = 1 << 30
    share = min(1.0, buckets * _SAMPLES_PER_BUCKET / total)
    chosen = keys.where(
        F.pmod(F.xxhash64("key"), F.lit(modulus)) < F.lit(max(1, int(modulus * share)))
    )
    bounded = chosen.limit(4 * buckets * _SAMPLES_PER_BUCKET).orderBy("key")
    sample = [row[0] for row in bounded.select(F.to_json("key", TIME_STANDARDS["ISO-8601"])).collect()]
    if not sample:
        return []
    return list(dict.fromkeys(sample[len(sample) * i // buckets] for i in range(1, buckets)))


def dense_index(
    df: DataFrame,
    group: list[str],
    order: list[str],
    name: str = "row_index",
    *,
    first: DataFrame | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
    total: int | None = None,
) -> DataFrame:
    """Append a row number per ``group`` by ``order`` (which must be a total order).

    Numbers go up by one from 0, or from the ``first`` of a table with the group columns.

    Rows are cut into buckets of ``(group, order)`` ranges whose limits are literals, so the
    bucket of a row never depends on how Spark ran. Each bucket counts its rows, the small
    table of counts gives every bucket its first number, and rows are numbered inside their
    bucket. A large group spans many buckets; small groups share one. Tasks take
    about ``ROWS_PER_BUCKET`` rows at most.

    ``df`` is evaluated several times (mostly its key columns only), so it must give the same
    rows each time.
    """
    if total is None:
        total = df.count()
    buckets = min(MAX_BUCKETS, -(-total // rows_per_bucket))
    begins = None if first is None else first.select(*group, F.col("first").alias("_first"))
    if buckets <= 1:  # everything fits into one bucket, so any group does
        window = Window.partitionBy(*group).orderBy(*order)
        numbered = df.withColumn(name, F.row_number().over(window).cast("bigint") - 1)
        if begins is None:
            return numbered
        begun = same_key_join(numbered, begins, group, "left").withColumn(name, F.col(name) + F.coalesce("_first", F.lit(0)))
        return begun.select(*df.columns, name)

    key = F.struct(*group, *order)
    splits = _splits(df.select(key.alias("key")), total, buckets)
    if not splits:
        return dense_index(df, group, order, name, first=first, total=0)
    # the optimizer turns this into one constant
    kind = T.ArrayType(df.select(key.alias("key")).schema["key"].dataType)
    constant = F.sort_array(F.from_json(F.lit(f"[{','.join(splits)}]"), kind))
    bucketed = df.withColumn("_bucket", _position(key, constant, len(splits)))

    counts = bucketed.groupBy(*group, "_bucket").count()  # at most buckets + groups rows
    # written first, so that Spark knows how few they are and does not shuffle the rows once more to join them
    folder = scratch_path(df.sparkSession, "counts")
    counts.write.parquet(folder)
    counts = df.sparkSession.read.schema(counts.schema).parquet(folder)
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(*group, "_bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_base"))
    if begins is not None:  # joined to the counts, never to the rows
        bases = same_key_join(bases, begins, group, "left").withColumn("_base", F.col("_base") + F.coalesce("_first", F.lit(0)))
        bases = bases.drop("_first")

    inside = Window.partitionBy(*group, "_bucket").orderBy(*order)
    # in turn, as by hash several would meet in a task; as many tasks as the session shuffles to, more for large inputs
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // ROWS_PER_BUCKET))
    placed = bucketed.repartitionById(min(len(splits) + 1, tasks), F.col("_bucket"))
    ranked = placed.withColumn("_rank", F.row_number().over(inside))
    return (
        same_key_join(ranked, bases, [*group, "_bucket"])
        .withColumn(name, F.col("_base") + F.col("_rank") - 1)
        .select(*df.columns, name)
    )
