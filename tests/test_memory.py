"""What one task holds does not grow with the input."""

import os

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from queuelog.operators import indexing
from queuelog.operators.indexing import dense_index
from queuelog.sources import datasource


def test_a_task_sorts_one_bucket(spark, monkeypatch):
    monkeypatch.setattr(indexing, "ROWS_PER_BUCKET", 1000)
    rows = spark.range(20_000).select(F.lit("q").alias("g"), F.col("id"))
    got = dense_index(rows, ["g"], ["id"], rows_per_bucket=1000).cache()
    sizes = got.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) < 3000
    assert got.where("row_index <> id").isEmpty() and got.count() == 20_000


def test_a_row_group_is_not_held_whole(tmp_path):
    n = 80_000
    table = pa.table({
        "broker_name": ["b"] * n, "queue_id": pa.array([0] * n, pa.int32()), "queue_offset": range(n),
        "tags": ["x" if i % 2 else "y" for i in range(n)], "body": [os.urandom(1000) for _ in range(n)],
    })
    pq.write_table(table, tmp_path / "a.parquet", row_group_size=n, use_dictionary=False)
    del table
    topic = datasource._Topic({"path": str(tmp_path), "topic": "t", "tag": "x", "columns": ["body", "queue_offset", "topic"]})
    before, most, found = pa.total_allocated_bytes(), 0, []
    for batch in topic.read(datasource.FilePart(str(tmp_path / "a.parquet"), skip=[("b", 0, 11)])):
        most = max(most, pa.total_allocated_bytes() - before)
        found += batch.column(1).to_pylist()
        assert batch.schema.names == ["body", "queue_offset", "topic"]
    assert found == list(range(11, n, 2))
    assert most < 40_000_000
