import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from queuelog.llm import exact

DOCS = "doc_id bigint, text string, digest string, row int, kept boolean, group_size bigint"


def brute(rows, normalise=lambda t: t):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[normalise(text or "")].append(doc_id)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        left = 1
        for i in ids:
            stays = i == keep and left > 0
            left -= stays
            out.append((i, keep, len(ids), stays, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def rows_with_hot_groups():
    r = random.Random(5)
    rows = [(i, r.choice(["hot", "hot", None, "", "warm", f"own {i}", "Hot", f"pair {i // 2}"])) for i in range(3000)]
    rows += [(None, "hot"), (None, "only without id"), (None, "only without id"), (7, "twice"), (7, "twice"), (7, "twice"), (9, "x" * 200_000)]
    return rows


@pytest.mark.parametrize("counters", [4, 64, exact.COUNTERS])
def test_every_row_is_marked(spark, counters):
    rows = rows_with_hot_groups()
    docs = spark.createDataFrame([(i, t, "d", 1, True, 1) for i, t in rows], DOCS).repartition(7)
    got = exact.exact_duplicates(docs, counters=counters).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)
    low = exact.exact_duplicates(docs, normalise=F.lower, counters=counters).collect()
    assert sorted(map(tuple, low), key=str) == brute(rows, str.lower)


def test_rows_that_stay_keep_their_columns(spark):
    rows = rows_with_hot_groups()
    docs = spark.createDataFrame([(i, t, "d", 1, True, 1) for i, t in rows], DOCS)
    got = exact.deduplicated(docs)
    assert got.columns == docs.columns
    assert sorted(((r.doc_id, r.text or "") for r in got.collect()), key=str) == sorted({(k, t or "") for t, k in {
        t or "": max((i for i, u in rows if (u or "") == (t or "") and i is not None), default=None) for _, t in rows}.items()}, key=str)


def test_empty_table(spark):
    none = spark.createDataFrame([], DOCS)
    assert exact.exact_duplicates(none).count() == 0
    assert exact.deduplicated(none).count() == 0


def test_misra_gries_names_what_is_frequent(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 7 == 0, "b").otherwise(F.col("id").cast("string")).alias("digest"))
    found = [r.digest for r in exact.frequent(rows.repartition(9), 32).collect()]
    assert {"a", "b"} <= set(found) and len(found) <= 32


def test_hot_groups_are_not_shuffled(spark):
    """Marks of a frequent digest come from a broadcast; the plan has no Python in it."""
    rows = spark.range(5000).select("id", F.lit("same").alias("text"))
    plan = exact.exact_duplicates(rows, doc_id="id")._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "Python" not in plan and "Arrow" not in plan
