"""Shards end no further apart than the largest document."""
import pytest
from pyspark.sql import functions as F

from plenum.llm import reshard


@pytest.mark.parametrize("n_old,shards", [(5, 4), (1, 7), (9, 3), (3, 24)])
def test_shards_differ_by_a_document_at_most(spark, n_old, shards):
    # a third in one old shard, some documents longer than a whole stretch, repeated rows, nulls
    rows = [(i, "x" * (17 * i % 230)) for i in range(400)] + [(i, "y" * 2600) for i in range(1000, 1012)]
    rows += [(7, "same")] * 40 + [(None, None), (None, "no id"), (5, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    old = F.when(F.col("doc_id") % 3 == 0, 0).otherwise(F.coalesce(F.col("doc_id"), F.lit(1)))
    out = reshard.reshard(df, old, n_old, shards, block_rows=50).toPandas()
    assert sorted(out["size"]) == sorted(len(t or "") + 8 for _, t in rows)
    held = out.groupby("shard")["size"].sum().reindex(range(shards), fill_value=0)
    assert held.max() - held.min() <= 2608
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in out.groupby("shard"))


def test_bytes_moved_stay_near_the_flow(spark):
    df = spark.createDataFrame([(i, "z" * (i * 31 % 90)) for i in range(900)], "doc_id long, text string")
    out = reshard.reshard(df, F.col("doc_id") % 10 % 4, 4, 6, block_rows=100).toPandas()
    old = [int(out[out.old_shard == i]["size"].sum()) for i in range(4)]
    flow = reshard.plan_transfers(old, reshard.even_capacities(sum(old), 6))
    least = sum(a for i, row in enumerate(flow) for j, a in enumerate(row) if i != j)
    cuts = sum(a > 0 for row in flow for a in row)
    assert abs(int(out[out.moved]["size"].sum()) - least) <= cuts * 98
