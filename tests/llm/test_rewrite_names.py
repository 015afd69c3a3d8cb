"""Rewritten shards keep columns of any name."""
from pyspark.sql import functions as F

from plenum.llm import reshard


def test_rewrite_with_clashing_and_dotted_names(spark, tmp_path):
    names = ["doc_id", "text", "__id", "__crc", "places", "a.b", "shard", "slot", "c0"]
    rows = [(i, f"text {i % 7} " * (1 + i % 5), "i", "c", "p", "d", "s", "t", str(i)) for i in range(60)] + [(None, None, *"icpdst", "n")]
    df = spark.createDataFrame(rows, "c_0 long, " + ", ".join(f"c_{i} string" for i in range(1, 9))).toDF(*names)
    placed = reshard.reshard(df, F.lit(0), 3, 4)
    written = reshard.rewrite(df, placed, str(tmp_path / "out")).collect()
    back = spark.read.parquet(str(tmp_path / "out")).select("row").collect()
    assert sum(r.rows for r in written) == len(back)
    moved = placed.where("moved").count()
    assert 0 < moved <= len(back)
    assert set(back[0].row.asDict()) == set(names)
    assert {tuple(r.row) for r in back} <= set(rows)
