"""Tasks are made by the bytes that are stored, not by what a shuffle compresses them to."""

from __future__ import annotations

from tillpoint.sources import binding
from tillpoint.sources.files import stored_bytes


def test_many_lines_are_dealt_into_tasks_by_their_bytes(spark, tmp_path):
    lines = spark.range(1000).selectExpr("id % 50 as l_orderkey", "id as l_partkey")
    assert binding.dealt_by_order(lines, binding.DEALT_FROM - 1) is lines
    dealt = binding.dealt_by_order(lines, binding.DEALT_FROM + 1)
    assert dealt.rdd.getNumPartitions() == binding.DEALT_FROM // binding.DEALT_BYTES + 1
    assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, lines.collect()))
    path = str(tmp_path / "lines.parquet")
    lines.write.parquet(path)
    assert stored_bytes(spark, path) >= sum(p.stat().st_size for p in (tmp_path / "lines.parquet").glob("part-*"))
