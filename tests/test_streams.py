"""Streams over tables that are one file or a folder of files."""

import pytest

from cuelake.plans import stream_queries as SQ

SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(params=["file", "folder", "empty"])
def table(request, spark, tmp_path):
    rows = [] if request.param == "empty" else [(1, "Hello there", "en", "src0"), (2, "hello there!", "en", "src3"), (3, "other", None, None), (4, None, "de", "src2")]
    folder = tmp_path / "documents.parquet"
    if request.param == "file":
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "whole"))
        next((tmp_path / "whole").glob("part-*.parquet")).rename(folder)
    else:
        spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(folder))
    spark.createDataFrame([(9, "not of the table")], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet.old"))
    return str(tmp_path), len(rows)


def test_streams_read_whole_tables(spark, table):
    path, n = table
    got = SQ._drain(spark, SQ.stream(spark, path, "documents").select("doc_id"), "all")
    assert sorted(r[0] for r in got.collect()) == list(range(1, n + 1))
    assert tuple(SQ.stream_append(spark, path).first()) == ((2, 2) if n else (0, 0))
