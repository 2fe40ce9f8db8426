"""Sources, sinks, payloads, scratch folders."""

import glob
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql.types import DoubleType

from tallyfield.sources import files, payload

SERIES = {"a": DoubleType(), "b": DoubleType()}


def exploded(spark, tmp_path, *documents):
    path = tmp_path / "payload.json"
    path.write_text("\n".join(documents))
    read = payload.read_payloads(spark, str(path), "hourly", "time", SERIES)
    return payload.explode_aligned(read, "hourly", "time", list(SERIES), {"place": "here"})


def test_payload_rows(spark, tmp_path):
    df = exploded(spark, tmp_path, '{"hourly": {"time": ["t1", "t2"], "a": [1, null], "b": [3, 4]}, "x": 1}')
    assert df.columns == ["place", "time", "a", "b"]
    assert [tuple(r) for r in df.collect()] == [("here", "t1", 1.0, 3.0), ("here", "t2", None, 4.0)]


@pytest.mark.parametrize("document, message", [
    ('{"reason": "limit"}', "no hourly time"),
    ('{"hourly": {"time": [], "a": [], "b": []}}', "no hourly time"),
    ('{"hourly": {"time": ["t"], "a": [1]}}', "incomplete b"),
    ('{"hourly": {"time": ["t"], "a": [1, 2], "b": [1]}}', "incomplete a"),
])
def test_bad_payloads_fail(spark, tmp_path, document, message):
    with pytest.raises(Exception, match=message):
        exploded(spark, tmp_path, document).collect()


def test_partition_folders(spark, tmp_path):
    rows = spark.createDataFrame([(1, 2012, 12), (2, 2013, 7), (3, 2013, None)], "id int, year int, district int")
    path = str(tmp_path / "out")
    files.write_partitioned(rows, path, ["year", "district"])
    assert os.path.isdir(f"{path}/year=2012/district=12") and os.path.isdir(f"{path}/year=2013/district=7")
    assert sorted(tuple(r) for r in files.read_table(spark, path).select("id", "year").collect()) == [
        (1, 2012), (2, 2013), (3, 2013)
    ]


def test_existing_output_is_refused_on_request(spark, tmp_path):
    path = str(tmp_path / "t")
    files.write_table(spark.range(3), path)
    with pytest.raises(AnalysisException):
        files.write_table(spark.range(3), path, "errorifexists")
    files.write_table(spark.range(2), path)
    assert files.read_table(spark, path).count() == 2


def test_csv_keeps_row_order_in_one_file(spark, tmp_path):
    path = str(tmp_path / "csv")
    files.export_csv(spark.range(100, 0, -1, 4), path, ["id"])
    (only,) = glob.glob(f"{path}/*.csv")
    assert open(only).read().split() == ["id", *map(str, range(2, 101))] or open(only).read().split() == [
        "id", *map(str, range(1, 101))
    ]


def test_large_csv_is_sorted_over_several_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "ONE_FILE_ROWS", 50)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    path = str(tmp_path / "csv")
    with pytest.raises(ValueError, match="single_file"):
        files.export_csv(spark.range(51), path, ["id"])
    files.export_csv(spark.range(1000).repartition(4), path, ["id"], single_file=False)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = sorted(glob.glob(f"{path}/*.csv"))
    values = [int(line) for part in parts for line in open(part).read().split() if line != "id"]
    assert len(parts) > 1 and values == list(range(1000))


def test_scratch_lies_in_the_shared_folder_and_is_removed(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    with files.scratch(spark) as folder:
        assert folder.startswith(shared)
        assert files.stage(spark.range(5), folder, "t").count() == 5
        assert os.path.isdir(f"{folder}/t")
    assert not os.path.exists(folder)


def test_raw_csv_is_all_text(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text('B,A\n1,"x, y"\n,2\n')
    df = files.read_raw_csv(spark, str(path))
    assert df.dtypes == [("B", "string"), ("A", "string")]
    assert [tuple(r) for r in df.collect()] == [("1", "x, y"), (None, "2")]
