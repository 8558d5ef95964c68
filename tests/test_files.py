"""Line numbers over files and splits, and predictions in one file."""

import os

import pytest
from pyspark.sql import functions as F

from sparkrec.sources import files

HEADER = "user_id,business_id,stars"


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _write(path, rows, again=()):
    lines = [HEADER]
    for n, (u, b) in enumerate(rows):
        lines += [f"{u},{b},3.0"] + [HEADER] * (n in again)
    path.write_text("\n".join(lines) + "\n")


def _rows(n, tag):
    return [(f"u{tag}{(k * 37) % 101}", f"b{(k * 11) % 23}") for k in range(n)]


def _read(spark, path):
    return [(r.user_id, r.item_id) for r in files.read_candidates(spark, path).orderBy("row_no").collect()]


def test_a_folder_of_three_files_split_small(spark, tmp_path, small_splits):
    """The largest file comes second by name, so packing by size would put it first; header lines may repeat."""
    a, b, c = _rows(40, "a"), _rows(500, "b"), _rows(3, "c")
    for name, rows in (("1.csv", a), ("2.csv", b), ("3.csv", c)):
        _write(tmp_path / name, rows, again=(7, 300))
    read = files.read_candidates(spark, str(tmp_path))
    assert read.rdd.getNumPartitions() > 3
    assert _read(spark, str(tmp_path)) == a + b + c
    numbers = [r.row_no for r in read.collect()]
    assert len(set(numbers)) == 543 and max(numbers) < 543 + 6


def test_paths_in_the_declared_order(spark, tmp_path, small_splits):
    a, b = _rows(90, "a"), _rows(60, "b")
    _write(tmp_path / "z.csv", a)
    _write(tmp_path / "a.csv", b)
    assert _read(spark, [str(tmp_path / "z.csv"), str(tmp_path / "a.csv")]) == a + b


def test_a_file_without_lines(spark, tmp_path):
    _write(tmp_path / "a.csv", [])
    _write(tmp_path / "b.csv", _rows(2, "b"))
    assert _read(spark, str(tmp_path)) == _rows(2, "b")
    assert _read(spark, str(tmp_path / "a.csv")) == []


def test_ids_named_like_the_header_stay(spark, tmp_path):
    (tmp_path / "a.csv").write_text(f"{HEADER}\nuser_id,business_id,4.0\n{HEADER}\nu,b,1.0\n")
    assert [(r.user_id, r.stars) for r in files.read_ratings(spark, str(tmp_path / "a.csv")).collect()] == [("user_id", 4.0), ("u", 1.0)]


def test_one_file_in_input_order(spark, tmp_path, small_splits):
    """Bytes as written line by line, whatever the splits; an earlier file is replaced; nothing else is left."""
    rows = _rows(400, "x")
    _write(tmp_path / "in.csv", rows)
    out = tmp_path / "out" / "pred.csv"
    out.parent.mkdir()
    out.write_text("earlier")
    scored = files.read_candidates(spark, str(tmp_path / "in.csv")).withColumn("prediction", F.col("row_no") / 8)
    files.write_predictions_file(scored.repartition(9), str(out))
    numbers = [r.row_no for r in scored.orderBy("row_no").collect()]
    want = "user_id, business_id, prediction\n" + "".join(f"{u},{b},{n / 8}\n" for (u, b), n in zip(rows, numbers))
    assert out.read_text() == want
    assert [x for x in os.listdir(out.parent) if not x.endswith(".crc")] == ["pred.csv"]
    assert files.read_predictions(spark, str(out)).count() == 400


def test_one_file_without_rows(spark, tmp_path):
    none = spark.createDataFrame([], "row_no long, user_id string, item_id string, prediction double")
    files.write_predictions_file(none, str(tmp_path / "pred.csv"), header="a,b,c")
    assert (tmp_path / "pred.csv").read_text() == "a,b,c\n"


def test_a_failed_task_leaves_nothing(spark, tmp_path):
    out = tmp_path / "pred.csv"
    out.write_text("earlier")
    bad = spark.range(50).select(F.col("id").alias("row_no"), F.lit("u").alias("user_id"), F.lit("b").alias("item_id"),
                                 F.when(F.col("id") == 40, F.raise_error(F.lit("broken")).cast("double")).otherwise(1.0).alias("prediction"))
    with pytest.raises(Exception, match="broken"):
        files.write_predictions_file(bad, str(out))
    assert out.read_text() == "earlier"
    assert [x for x in os.listdir(tmp_path) if not x.endswith(".crc")] == ["pred.csv"]
