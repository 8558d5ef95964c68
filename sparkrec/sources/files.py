"""Readers and writers of the reference's files (A1-A10).

Ratings and candidates are CSV with a ``user_id,business_id,stars`` header;
profiles are JSON lines; predictions are CSV with the header
``user_id, business_id, prediction``. Every reader takes a declared schema
and renames ``business_id`` to ``item_id``, the name the operators use.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkrec.sources import schemas as S

PREDICTION_HEADER = "user_id, business_id, prediction"   # fixed value (spaces after commas)


def _csv(spark: SparkSession, path: str, schema, mode: str = "FAILFAST") -> DataFrame:
    return (spark.read.schema(schema).option("header", True).option("mode", mode)
            .option("ignoreLeadingWhiteSpace", True).csv(path))


def _drop_header_lines(df: DataFrame) -> DataFrame:
    """B1: the reference drops *every* line equal to the header, not just the first.
    A line with an empty id isn't a header line and stays. Where stars are still text, they must say so too."""
    names = ["user_id", "business_id"] + [f.name for f in df.schema if f.name == "stars" and f.dataType.typeName() == "string"]
    header = F.lit(True)
    for name in names:
        header = header & F.col(name).eqNullSafe(F.lit(name))
    return df.filter(~header)


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """A1: (user_id, item_id, stars). Repeated header lines are removed."""
    raw = _csv(spark, path, S.CANDIDATES_CSV)
    raw = _drop_header_lines(raw)
    return raw.select("user_id", F.col("business_id").alias("item_id"), F.col("stars").cast("double").alias("stars"))


def numbered_lines(spark: SparkSession, paths: list[str], schema) -> DataFrame:
    """Lines of CSV files with ``row_no``, which counts them in the order of the paths, of the names of a path's files
    and of the lines of a file, however the files are split.

    A split is known by its file and start (hidden file metadata); within one, ids grow with the lines. One row for each
    split - its number of lines - is summed up to offsets, the only thing that is ordered in one task. Header lines
    within a file are numbered before they are dropped, so numbers may have gaps.
    """
    parts = []
    for n, path in enumerate(paths):
        lines = _csv(spark, path, schema)
        parts.append(lines.select("*", F.lit(n).alias("_path"), F.col("_metadata.file_path").alias("_file"),
                                  F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_at")))
    lines = reduce(DataFrame.unionAll, parts)
    split = ["_path", "_file", "_start"]
    sizes = lines.groupBy(*split).agg(F.min("_at").alias("_first"), (F.max("_at") - F.min("_at") + 1).alias("_n"))
    before = Window.orderBy(*split).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*split, "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    numbered = lines.join(offsets, split).withColumn("row_no", F.col("_before") + F.col("_at") - F.col("_first"))
    return numbered.drop(*split, "_at", "_first", "_before")


def read_candidates(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A2: (row_no, user_id, item_id[, stars]) of one file, a folder or a list of these; ``row_no`` is the lines' order, which the sink sorts on."""
    raw = _drop_header_lines(numbered_lines(spark, [path] if isinstance(path, str) else list(path), S.CANDIDATES_CSV))
    return raw.select("row_no", "user_id", F.col("business_id").alias("item_id"), F.expr("try_cast(stars as double)").alias("stars"))


def read_user_profiles(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """A3: JSON lines with the declared user schema."""
    return spark.read.schema(S.USER_JSON).option("mode", mode).json(path)


def read_item_profiles(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """A4: JSON lines; ``attributes`` is a map of typed values (keys vary per row, may be null)."""
    df = spark.read.schema(S.ITEM_JSON).option("mode", mode).json(path)
    return df.withColumnRenamed("business_id", "item_id")


def _prediction_lines(pred: DataFrame, names: list[str], order_col: str | None) -> DataFrame:
    out = pred
    if order_col:
        out = out.repartitionByRange(order_col).sortWithinPartitions(order_col)
    return out.select(F.col("user_id").alias(names[0]), F.col("item_id").alias(names[1]), F.col("prediction").alias(names[2]))


def _write_csv(df: DataFrame, path: str, header: bool) -> None:
    (df.write.mode("overwrite").option("header", header).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))


def write_predictions(pred: DataFrame, path: str, header: str = PREDICTION_HEADER,
                      order_col: str | None = "row_no") -> None:
    """One line per input line, in input order. The header spelling is
    an option; columns are named after it so the CSV writer emits it verbatim.
    Output is range-partitioned on ``order_col``: part files in name order hold
    the lines in input order, with no single-task sort."""
    _write_csv(_prediction_lines(pred, header.split(","), order_col), path, header=True)


def write_predictions_file(pred: DataFrame, path: str, header: str = PREDICTION_HEADER, order_col: str | None = "row_no") -> None:
    """A5 as the reference leaves it: one file, one header, lines in input order.

    Tasks write their ranges as part files beside the target; the commit joins them in the
    order of their names under the header, as a stream through the file system that holds the
    path (no line is read as a row), and moves the whole file to its place. Until then the
    target is as it was; part files are deleted whether or not the job succeeds.
    """
    spark = pred.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target, parts = jvm.org.apache.hadoop.fs.Path(path), f"{path.rstrip('/')}.parts-{uuid.uuid4().hex}"
    folder = jvm.org.apache.hadoop.fs.Path(parts)
    fs = target.getFileSystem(conf)
    try:
        _write_csv(_prediction_lines(pred, ["user_id", "item_id", "prediction"], order_col), parts, header=False)
        whole = jvm.org.apache.hadoop.fs.Path(folder, "whole")
        out = fs.create(whole, True)
        try:
            out.write(bytearray(f"{header}\n".encode()))
            names = sorted(f.getPath().getName() for f in fs.listStatus(folder) if f.getPath().getName().startswith("part-"))
            for name in names:
                source = fs.open(jvm.org.apache.hadoop.fs.Path(folder, name))
                try:
                    jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, conf, False)
                finally:
                    source.close()
        finally:
            out.close()
        if fs.exists(target):
            fs.delete(target, True)
        if not fs.rename(whole, target):
            raise OSError(f"{path}: the finished file could not be moved to its place")
    finally:
        fs.delete(folder, True)


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Prediction files, spaced header tolerated."""
    raw = _drop_header_lines(_csv(spark, path, S.PREDICTIONS_CSV))
    return raw.select("user_id", F.col("business_id").alias("item_id"), "prediction")


read_truth = read_ratings   # A7: truth is a ratings file keyed by pair


def read_comparison(spark: SparkSession, path: str) -> DataFrame:
    """``user,item,c2,p3,p4,p5`` — c2 is checked for the placeholder, p3..p5 are models."""
    raw = _drop_header_lines(_csv(spark, path, S.COMPARISON_CSV))
    return raw.withColumnRenamed("business_id", "item_id")


def write_truth_vs_prediction(df: DataFrame, path: str) -> None:
    """``label,prediction`` lines for inspection."""
    df.select(F.col("label").alias("true"), F.col("prediction").alias("pred")) \
        .write.mode("overwrite").option("header", True).csv(path)


def save_tables(tables: dict[str, DataFrame], path: str) -> None:
    """A10: table-shaped models (weights, biases, cluster assignments) as Parquet."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{name}")


def load_tables(spark: SparkSession, path: str, names: list[str]) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{path.rstrip('/')}/{n}") for n in names}
