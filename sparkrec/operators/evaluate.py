"""Evaluation (H13, H14): RMSE, signed bias, error histogram, best-of-N.

One aggregation per report: partial sums on every partition, one tiny final
merge. A prediction equal to the placeholder (-999) is skipped, as in the
reference; a missing truth is an error when ``strict``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the reference's evaluator.
PLACEHOLDER = -999.0
HIST_EDGES = [1, 2, 3, 4, 5]          # right-open unit buckets, the last open-ended
HIST_NAMES = ["count_0_1", "count_1_2", "count_2_3", "count_3_4", "count_4_5", "count_5_plus"]
REPORT_METRICS = ["count", "rmse", "avg_diff", "avg_pos_diff", "pos_count", "avg_neg_diff",
                  "neg_count"] + HIST_NAMES


def eval_join(pred: DataFrame, truth: DataFrame, keys=("user_id", "item_id"),
              pred_col="prediction", label_col="stars", strict: bool = True) -> DataFrame:
    """Prediction rows with their truth. A prediction without truth fails the
    job; with ``strict=False`` such rows are left out."""
    t = truth.select(*keys, F.col(label_col).cast("double").alias("label"), F.lit(True).alias("_truth"))
    if not strict:
        return pred.join(t, list(keys)).drop("_truth")
    j = pred.join(t, list(keys), "left")
    missing = F.raise_error(F.lit("prediction without truth")).cast("double")
    return j.withColumn("label", F.when(F.col("_truth").isNull(), missing).otherwise(F.col("label"))).drop("_truth")


def drop_placeholders(df: DataFrame, pred_col="prediction", placeholder=PLACEHOLDER) -> DataFrame:
    return df.filter(F.col(pred_col) != F.lit(placeholder))


def _bucket_counts(absd: Column) -> list[Column]:
    out = []
    lo = None
    for name, hi in zip(HIST_NAMES, HIST_EDGES + [None]):
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (absd >= lo)
        if hi is not None:
            cond = cond & (absd < hi)
        out.append(F.sum(F.when(cond, 1).otherwise(0)).cast("long").alias(name))
        lo = hi
    return out


def report_from_diff(df: DataFrame, diff: Column) -> DataFrame:
    """One row of metrics over ``diff`` (prediction - truth).

    Empty input gives count 0 and null means (the reference divides by 0).
    """
    d = df.select(diff.alias("d"))
    pos, neg = F.col("d") > 0, F.col("d") < 0
    n = F.count(F.lit(1))
    agg = d.agg(
        n.cast("long").alias("count"),
        F.sqrt(F.avg(F.col("d") * F.col("d"))).alias("rmse"),
        F.avg("d").alias("avg_diff"),
        F.coalesce(F.avg(F.when(pos, F.col("d"))), F.lit(PLACEHOLDER)).alias("avg_pos_diff"),
        F.sum(F.when(pos, 1).otherwise(0)).cast("long").alias("pos_count"),
        F.coalesce(F.avg(F.when(neg, F.col("d"))), F.lit(PLACEHOLDER)).alias("avg_neg_diff"),
        F.sum(F.when(neg, 1).otherwise(0)).cast("long").alias("neg_count"),
        *_bucket_counts(F.abs(F.col("d"))))
    return agg.select(*[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
                        if c.endswith("count") or c.startswith("count") else F.col(c)
                        for c in REPORT_METRICS])


def eval_report(pred: DataFrame, truth: DataFrame, keys=("user_id", "item_id"),
                pred_col="prediction", label_col="stars", strict: bool = True) -> DataFrame:
    j = drop_placeholders(eval_join(pred, truth, keys, pred_col, label_col, strict), pred_col)
    return report_from_diff(j, F.col(pred_col) - F.col("label"))


def report_long(report: DataFrame) -> DataFrame:
    """The one-row report as (metric, value) rows."""
    pairs = ", ".join(f"'{m}', cast({m} as double)" for m in REPORT_METRICS)
    return report.selectExpr(f"stack({len(REPORT_METRICS)}, {pairs}) as (metric, value)")


def best_diff(pred_cols: list[str], label: Column) -> Column:
    """Among the models' errors, the one of smallest magnitude; the first
    listed wins a tie (``array_min`` over (|d|, position, d) structs)."""
    structs = [F.struct(F.abs(F.col(c) - label).alias("a"), F.lit(i).alias("pos"),
                        (F.col(c) - label).alias("d")) for i, c in enumerate(pred_cols)]
    return F.array_min(F.array(*structs)).getField("d")


def best_of_models(df: DataFrame, pred_cols: list[str], label_col="label",
                   check_col: str | None = None) -> DataFrame:
    """The report if the best model were always picked. Rows whose
    ``check_col`` holds the placeholder are skipped (P13)."""
    if check_col:
        df = drop_placeholders(df, check_col)
    return report_from_diff(df, best_diff(pred_cols, F.col(label_col)))
