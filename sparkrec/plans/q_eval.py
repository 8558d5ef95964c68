"""Evaluation queries over the item-item CF predictions of the candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrec.operators import evaluate as EV
from sparkrec.operators.baselines import UNKNOWN_USER_MEAN
from sparkrec.plans import sqlmodels as M
from sparkrec.plans.q_core import cf_predictions, cf_sql
from sparkrec.plans.registry import Ctx, register
from sparkrec.plans.sqlviews import with_views
from sparkrec.plans.util import round_doubles
from sparkrec.session import materialize

PLACEHOLDER_EVERY = 97     # fixture: every 97th input line carries the -999 placeholder

_JOINED = "cf_pred p join candidates c on c.user_id=p.user_id and c.item_id=p.item_id where p.prediction<>-999"
_DIFF = "round(p.prediction,6)-c.stars"


def _report_cols_sql(cols: list[str]) -> str:
    return with_views(f"select {','.join(cols)} from ({M.report_select(_DIFF, _JOINED)}) r",
                      "half_a", "candidates", extra=cf_sql())


def _report(ctx: Ctx):
    return EV.eval_report(round_doubles(cf_predictions(ctx)), ctx.candidates)


@register("eval_rmse", sql=_report_cols_sql(["count", "rmse"]))
def q_eval_rmse(ctx: Ctx):
    return round_doubles(_report(ctx).select("count", "rmse"))


@register("eval_bias", sql=_report_cols_sql(["avg_diff", "avg_pos_diff", "pos_count", "avg_neg_diff", "neg_count"]))
def q_eval_bias(ctx: Ctx):
    return round_doubles(_report(ctx).select("avg_diff", "avg_pos_diff", "pos_count", "avg_neg_diff", "neg_count"))


@register("eval_histogram", sql=_report_cols_sql(EV.HIST_NAMES))
def q_eval_histogram(ctx: Ctx):
    return _report(ctx).select(*EV.HIST_NAMES)


def _long_sql() -> str:
    rows = " union all ".join(f"select '{m}' metric,cast({m} as double) value from r" for m in EV.REPORT_METRICS)
    return with_views(rows, "half_a", "candidates",
                      extra=cf_sql() + [("r", M.report_select(_DIFF, _JOINED))])


@register("eval_report_long", sql=_long_sql())
def q_eval_report_long(ctx: Ctx):
    return round_doubles(EV.report_long(_report(ctx)))


@register("eval_join", sql=with_views(
    "select p.user_id,p.item_id,round(p.prediction,6) prediction,cast(c.stars as double) label "
    "from cf_pred p join candidates c on c.user_id=p.user_id and c.item_id=p.item_id",
    "half_a", "candidates", extra=cf_sql()))
def q_eval_join(ctx: Ctx):
    j = EV.eval_join(cf_predictions(ctx).select("user_id", "item_id", "prediction"), ctx.candidates)
    return round_doubles(j)


def _placeholder_preds(ctx: Ctx, predictions: DataFrame | None = None):
    p = (cf_predictions(ctx) if predictions is None else predictions).select("user_id", "item_id", "prediction")
    c = ctx.candidates_rn.select("row_no", "user_id", "item_id").join(p, ["user_id", "item_id"], "left")
    return c.withColumn("prediction", F.when(F.col("row_no") % PLACEHOLDER_EVERY == 0, F.lit(EV.PLACEHOLDER))
                        .otherwise(F.col("prediction")))


_PH_SQL = ("select c.row_no,c.user_id,c.item_id,case when c.row_no%97=0 then -999.0 else p.prediction end prediction "
           "from candidates c left join cf_pred p on p.user_id=c.user_id and p.item_id=c.item_id")


@register("eval_placeholder_filter", sql=with_views(
    "select row_no,user_id,item_id,round(prediction,6) prediction from ph where prediction<>-999",
    "half_a", "candidates", extra=cf_sql() + [("ph", _PH_SQL)]))
def q_eval_placeholder_filter(ctx: Ctx):
    return round_doubles(EV.drop_placeholders(_placeholder_preds(ctx)))


# --- E4/H13: best of three models (user mean, item mean, item-item CF) -------------
_CMP_SQL = (f"select ph.row_no,ph.user_id,ph.item_id,round(ph.prediction,6) c2,"
            f"round(coalesce(u.m,{UNKNOWN_USER_MEAN}),6) p3,round(coalesce(i.m,{UNKNOWN_USER_MEAN}),6) p4,"
            f"round(p.prediction,6) p5,cast(c.stars as double) label from ph "
            f"join candidates c on c.row_no=ph.row_no "
            f"left join (select user_id,avg(stars) m from half_a group by user_id) u on u.user_id=ph.user_id "
            f"left join (select item_id,avg(stars) m from half_a group by item_id) i on i.item_id=ph.item_id "
            f"join cf_pred p on p.user_id=ph.user_id and p.item_id=ph.item_id")


def _best_sql() -> str:
    # first listed model wins a tie: order by |d| then position
    d = ("(select d from (select unnest([p3-label,p4-label,p5-label]) d, unnest([0,1,2]) pos) z "
         "order by abs(d),pos limit 1)")
    body = M.report_select("bd", f"(select {d} bd from cmp where c2<>-999) b")
    return with_views(body, "half_a", "candidates", extra=cf_sql() + [("ph", _PH_SQL), ("cmp", _CMP_SQL)])


def comparison_table(ctx: Ctx):
    from sparkrec.operators.baselines import item_means, user_means
    # two columns read the predictions: they are worked out once
    predicted = materialize(cf_predictions(ctx).select("user_id", "item_id", "prediction"), "cf-predictions")
    ph = _placeholder_preds(ctx, predicted)
    um = user_means(ctx.half_a).select("user_id", F.col("user_mean").alias("p3"))
    im = item_means(ctx.half_a).select("item_id", F.col("item_mean").alias("p4"))
    cf = predicted.select("user_id", "item_id", F.col("prediction").alias("p5"))
    lab = ctx.candidates_rn.select("row_no", F.col("stars").cast("double").alias("label"))
    t = (ph.withColumnRenamed("prediction", "c2").join(lab, "row_no")
         .join(um, "user_id", "left").join(im, "item_id", "left").join(cf, ["user_id", "item_id"]))
    return round_doubles(t.select("row_no", "user_id", "item_id", "c2",
                                  F.coalesce("p3", F.lit(UNKNOWN_USER_MEAN)).alias("p3"),
                                  F.coalesce("p4", F.lit(UNKNOWN_USER_MEAN)).alias("p4"), "p5", "label"))


@register("best_of_models", sql=_best_sql())
def q_best_of_models(ctx: Ctx):
    t = comparison_table(ctx)
    return round_doubles(EV.best_of_models(t, ["p3", "p4", "p5"], "label", check_col="c2"))
