"""Core queries: scans, the item-item CF slice and its evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkrec.operators import evaluate, itemcf
from sparkrec.plans import sqlmodels as M
from sparkrec.plans.registry import Ctx, register
from sparkrec.plans.sqlviews import with_views
from sparkrec.plans.util import round_doubles

# Parameters of the reference's item-item CF (fixed values).
CF_K, CF_MIN_CO, CF_P = 20, 35, 2.5
CF_THRESHOLDS = [0, 10, 20, 25, 30, 35]   # the co-rater sweep the reference reports


def cf_predictions(ctx: Ctx, k=CF_K, min_co=CF_MIN_CO, p=CF_P, clamp_range=(1.0, 5.0)):
    return itemcf.item_cf(ctx.half_a, ctx.candidates, k=k, min_co=min_co, p=p, clamp_range=clamp_range)


def cf_sql(k=CF_K, min_co=CF_MIN_CO, p=CF_P, lo=1.0, hi=5.0, pre="cf"):
    return M.item_cf("half_a", "candidates", pre=pre, k=k, min_co=min_co, p=p, lo=lo, hi=hi)


# --- A1/B2/B4: ratings scan, typed to the reference's data model --------------
@register("ratings_scan", sql=with_views(
    "select cast(user_id as varchar) user_id,cast(item_id as varchar) item_id,cast(stars as double) stars from ratings",
    "ratings"))
def q_ratings_scan(ctx: Ctx):
    r = ctx.ratings
    return r.select(F.col("user_id").cast("string"), F.col("item_id").cast("string"),
                    F.col("stars").cast("double"))


# --- H1: item-item CF, k=20 and k=5 -----------------------------------------------
@register("item_item_cf", sql=with_views(
    "select user_id,item_id,round(prediction,6) prediction,route from cf_pred",
    "half_a", "candidates", extra=cf_sql()))
def q_item_item_cf(ctx: Ctx):
    return round_doubles(cf_predictions(ctx))


@register("item_item_cf_k5", sql=with_views(
    "select user_id,item_id,round(prediction,6) prediction,route from cf_pred",
    "half_a", "candidates", extra=cf_sql(k=5)))
def q_item_item_cf_k5(ctx: Ctx):
    return round_doubles(cf_predictions(ctx, k=5))


# --- H14: full evaluation report of item-item CF on the candidates ------------
@register("eval_report", sql=with_views(
    M.report_select("round(p.prediction,6)-c.stars",
                    "cf_pred p join candidates c on c.user_id=p.user_id and c.item_id=p.item_id where p.prediction<>-999"),
    "half_a", "candidates", extra=cf_sql()))
def q_eval_report(ctx: Ctx):
    return round_doubles(evaluate.eval_report(round_doubles(cf_predictions(ctx)), ctx.candidates))


# --- H1 on customer x brand/type ratings: string item ids, ~11k items -------------------
@register("item_item_cf_bt", ratings="bt", sql=with_views(
    "select user_id,item_id,round(prediction,6) prediction,route from cf_pred",
    "half_a", "candidates", ratings="ratings_bt", extra=cf_sql()))
def q_item_item_cf_bt(ctx: Ctx):
    return round_doubles(cf_predictions(ctx))
