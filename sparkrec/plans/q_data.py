"""Queries over scans, splits, baselines, routing, pairs and profile features."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkrec.functions.columns import amplify, attach_row, clamp, pair_key
from sparkrec.operators import baselines as B
from sparkrec.operators import features as FE
from sparkrec.operators import itemcf
from sparkrec.operators.split import with_half
from sparkrec.plans.q_core import CF_MIN_CO, CF_P, cf_predictions, cf_sql
from sparkrec.plans.registry import Ctx, register
from sparkrec.plans.sqlviews import H, with_views
from sparkrec.plans.util import round_doubles
from sparkrec.session import materialize
from sparkrec.sources import fixtures

# --- A4: item profile attributes parsed from JSON text -----------------------
@register("item_attr_scan", sql=with_views(
    """select item_id,attr_key,json_extract_string(attributes,concat('$."',attr_key,'"')) attr_value
 from (select item_id,attributes,unnest(json_keys(attributes)) attr_key from item_profile where attributes is not null) x""",
    "item_profile"))
def q_item_attr_scan(ctx: Ctx):
    p = FE.parse_attributes(ctx.item_profile).filter(F.col("attrs").isNotNull())
    return p.select("item_id", F.explode("attrs").alias("attr_key", "v")).select("item_id", "attr_key", F.col("v").cast("string").alias("attr_value"))


# --- B5: composite text key ----------------------------------------------------
@register("pair_key", sql=with_views(
    "select concat_ws(',',cast(user_id as varchar),cast(item_id as varchar)) pair_key,stars from candidates",
    "candidates"))
def q_pair_key(ctx: Ctx):
    return ctx.candidates.select(pair_key("user_id", "item_id").alias("pair_key"), "stars")


# --- F3: hash split ---------------------------------------------------------------
@register("split_halves", sql=with_views(
    f"select user_id,item_id,stars,case when {H()}%2=0 then 'A' else 'B' end half from ratings", "ratings"))
def q_split_halves(ctx: Ctx):
    return with_half(ctx.ratings)


# --- H10 (part): key-hash folds --------------------------------------------------
@register("cv_folds", sql=with_views(
    f"select {H(seed=1)}%5 fold,count(*) n,cast(sum(stars) as bigint) star_sum from half_a group by 1", "half_a"))
def q_cv_folds(ctx: Ctx):
    from sparkrec.operators.split import with_fold
    f = with_fold(ctx.half_a, 5, seed=1)
    return f.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.sum("stars").alias("star_sum"))


# --- D12: dedupe, latest wins (brand/type ratings) --------------------------------
@register("dedupe_latest", sql=with_views("select user_id,item_id,stars from ratings_bt", "ratings_bt"))
def q_dedupe_latest(ctx: Ctx):
    return fixtures.ratings_bt(ctx.spark, ctx.sf_dir)


# --- D1/D2: baskets -------------------------------------------------------------
def _basket_sql(key: str, other: str) -> str:
    return (f"select {key},count(*) n,round(sum(cast(stars as double)),6) total,"
            f"round(sum(cast(stars as double)*stars),6) total_sq,"
            f"cast(sum(cast('0x'||substr(md5(concat(cast({other} as varchar),':',cast(stars as varchar))),1,5) as bigint)) as bigint) digest,"
            f"cast(sum(cast('0x'||substr(md5(concat(cast({other} as varchar),':',cast(stars as varchar))),6,5) as bigint)) as bigint) digest2"
            f" from half_a group by {key}")


@register("user_baskets", sql=with_views(_basket_sql("user_id", "item_id"), "half_a"))
def q_user_baskets(ctx: Ctx):
    return round_doubles(B.baskets(ctx.half_a, "user_id", "item_id"))


@register("item_baskets", sql=with_views(_basket_sql("item_id", "user_id"), "half_a"))
def q_item_baskets(ctx: Ctx):
    return round_doubles(B.baskets(ctx.half_a, "item_id", "user_id"))


BASKET_SIZE = 16   # entries of a list at most


def _basket_list_sql(key: str, other: str) -> str:
    h = f"cast('0x'||substr(md5(concat(cast({other} as varchar),':7')),1,7) as int)"
    return (f"select {key},bucket,part,count(*) n,string_agg(concat({other},':',stars),',' order by {other}) entries from "
            f"(select *,cast((row_number() over (partition by {key},bucket order by {other})-1)//{BASKET_SIZE} as int) part from "
            f"(select h.*,cast({h}%greatest(1,cast(ceil(2.0*c.n/{BASKET_SIZE}) as int)) as int) bucket from half_a h "
            f"join (select {key} k,count(*) n from half_a group by 1) c on c.k=h.{key}) x) y group by {key},bucket,part")


def _basket_lists(ctx: Ctx, key: str, other: str):
    lists = B.basket_lists(ctx.half_a, key, other, size=BASKET_SIZE)
    text = F.transform("entries", lambda e: F.concat(e[other].cast("string"), F.lit(":"), e["stars"].cast("string")))
    return lists.select(key, "bucket", "part", "n", F.array_join(text, ",").alias("entries"))


@register("user_basket_lists", sql=with_views(_basket_list_sql("user_id", "item_id"), "half_a"))
def q_user_basket_lists(ctx: Ctx):
    return _basket_lists(ctx, "user_id", "item_id")


@register("item_basket_lists", sql=with_views(_basket_list_sql("item_id", "user_id"), "half_a"))
def q_item_basket_lists(ctx: Ctx):
    return _basket_lists(ctx, "item_id", "user_id")


# --- D3 ----------------------------------------------------------------------------
@register("candidates_per_item", sql=with_views(
    "select item_id,count(*) n_candidates,count(distinct user_id) n_users from candidates group by item_id",
    "candidates"))
def q_candidates_per_item(ctx: Ctx):
    return ctx.candidates.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_candidates"),
                                                 F.count_distinct("user_id").alias("n_users"))


# --- D4/E5 -------------------------------------------------------------------------
@register("center_ratings", sql=with_views(
    "select user_id,item_id,stars,round(m,6) item_mean,round(stars-m,6) centered from "
    "(select user_id,item_id,stars,avg(stars) over (partition by item_id) m from half_a) x", "half_a"))
def q_center_ratings(ctx: Ctx):
    return round_doubles(B.center_by_item(ctx.half_a).select("user_id", "item_id", "stars", "item_mean", "centered"))


# --- D5/D6 ---------------------------------------------------------------------------
@register("user_means", sql=with_views(
    "select c.user_id,round(coalesce(m.user_mean,2.5),6) user_mean,coalesce(m.user_count,0) user_count "
    "from (select distinct user_id from candidates) c left join "
    "(select user_id,avg(stars) user_mean,count(*) user_count from half_a group by user_id) m on m.user_id=c.user_id",
    "half_a", "candidates"))
def q_user_means(ctx: Ctx):
    m = B.user_means(ctx.half_a)
    c = ctx.candidates.select("user_id").distinct().join(m, "user_id", "left")
    return round_doubles(c.select("user_id", F.coalesce("user_mean", F.lit(B.UNKNOWN_USER_MEAN)).alias("user_mean"),
                                  F.coalesce("user_count", F.lit(0)).alias("user_count")))


@register("item_means", sql=with_views(
    "select item_id,round(avg(stars),6) item_mean,count(*) item_count from half_a group by item_id", "half_a"))
def q_item_means(ctx: Ctx):
    return round_doubles(B.item_means(ctx.half_a))


# --- D9/C11 ---------------------------------------------------------------------------
@register("training_counts", sql=with_views(
    "select c.user_id,c.item_id,coalesce(u.n,0) n_user,coalesce(i.n,0) n_item from candidates c "
    "left join (select user_id,count(*) n from half_a group by user_id) u on u.user_id=c.user_id "
    "left join (select item_id,count(*) n from half_a group by item_id) i on i.item_id=c.item_id",
    "half_a", "candidates"))
def q_training_counts(ctx: Ctx):
    return B.training_counts(ctx.candidates.select("user_id", "item_id"), ctx.half_a)


# --- D11 ------------------------------------------------------------------------------
@register("entity_counts", sql=with_views(
    "select count(*) n_ratings,count(distinct user_id) n_users,count(distinct item_id) n_items from half_a", "half_a"))
def q_entity_counts(ctx: Ctx):
    return B.entity_counts(ctx.half_a)


# --- D18 ------------------------------------------------------------------------------
@register("global_baseline", sql=with_views(
    "select distinct c.user_id,c.item_id,round(g.m,6) prediction from candidates c,(select avg(stars) m from half_a) g",
    "half_a", "candidates"))
def q_global_baseline(ctx: Ctx):
    g = B.global_mean(ctx.half_a)
    return round_doubles(attach_row(ctx.candidates.select("user_id", "item_id").distinct(), g)
                         .withColumnRenamed("global_mean", "prediction"))


# --- E3 -------------------------------------------------------------------------------
@register("dense_index", sql=with_views(
    "select user_id,row_number() over (order by user_id)-1 idx from (select distinct user_id from half_a) x", "half_a"))
def q_dense_index(ctx: Ctx):
    return B.dense_index(ctx.half_a, "user_id", "idx")


# --- C6/C7/C8 ---------------------------------------------------------------------------
@register("cold_users", sql=with_views(
    "select user_id,item_id from candidates where user_id not in (select user_id from half_a)", "half_a", "candidates"))
def q_cold_users(ctx: Ctx):
    return B.cold_users(ctx.candidates.select("user_id", "item_id"), ctx.half_a)


@register("cold_items", sql=with_views(
    "select user_id,item_id from candidates where item_id not in (select item_id from half_a)", "half_a", "candidates"))
def q_cold_items(ctx: Ctx):
    return B.cold_items(ctx.candidates.select("user_id", "item_id"), ctx.half_a)


@register("cold_start_route", sql=with_views(
    """select c.user_id,c.item_id,case when u.user_id is not null and i.item_id is not null then 'both_known'
 when u.user_id is not null then 'cold_item' when i.item_id is not null then 'cold_user' else 'both_cold' end route
 from candidates c left join (select distinct user_id from half_a) u on u.user_id=c.user_id
 left join (select distinct item_id from half_a) i on i.item_id=c.item_id""", "half_a", "candidates"))
def q_cold_start_route(ctx: Ctx):
    return B.cold_start_route(ctx.candidates.select("user_id", "item_id"), ctx.half_a)


# --- C4/C9/C3/D7/G6 and the weights: the parts of item-item CF ---------------------------
def _known_pairs(ctx: Ctx):
    c = ctx.candidates.select("user_id", "item_id").distinct()
    return (c.join(ctx.half_a.select("user_id").distinct(), "user_id", "left_semi")
            .join(ctx.half_a.select("item_id").distinct(), "item_id", "left_semi"))


def _part_sql(body: str, min_co=CF_MIN_CO) -> str:
    return with_views(body, "half_a", "candidates", extra=cf_sql(min_co=min_co))


@register("candidate_expand", sql=_part_sql("select user_id,item_id,other,r_other from cf_expand"))
def q_candidate_expand(ctx: Ctx):
    return itemcf.candidate_expand(_known_pairs(ctx), ctx.half_a)


@register("needed_pairs", sql=_part_sql("select x,y from cf_needed"))
def q_needed_pairs(ctx: Ctx):
    return itemcf.needed(_known_pairs(ctx), ctx.half_a)


@register("co_raters", sql=_part_sql(
    "select n.x,n.y,a.user_id from cf_needed n join half_a a on a.item_id=n.x "
    "join half_a b on b.item_id=n.y and b.user_id=a.user_id"))
def q_co_raters(ctx: Ctx):
    from sparkrec.operators.pairs import common_raters
    needed = itemcf.needed(_known_pairs(ctx), ctx.half_a)
    return common_raters(ctx.half_a, needed, "item_id", "user_id", []).select("x", "y", "user_id")


@register("co_rating_stats", sql=_part_sql(
    "select x,y,n_co,round(sab,6) sab,round(saa,6) saa,round(sbb,6) sbb from cf_st"))
def q_co_rating_stats(ctx: Ctx):
    # written, so what finds the pairs is off the disks before their sums are shuffled
    needed = materialize(itemcf.needed(_known_pairs(ctx), ctx.half_a), "needed-pairs")
    return round_doubles(itemcf.co_rating_stats(ctx.half_a, needed))


def _weights(ctx: Ctx, min_co=CF_MIN_CO, exact=True):
    """Weights of needed pairs, and whether they may be broadcast; ``exact`` as in ``frequent_needed``."""
    ist = itemcf.item_stats(ctx.half_a)
    needed, few = itemcf.frequent_needed(itemcf.candidate_expand(_known_pairs(ctx), ctx.half_a), ctx.half_a, min_co,
                                         ist.filter(F.col("item_count") >= min_co), exact=exact)
    return itemcf.weight_from_stats(itemcf.co_rating_stats(ctx.half_a, needed, ist, few=few), min_co, CF_P), few


@register("item_item_weights", sql=_part_sql(
    f"select x,y,n_co,round(weight,6) weight from cf_wa where n_co>={CF_MIN_CO}"))
def q_item_item_weights(ctx: Ctx):
    w = _weights(ctx)[0].filter(F.col("n_co") >= CF_MIN_CO)
    return round_doubles(w.select("x", "y", "n_co", "weight"))


@register("case_amplify", sql=_part_sql(
    f"select x,y,round(w0,6) w_raw,round(weight,6) weight from cf_wa where n_co>={CF_MIN_CO}"))
def q_case_amplify(ctx: Ctx):
    s = itemcf.weight_from_stats(_weights(ctx)[0].drop("weight"), CF_MIN_CO, 1.0)
    s = s.filter(F.col("n_co") >= CF_MIN_CO).withColumnRenamed("weight", "w_raw")
    return round_doubles(s.select("x", "y", "w_raw", amplify("w_raw", CF_P).alias("weight")))


@register("topk_neighbors", sql=with_views(
    "select user_id,item_id,other,round(weight,6) weight,cast(rank as integer) rank from cf_nb where rank<=20",
    "half_a", "candidates", extra=cf_sql()))
def q_topk_neighbors(ctx: Ctx):
    expand = itemcf.candidate_expand(_known_pairs(ctx), ctx.half_a)
    w, few = _weights(ctx, exact=False)
    w = itemcf.both_orientations(w).filter(F.col("weight") > 0)
    nb = expand.join(F.broadcast(w) if few else w, ["item_id", "other"])
    return round_doubles(itemcf.topk_neighbors(nb, 20).select("user_id", "item_id", "other", "weight", "rank"))


# --- C14/E6: one output per input line ------------------------------------------------
@register("score_writeback", sql=with_views(
    "select c.row_no,c.user_id,c.item_id,round(p.prediction,6) prediction from candidates c "
    "left join cf_pred p on p.user_id=c.user_id and p.item_id=c.item_id", "half_a", "candidates", extra=cf_sql()))
def q_score_writeback(ctx: Ctx):
    p = cf_predictions(ctx).select("user_id", "item_id", "prediction")
    out = ctx.candidates_rn.select("row_no", "user_id", "item_id").join(p, ["user_id", "item_id"], "left")
    return round_doubles(out.select("row_no", "user_id", "item_id", "prediction"))


# --- B12/B13/B14/H2 baseline --------------------------------------------------------------
BIAS_REG_ITEM, BIAS_REG_USER = 25.0, 10.0


def bias_sql(train="half_a", pairs="candidates", pre="bl"):
    return [
        (f"{pre}_g", f"select avg(stars) global_mean from {train}"),
        (f"{pre}_bi", f"select t.item_id,sum(t.stars-g.global_mean)/({BIAS_REG_ITEM}+count(*)) b_item "
                      f"from {train} t,{pre}_g g group by t.item_id"),
        (f"{pre}_bu", f"select t.user_id,sum(t.stars-g.global_mean-i.b_item)/({BIAS_REG_USER}+count(*)) b_user "
                      f"from {train} t join {pre}_bi i on i.item_id=t.item_id,{pre}_g g group by t.user_id"),
        (f"{pre}_pred", f"select c.user_id,c.item_id,g.global_mean+coalesce(u.b_user,0)+coalesce(i.b_item,0) baseline "
                        f"from (select distinct user_id,item_id from {pairs}) c cross join {pre}_g g "
                        f"left join {pre}_bu u on u.user_id=c.user_id left join {pre}_bi i on i.item_id=c.item_id"),
    ]


def bias_predictions(ctx: Ctx, pairs=None):
    g, bi, bu = B.bias_baseline(ctx.half_a, BIAS_REG_ITEM, BIAS_REG_USER)
    pairs = pairs if pairs is not None else ctx.candidates.select("user_id", "item_id").distinct()
    return B.bias_predict(pairs, g, bi, bu).select("user_id", "item_id", "baseline")


@register("bias_baseline", sql=with_views(
    "select user_id,item_id,round(baseline,6) baseline from bl_pred", "half_a", "candidates", extra=bias_sql()))
def q_bias_baseline(ctx: Ctx):
    return round_doubles(bias_predictions(ctx))


@register("clamp_predictions", sql=with_views(
    "select user_id,item_id,round(baseline,6) baseline,"
    "round(case when baseline>5.0 then 5.0 when baseline<1.0 then 1.0 else baseline end,6) clamp_1_5,"
    "round(case when baseline>5.0 then 5.0 when baseline<0.0 then 0.0 else baseline end,6) clamp_0_5 from bl_pred",
    "half_a", "candidates", extra=bias_sql()))
def q_clamp_predictions(ctx: Ctx):
    p = bias_predictions(ctx)
    return round_doubles(p.select("user_id", "item_id", "baseline", clamp("baseline", 1, 5).alias("clamp_1_5"),
                                  clamp("baseline", 0, 5).alias("clamp_0_5")))


@register("bias_calibrate", sql=with_views(
    "select p.user_id,p.item_id,round(p.baseline-k.c,6) prediction,round(k.c,6) offset_c from bl_pred p,"
    "(select avg(p.baseline-b.stars) c from bl_pred p join half_b b on b.user_id=p.user_id and b.item_id=p.item_id) k",
    "half_a", "half_b", "candidates", extra=bias_sql()))
def q_bias_calibrate(ctx: Ctx):
    from sparkrec.operators.calibrate import fit_offset, apply_offset
    p = bias_predictions(ctx)
    c = fit_offset(p, ctx.half_b, "baseline")
    return round_doubles(apply_offset(p, c, "baseline", "prediction").select(
        "user_id", "item_id", "prediction", F.col("offset").alias("offset_c")))


# --- B8-B11, C1, C2: profile features -----------------------------------------------------
def _share(col: str, parts: list[str]) -> str:
    tot = "+".join(parts)
    return f"round(case when ({tot})>0 then cast({col} as double)/({tot}) else cast({col} as double) end,6) u_{col}"


def _user_feature_sql(basic: bool) -> str:
    cols = ["user_id", "round(cast(average_stars as double),6) u_average_stars"]
    if not basic:
        cols.append("cast(review_count as double) u_review_count")
    cols += [_share(v, FE.VOTES) for v in FE.VOTES]
    cols.append("cast(fans as double) u_fans")
    cols += [_share(c, FE.COMPLIMENTS) for c in FE.COMPLIMENTS]
    return "select " + ",".join(cols) + " from user_profile"


PARSED_FALSE_SQL = ",".join(f"'{v}'" for v in FE.PARSED_FALSE)
PRESENCE_FALSE_SQL = ",".join(f"'{v}'" for v in FE.PRESENCE_FALSE_VALUES)


def _flag_sql(key: str, name: str, mode: str) -> str:
    path = f"'$.\"{key}\"'"
    v = f"json_extract_string(attributes,{path})"
    if key == "Alcohol":
        on = f"case when {v}='none' then 0.0 else 1.0 end"
    elif mode == "parsed":
        on = f"case when {v} is null or lower(trim({v})) in ({PARSED_FALSE_SQL}) then 0.0 else 1.0 end"
    else:
        text = f"json_type(attributes,{path})='VARCHAR'"
        on = f"case when {v} is null or ({text} and {v}='') or (not {text} and {v} in ({PRESENCE_FALSE_SQL})) then 0.0 else 1.0 end"
    return (f"cast(case when attributes is null then 0.5 when json_extract(attributes,{path}) is null then 0.5 "
            f"else {on} end as double) i_{name}")


def _item_feature_sql(basic: bool, mode: str = "parsed") -> str:
    cols = ["item_id", "cast(stars as double) i_stars", "cast(review_count as double) i_review_count"]
    if not basic:
        cols += [_flag_sql(k, n, mode) for k, n in zip(FE.FLAG_KEYS, FE.FLAG_NAMES)]
    return "select " + ",".join(cols) + " from item_profile"


@register("user_features", sql=with_views(_user_feature_sql(False), "user_profile"))
def q_user_features(ctx: Ctx):
    return round_doubles(FE.user_features(ctx.user_profile))


@register("user_features_basic", sql=with_views(_user_feature_sql(True), "user_profile"))
def q_user_features_basic(ctx: Ctx):
    return round_doubles(FE.user_features(ctx.user_profile, basic=True))


@register("item_features", sql=with_views(_item_feature_sql(False), "item_profile"))
def q_item_features(ctx: Ctx):
    return round_doubles(FE.item_features(ctx.item_profile))


@register("item_features_presence", sql=with_views(_item_feature_sql(False, "presence"), "item_profile"))
def q_item_features_presence(ctx: Ctx):
    return round_doubles(FE.item_features(ctx.item_profile, mode="presence"))


@register("item_features_basic", sql=with_views(_item_feature_sql(True), "item_profile"))
def q_item_features_basic(ctx: Ctx):
    return round_doubles(FE.item_features(ctx.item_profile, basic=True))


def _lookup_sql(view: str, key: str, names: list[str], defaults: dict, absent: float) -> str:
    cols = ["c.user_id", "c.item_id"]
    for n in names:
        d = float(defaults.get(n, absent))
        cols.append(f"cast(case when f.{key} is null then {d} else f.{n} end as double) {n}")
    return f"select {','.join(cols)} from (select distinct user_id,item_id from candidates) c left join ({view}) f on f.{key}=c.{key}"


@register("user_feature_lookup", sql=with_views(
    _lookup_sql(_user_feature_sql(False), "user_id", FE.USER_FEATURES, FE.USER_DEFAULT, 0.0),
    "user_profile", "candidates"))
def q_user_feature_lookup(ctx: Ctx):
    pairs = ctx.candidates.select("user_id", "item_id").distinct()
    return round_doubles(FE.user_lookup(pairs, ctx.user_profile))


@register("item_feature_lookup", sql=with_views(
    _lookup_sql(_item_feature_sql(False), "item_id", FE.ITEM_FEATURES, FE.ITEM_DEFAULT, FE.ABSENT),
    "item_profile", "candidates"))
def q_item_feature_lookup(ctx: Ctx):
    pairs = ctx.candidates.select("user_id", "item_id").distinct()
    return round_doubles(FE.item_lookup(pairs, ctx.item_profile))
