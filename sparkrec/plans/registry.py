"""Registry of named queries: a Spark builder and, where one exists, the SQL twin."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from sparkrec.sources import fixtures


@dataclass
class Query:
    name: str
    build: Callable[["Ctx"], DataFrame]
    sql: str | None
    ratings: str = "supp"


QUERIES: dict[str, Query] = {}

# Queries that read the ratings many times: their rating view is written once.
READS_RATINGS_OFTEN = {
    "item_item_cf", "item_item_cf_k5", "item_item_cf_bt", "eval_report", "eval_report_long", "threshold_sweep", "slope_one",
    "slope_one_dev", "user_knn", "user_knn_blocks", "co_cluster", "co_cluster_full", "mf_predict", "mf_sgd", "switch_blend", "linear_blend", "linear_blend_pair",
    "item_item_weights", "case_amplify", "topk_neighbors", "co_rating_stats", "needed_pairs", "co_raters", "best_of_models",
    "score_writeback", "eval_rmse", "eval_bias", "eval_histogram", "eval_join", "eval_placeholder_filter",
    "stack_features", "gbt_profiles", "hybrid_stack", "hybrid_report", "tune", "tune_gbt"}


def register(name: str, sql: str | None = None, ratings: str = "supp"):
    def deco(fn):
        QUERIES[name] = Query(name, fn, sql, ratings)
        return fn
    return deco


class Ctx:
    """The inputs of one query run; each view is built once, lazily."""

    def __init__(self, spark: SparkSession, sf_dir: str, ratings: str = "supp", seed: int = 0,
                 materialize_inputs: bool = False):
        self.spark, self.sf_dir, self.ratings_name, self.seed = spark, sf_dir, ratings, seed
        self.materialize_inputs = materialize_inputs

    def table(self, name: str) -> DataFrame:
        return fixtures.table(self.spark, self.sf_dir, name)

    @cached_property
    def ratings(self) -> DataFrame:
        """The deduplicated rating view. Written once to a table in the checkpoint
        folder (``materialize_inputs``): the models read it many times, and a
        plain file scan is cheaper to re-read than the join + dedupe it comes
        from, and gives AQE true sizes."""
        r = fixtures.ratings(self.spark, self.sf_dir, self.ratings_name)
        if self.materialize_inputs:
            from sparkrec.session import materialize
            r = materialize(r, f"ratings-{self.ratings_name}")
        return r

    @cached_property
    def _halves(self):
        from sparkrec.operators.split import split_halves
        return split_halves(self.ratings, seed=self.seed)

    @property
    def half_a(self) -> DataFrame:
        return self._halves[0]

    @property
    def half_b(self) -> DataFrame:
        return self._halves[1]

    @cached_property
    def candidates(self) -> DataFrame:
        return fixtures.candidates(self.half_b, string_items=self.ratings_name == "bt")

    @cached_property
    def candidates_rn(self) -> DataFrame:
        return fixtures.candidates(self.half_b, string_items=self.ratings_name == "bt", row_no=True)

    @cached_property
    def user_profile(self) -> DataFrame:
        return fixtures.user_profile(self.spark, self.sf_dir, self.half_a)

    @cached_property
    def item_profile(self) -> DataFrame:
        return fixtures.item_profile(self.spark, self.sf_dir, self.half_a)


def run(spark: SparkSession, name: str, sf_dir: str) -> DataFrame:
    q = QUERIES[name]
    return q.build(Ctx(spark, sf_dir, q.ratings, materialize_inputs=name in READS_RATINGS_OFTEN))
