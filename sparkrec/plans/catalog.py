"""Imports every query module so the registry is complete."""

from sparkrec.plans import q_blend, q_core, q_data, q_eval, q_learn, q_models  # noqa: F401
from sparkrec.plans.registry import QUERIES, Ctx, run  # noqa: F401
