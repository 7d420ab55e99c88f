"""Pipeline steps and the whole flow."""

from tierbed.plans.pipeline import (
    build_gold,
    build_silver,
    check_silver,
    ingest,
    open_silver,
    run_pipeline,
    silver_schema,
)
from tierbed.plans.places import GOLD_KEYS, PLACE_RULES, PLACE_SCHEMA, SILVER_PARTITIONS

__all__ = [
    "GOLD_KEYS",
    "PLACE_RULES",
    "PLACE_SCHEMA",
    "SILVER_PARTITIONS",
    "build_gold",
    "build_silver",
    "check_silver",
    "ingest",
    "open_silver",
    "run_pipeline",
    "silver_schema",
]
