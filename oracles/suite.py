"""The check query of every registered Spark query that plain SQL can express."""

from __future__ import annotations

from oracles import reports
from oracles.base import BASE
from oracles.models import HELPERS, MODELS_SQL
from oracles.sql import with_tables
from oracles.staging import STAGING
from tillhouse.plans.registry import MODELS

MODEL_TEXTS: dict[str, str] = {**STAGING, **MODELS_SQL}
TABLES: dict[str, str] = {**BASE, **HELPERS, **{f"t_{name}": text for name, text in MODEL_TEXTS.items()}}


def all_sql() -> dict[str, str]:
    texts = {entry.query_key: MODEL_TEXTS[entry.name] for entry in MODELS.values() if entry.name in MODEL_TEXTS}
    texts["m42_time_spine"] = reports.SPINE_SQL
    texts |= reports.metrics_sql()
    texts |= reports.dashboards_sql()
    texts |= reports.quality_sql()
    texts |= reports.ingest_sql(MODEL_TEXTS["mart_daily_revenue"])
    return {key: with_tables(text, TABLES) for key, text in texts.items()}
