"""Names every model, its inputs and the function that builds it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date, datetime, time

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Params:
    """Job parameters; nothing in a model reads the wall clock."""

    as_of: date
    cost_per_mile: float = 1.85
    active_days: int = 90
    subtract_breaks: bool = False
    spine_start: date = date(2024, 1, 1)
    spine_years_ahead: int = 2
    now: datetime | None = None
    #: Whether tables that grow by the day are laid out by 'day' or, where a day is less than a file's worth, by 'month'.
    grain: str = "day"

    @property
    def moment(self) -> datetime:
        return self.now or datetime.combine(self.as_of, time.min)


@dataclass(frozen=True)
class Model:
    op_id: str
    name: str
    layer: str
    inputs: tuple[str, ...]
    build: Callable[..., DataFrame] = field(repr=False)

    @property
    def query_key(self) -> str:
        short = self.name
        for prefix in ("mart_",):
            short = short.removeprefix(prefix)
        return f"{self.op_id.replace('-', '').lower()}_{short}"


MODELS: dict[str, Model] = {}


def model(op_id: str, *inputs: str, name: str | None = None) -> Callable:
    """Register `fn(params, *input_frames) -> DataFrame` under its function name."""
    layer = {"S": "staging", "X": "intermediate", "M": "mart"}[op_id[0]]

    def register(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        entry = Model(op_id, name or fn.__name__, layer, inputs, fn)
        if entry.name in MODELS:
            raise ValueError(f"model {entry.name} is registered twice")
        MODELS[entry.name] = entry
        return fn

    return register
