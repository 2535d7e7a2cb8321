"""Resolves models to DataFrames, lazily or from built tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from tillhouse.operators import intermediate, labor, loyalty, promotion, sales, staging, stock, supply  # noqa: F401
from tillhouse.plans.day_tables import COMPRESSION, read_laid_out, reload_periods, write_laid_out
from tillhouse.plans.registry import MODELS, Model, Params
from tillhouse.sources.footers import footer_view

LAYERS = ("staging", "intermediate", "mart")

#: Tables that grow by the day, with the moment whose day or month (Params.grain) they are laid out by.
LAID_OUT = {
    "stg_pos_transactions": "transaction_dt",
    "stg_pos_transaction_items": "transaction_dt",
    "stg_timeclock_events": "event_dt",
}
#: Models built side by side; their jobs share the cluster.
AT_ONCE = 8


class Warehouse:
    """`raw` maps a raw table name such as 'raw_pos.transactions' to a DataFrame."""

    def __init__(self, raw: Callable[[str], DataFrame], params: Params):
        self.raw = raw
        self.params = params
        self._frames: dict[str, DataFrame] = {}
        self._built: dict[str, str] = {}

    def table(self, name: str) -> DataFrame:
        """The model as read from its table if it has been built, else as one lazy plan down to raw or built tables."""
        if name not in self._frames:
            self._frames[name] = self.raw(name) if name.startswith("raw_") else self.plan(name)
        return self._frames[name]

    def plan(self, name: str) -> DataFrame:
        """What the model computes from its inputs, whether or not it has been built itself."""
        entry = MODELS[name]
        return entry.build(self.params, *map(self.table, entry.inputs))

    def built(self, spark: SparkSession, root: str, name: str) -> DataFrame:
        """A raw table, or a model's table. What it needs and nobody has built yet is built first."""
        if not name.startswith("raw_") and name not in self._built:
            self.materialise(spark, root, [name], again=False)
        return self.table(name)

    def counted(self, spark: SparkSession, root: str, name: str) -> DataFrame:
        """A model's table for aggregates that the footers of its files answer; a raw table as it is."""
        frame = self.built(spark, root, name)
        return footer_view(spark, self._built[name], frame.schema) if name in self._built else frame

    def materialise(self, spark: SparkSession, root: str, names: Iterable[str] | None = None, again: bool = True) -> dict[str, str]:
        """Replace each model's table under `root`, inputs first, and read later models from those tables.

        Models whose inputs are all built are written side by side. With again=False, what this warehouse has built
        before stays.
        """
        written: dict[str, str] = {}

        def write(entry: Model) -> tuple[str, str, DataFrame]:
            path = f"{root}/{entry.layer}/{entry.name}"
            frame = self.plan(entry.name)
            if entry.name in LAID_OUT:
                write_laid_out(frame, path, LAID_OUT[entry.name], self.params.grain)
                return entry.name, path, read_laid_out(spark, path, frame.schema, self.params.grain)
            frame.write.mode("overwrite").parquet(path, compression=COMPRESSION)
            return entry.name, path, spark.read.schema(frame.schema).parquet(path)

        with ThreadPoolExecutor(AT_ONCE) as pool:
            for wave in build_waves(names):
                wave = [entry for entry in wave if again or entry.name not in self._built]
                for name in {i for entry in wave for i in entry.inputs}:
                    self.table(name)
                for name, path, frame in pool.map(write, wave):
                    self._frames[name] = frame
                    self._built[name] = path
                    written[name] = path
        return written

    def reload(self, root: str, name: str, first: date, last: date) -> None:
        """Compute a laid-out table anew for the periods of some days only; its other files stay as they are."""
        path = f"{root}/{MODELS[name].layer}/{name}"
        reload_periods(self.plan(name), path, LAID_OUT[name], first, last, self.params.grain)


def shared_models() -> set[str]:
    """Enriched facts and marts with several readers."""
    readers: dict[str, int] = {}
    for entry in MODELS.values():
        for name in entry.inputs:
            readers[name] = readers.get(name, 0) + 1
    return {name for name, count in readers.items() if count > 1 and name in MODELS and MODELS[name].layer != "staging"}


def build_order(names: Iterable[str] | None = None) -> list[Model]:
    """The requested models (all by default) and what they need, inputs before readers."""
    ordered: dict[str, Model] = {}

    def visit(name: str) -> None:
        if name.startswith("raw_") or name in ordered:
            return
        for dependency in MODELS[name].inputs:
            visit(dependency)
        ordered[name] = MODELS[name]

    for name in MODELS if names is None else names:
        visit(name)
    return list(ordered.values())


def build_waves(names: Iterable[str] | None = None) -> list[list[Model]]:
    """The build order in groups whose members don't need each other."""
    depth: dict[str, int] = {}
    waves: list[list[Model]] = []
    for entry in build_order(names):
        depth[entry.name] = max((depth[i] + 1 for i in entry.inputs if i in depth), default=0)
        while len(waves) <= depth[entry.name]:
            waves.append([])
        waves[depth[entry.name]].append(entry)
    return waves
