"""Named query registry: ``key -> fn(tables) -> DataFrame``; the keys are those of ``queries()``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from trestle.sources.tables import Tables

REGISTRY: dict[str, Callable[[Tables], DataFrame]] = {}


def query(key: str):
    def register(fn):
        if key in REGISTRY:
            raise ValueError(f"duplicate query key {key}")
        REGISTRY[key] = fn
        return fn

    return register


def load_all() -> dict[str, Callable[[Tables], DataFrame]]:
    import trestle.plans.queries  # noqa: F401  (registers everything)

    return REGISTRY


def as_driver_callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def wrap(fn):
        return lambda spark, sf_dir: fn(Tables(spark, sf_dir))

    return {k: wrap(fn) for k, fn in load_all().items()}
