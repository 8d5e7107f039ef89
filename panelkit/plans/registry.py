"""Query registry: name -> (Spark builder, DuckDB oracle SQL or None).

Every builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole driver tables. Oracle SQL is written against the pre-registered views
and aliases every column to the Spark name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def load_all() -> dict[str, tuple[Builder, str | None]]:
    # Importing the modules fills the registry.
    from panelkit.plans import q_core, q_profile, q_text, q_features, q_extensions, q_grid, q_models, q_sources, lake  # noqa: F401
    return REGISTRY
