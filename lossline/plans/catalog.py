"""Every query by name, with the DuckDB SQL that must give the same rows where there is one."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from lossline import session
from lossline.config import Config
from lossline.plans.warehouse import Warehouse
from lossline.sources import projection


class Data:
    """What a query may read: the raw tables of one folder and the models above them."""

    def __init__(self, spark: SparkSession, folder: str, cfg: Config = projection.PROJECTION_CONFIG):
        self.spark = session.configure(spark)
        self.folder = folder
        self.cfg = cfg
        self.models = Warehouse(projection.raw_tables(spark, folder), cfg)

    def __getitem__(self, name: str) -> DataFrame:
        return self.models[name]

    def source(self, name: str) -> DataFrame:
        return projection.load(self.spark, self.folder, name)

    @property
    def development(self) -> DataFrame:
        return self.models.payment_development

    @cached_property
    def events(self) -> DataFrame:
        return projection.raw_claim_events(self.source("events"))

    def scratch(self, name: str) -> str:
        return session.work_path(self.spark, name)


_QUERIES: dict[str, Callable[[Data], DataFrame]] = {}
_ORACLE: dict[str, str] = {}


def add(name: str, build: Callable[[Data], DataFrame], oracle: str | None = None) -> None:
    if name in _QUERIES:
        raise ValueError(f"query {name} is registered twice")
    _QUERIES[name] = build
    if oracle is not None:
        _ORACLE[name] = oracle


def present(df: DataFrame) -> DataFrame:
    """Money as double, days and instants as text: values two engines print alike."""
    columns = []
    for field in df.schema.fields:
        kind, col = field.dataType.typeName(), F.col(f"`{field.name}`")
        if kind == "decimal":
            col = col.cast("double")
        elif kind == "date":
            col = col.cast("string")
        elif kind in ("timestamp", "timestamp_ntz"):
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
        columns.append(col.alias(field.name))
    return df.select(*columns)


def _run(build: Callable[[Data], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: present(build(Data(spark, folder)))


def _load() -> None:
    # Always: one of them may have been imported by itself before.
    from lossline.plans import (  # noqa: F401  (each registers its queries)
        queries_warehouse,
        queries_pricing,
        queries_events,
        queries_quality,
        queries_tables,
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return {name: _run(build) for name, build in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLE)
