"""Run the model layers in order, write every table, and record rows, seconds and errors."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from lossline.config import Config
from lossline.plans.warehouse import LAYERS, MODELS, RAW, Warehouse, models_of


CONCURRENT_TABLES = 4


@dataclass
class LayerRun:
    layer: str
    tables: dict[str, int] = field(default_factory=dict)
    seconds: dict[str, float] = field(default_factory=dict)
    errors: dict[str, str] = field(default_factory=dict)


@dataclass
class Run:
    """Result of a run; stopped after the first layer with an error."""

    layers: list[LayerRun] = field(default_factory=list)
    seconds: float = 0.0

    @property
    def success(self) -> bool:
        return not any(layer.errors for layer in self.layers)

    @property
    def error_message(self) -> str | None:
        for layer in self.layers:
            if layer.errors:
                return f"errors in layer {layer.layer}: " + "; ".join(f"{t}: {e}" for t, e in layer.errors.items())
        return None

    def row_count(self, table: str) -> int:
        """Rows written to a table, -1 if the run did not write it."""
        for layer in self.layers:
            if table in layer.tables:
                return layer.tables[table]
        return -1

    def as_table(self, spark: SparkSession) -> DataFrame:
        rows = []
        for layer in self.layers:
            rows += [(layer.layer, t, n, layer.seconds[t], None) for t, n in layer.tables.items()]
            rows += [(layer.layer, t, None, layer.seconds.get(t, 0.0), e) for t, e in layer.errors.items()]
        return spark.createDataFrame(
            rows, "layer string, table_name string, row_count bigint, seconds double, error string"
        )


def _write(table: DataFrame, path: str) -> tuple[DataFrame, int]:
    """Replace a table; the rows are counted while they are written. zstd files are smaller than Spark's usual ones."""
    seen = Observation()
    table.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option("compression", "zstd").parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path), seen.get["rows"]


def _run_table(warehouse: Warehouse, name: str, path: str) -> tuple[DataFrame | None, int, str | None, float]:
    """Write one table: (table, rows, error, seconds)."""
    begun = time.monotonic()
    table, rows, error = None, -1, None
    absent = [i for i in MODELS[name].inputs if not warehouse.has(i)] if name in MODELS else []
    if name not in MODELS:
        error = "unknown table"
    elif absent:
        error = "missing upstream tables: " + ", ".join(absent)
    else:
        try:
            table, rows = _write(warehouse.build(name), path)
        except (PySparkException, ValueError) as failure:
            error = str(failure).splitlines()[0]
    return table, rows, error, round(time.monotonic() - begun, 3)


def run_layer(warehouse: Warehouse, layer: str, folder: str, tables: Sequence[str] | None = None) -> LayerRun:
    """Write the tables of one layer. A table whose inputs are missing is an error of its own.

    Tables that do not read each other are submitted together, so that the short tail of
    one job leaves its cores to the next.
    """
    run = LayerRun(layer)
    if layer not in LAYERS:
        run.errors[layer] = f"unknown layer: {layer}"
        return run
    pending = list(tables or models_of(layer))
    while pending:
        wave = [n for n in pending if n not in MODELS or not set(MODELS[n].inputs) & set(pending)]
        pending = [n for n in pending if n not in wave]
        with ThreadPoolExecutor(CONCURRENT_TABLES) as pool:
            results = list(pool.map(lambda n: _run_table(warehouse, n, f"{folder}/{layer}/{n}"), wave))
        for name, (table, rows, error, seconds) in zip(wave, results):
            run.seconds[name] = seconds
            if error:
                run.errors[name] = error
            else:
                warehouse[name], run.tables[name] = table, rows
    return run


def run_layers(
    raw: Mapping[str, DataFrame | Callable[[], DataFrame]],
    cfg: Config,
    folder: str,
    layers: Sequence[str] = LAYERS,
) -> Run:
    """Full refresh of the layers, in order. Each table is read back by the next layers."""
    absent = [name for name in RAW if name not in raw]
    run = Run()
    begun = time.monotonic()
    if absent:
        run.layers.append(LayerRun("raw", errors={name: "raw table is missing" for name in absent}))
        return run
    warehouse = Warehouse(raw, cfg)
    for layer in layers:
        run.layers.append(run_layer(warehouse, layer, folder))
        if run.layers[-1].errors:
            break
    run.seconds = round(time.monotonic() - begun, 3)
    return run
