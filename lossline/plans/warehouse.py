"""The model graph: which function builds each table, from which tables, in which layer."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lossline.config import Config
from lossline.operators import features, intermediate, marts, reports, staging
from lossline.session import materialise

RAW = ("raw_policyholders", "raw_policies", "raw_claims", "raw_claim_payments", "raw_coverages")


@dataclass(frozen=True)
class Model:
    layer: str
    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]
    uses_config: bool = False
    keep: tuple[str, ...] = ()  # tables the model reads several times: written before it is built
    keep_columns: tuple[tuple[str, tuple[str, ...]], ...] = ()  # the same, but only the columns that are read


#: What the experience and the benchmarks read of the claims.
PRICED_CLAIMS = ("policy_id", "accident_date", "accident_year", "coverage_type", "total_paid", "incurred_amount")

MODELS: dict[str, Model] = {
    "stg_policyholders": Model("staging", ("raw_policyholders",), staging.stg_policyholders),
    "stg_policies": Model("staging", ("raw_policies",), staging.stg_policies),
    "stg_claims": Model("staging", ("raw_claims",), staging.stg_claims),
    "stg_claim_payments": Model("staging", ("raw_claim_payments",), staging.stg_claim_payments),
    "stg_coverages": Model("staging", ("raw_coverages",), staging.stg_coverages),
    "int_claims_enriched": Model(
        "intermediate", ("stg_claims", "stg_policies", "stg_coverages"), intermediate.int_claims_enriched, True
    ),
    "int_claim_payments_cumulative": Model(
        "intermediate",
        ("stg_claim_payments", "stg_claims", "stg_policies"),
        intermediate.int_claim_payments_cumulative,
    ),
    "int_policy_exposure": Model("intermediate", ("stg_policies",), intermediate.int_policy_exposure, True),
    "dim_date": Model(
        "marts", ("stg_claims", "stg_claim_payments"), lambda c, p, cfg: marts.dim_date(marts.calendar_span_of(c, p, cfg)), True
    ),
    "dim_policyholder": Model("marts", ("stg_policyholders",), marts.dim_policyholder, True),
    "dim_policy": Model("marts", ("stg_policies", "stg_coverages"), marts.dim_policy, True),
    "dim_coverage": Model("marts", ("stg_coverages",), marts.dim_coverage),
    "fct_claims": Model("marts", ("int_claims_enriched", "stg_claim_payments"), marts.fct_claims),
    "fct_claim_payments": Model("marts", ("int_claim_payments_cumulative",), marts.fct_claim_payments),
    "rpt_loss_triangle": Model("reports", ("fct_claim_payments",), reports.rpt_loss_triangle),
    "rpt_claim_frequency": Model("reports", ("fct_claims", "int_policy_exposure"), reports.rpt_claim_frequency),
    "feat_policy_experience": Model(
        "features", ("dim_policy", "int_policy_exposure", "fct_claims"), features.feat_policy_experience, True
    ),
    "feat_risk_segments": Model(
        "features",
        ("feat_policy_experience", "dim_policyholder"),
        features.feat_risk_segments,
    ),
    "feat_historical_benchmarks": Model(
        "features", ("rpt_claim_frequency",), features.feat_historical_benchmarks
    ),
    "model_training_set": Model(
        "training",
        ("feat_policy_experience", "feat_risk_segments", "dim_policy", "feat_historical_benchmarks"),
        features.model_training_set,
        True,
        keep=("feat_policy_experience",),
        keep_columns=(("fct_claims", PRICED_CLAIMS),),
    ),
}

LAYERS = ("staging", "intermediate", "marts", "reports", "features", "training")


def models_of(layer: str) -> list[str]:
    return [name for name, model in MODELS.items() if model.layer == layer]


class Warehouse(Mapping):
    """Tables by name. Each is composed lazily, once; Catalyst sees through all layers."""

    def __init__(self, tables: Mapping[str, DataFrame | Callable[[], DataFrame]], cfg: Config | None = None):
        self.cfg = cfg or Config()
        self._tables = dict(tables)
        self._kept: set[str] = set()
        self._narrow: dict[str, DataFrame] = {}

    def build(self, name: str) -> DataFrame:
        """Compose one model from the tables it reads."""
        model = MODELS[name]
        for table, columns in model.keep_columns:
            if table not in self._kept and table not in self._narrow:
                self._narrow[table] = materialise(self[table].select(*columns), table)
        for table in model.keep:
            self.keep(table)
        inputs = [self._narrow[i] if i in self._narrow and i not in self._kept else self[i] for i in model.inputs]
        return model.build(*inputs, self.cfg) if model.uses_config else model.build(*inputs)

    def __getitem__(self, name: str) -> DataFrame:
        given = self._tables.get(name)
        if given is None:
            self._tables[name] = self.build(name)
        elif callable(given):
            self._tables[name] = given()
        return self._tables[name]

    def keep(self, name: str, **options: str) -> DataFrame:
        """The table, written once to the shared folder for the passes that follow."""
        if name not in self._kept:
            self._tables[name] = materialise(self[name], name, **options)
            self._kept.add(name)
        return self._tables[name]

    def __setitem__(self, name: str, table: DataFrame) -> None:
        """Give a table that has been written elsewhere."""
        self._tables[name] = table
        self._kept.add(name)

    def __iter__(self):
        return iter([*RAW, *MODELS])

    def __len__(self) -> int:
        return len(RAW) + len(MODELS)

    def has(self, name: str) -> bool:
        """Whether the table is already there, given or built."""
        return name in self._tables

    @property
    def payment_development(self) -> DataFrame:
        """Payments by development period without running totals, for reports that need none."""
        if "payment_development" not in self._tables:
            self._tables["payment_development"] = intermediate.payment_development(
                self["stg_claim_payments"], self["stg_claims"], self["stg_policies"]
            )
        return self._tables["payment_development"]

    def register_views(self, spark: SparkSession, names: list[str] | None = None) -> None:
        """Expose tables to spark.sql as temporary views."""
        for name in names or list(MODELS):
            self[name].createOrReplaceTempView(name)
