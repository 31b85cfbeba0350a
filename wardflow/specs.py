"""Registry of facts, dimensions and named queries: the extension points of the package."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from .functions.calendar import KeyMapping
from .operators.clean import CHART_KEYS, MICRO_KEYS, clean_chart_events, clean_micro_events
from .schemas import SOURCE_DDL, WAREHOUSE_DDL


@dataclass(frozen=True)
class FactSpec:
    """How one event stream becomes a fact table."""

    name: str
    table: str
    source_ddl: str
    target_ddl: str
    clean: Callable[..., DataFrame]
    keys: tuple[str, ...]
    event_time: str
    mappings: tuple[KeyMapping, ...]
    required: tuple[str, ...]
    partition_key: str
    sampling_method: str = "none"
    sampling_rate: float = 0.1


@dataclass(frozen=True)
class DimSpec:
    """How source files become a dimension or an interval fact."""

    table: str
    sources: dict[str, str]
    target_ddl: str
    pk: tuple[str, ...]
    mappings: tuple[KeyMapping, ...] = ()
    build: Callable[..., DataFrame] | None = field(default=None)
    surrogates: tuple[str, ...] = ()


FACTS: dict[str, FactSpec] = {}
DIMS: dict[str, DimSpec] = {}
QUERIES: dict[str, Callable] = {}


def register_fact(spec: FactSpec) -> FactSpec:
    FACTS[spec.name] = spec
    return spec


def register_dim(spec: DimSpec) -> DimSpec:
    DIMS[spec.table] = spec
    return spec


def register_query(name: str, fn: Callable | None = None):
    """Register a ``(spark, path) -> DataFrame`` callable; usable as a decorator."""
    if fn is None:
        return lambda f: register_query(name, f)
    QUERIES[name] = fn
    return fn


def _chart_times(*names: str) -> tuple[KeyMapping, ...]:
    return tuple(KeyMapping.of(n) for n in names)


register_fact(
    FactSpec(
        name="icu_chartevents",
        table="fact_chartevents",
        source_ddl=SOURCE_DDL["chartevents"],
        target_ddl=WAREHOUSE_DDL["fact_chartevents"],
        clean=clean_chart_events,
        keys=CHART_KEYS,
        event_time="charttime",
        mappings=_chart_times("charttime"),
        required=("subject_id", "itemid", "charttime_date", "charttime_time"),
        partition_key="stay_id",
    )
)
register_fact(
    FactSpec(
        name="hosp_microbiologyevents",
        table="fact_microbiologyevents",
        source_ddl=SOURCE_DDL["microbiologyevents"],
        target_ddl=WAREHOUSE_DDL["fact_microbiologyevents"],
        clean=clean_micro_events,
        keys=MICRO_KEYS,
        event_time="charttime",
        mappings=_chart_times("charttime"),
        required=("subject_id", "charttime_date", "charttime_time"),
        partition_key="subject_id",
    )
)


def _diagnoses(diagnoses_icd: DataFrame, d_icd_diagnoses: DataFrame) -> DataFrame:
    from .operators.star import diagnosis_dim

    return diagnosis_dim(diagnoses_icd, d_icd_diagnoses)


def _simple_dim(table: str, source: str, *pk: str, times: tuple[str, ...] = ()) -> None:
    register_dim(
        DimSpec(
            table=table,
            sources={source: SOURCE_DDL[source]},
            target_ddl=WAREHOUSE_DDL[table],
            pk=pk,
            mappings=_chart_times(*times),
        )
    )


_simple_dim("dim_d_items", "d_items", "itemid")
_simple_dim("dim_patients", "patients", "subject_id")
_simple_dim("dim_triage", "triage", "stay_id")
_simple_dim(
    "dim_admission",
    "admissions",
    "hadm_id",
    times=("admittime", "dischtime", "deathtime", "edregtime", "edouttime"),
)
_simple_dim("fact_icustays", "icustays", "stay_id", times=("intime", "outtime"))
_simple_dim("fact_edstays", "edstays", "stay_id", times=("intime", "outtime"))
register_dim(
    DimSpec(
        table="dim_diagnoses_icd",
        sources={
            "diagnoses_icd": SOURCE_DDL["diagnoses_icd"],
            "d_icd_diagnoses": SOURCE_DDL["d_icd_diagnoses"],
        },
        target_ddl=WAREHOUSE_DDL["dim_diagnoses_icd"],
        pk=("icd_code", "icd_version"),
        build=_diagnoses,
        surrogates=("diagnoses_icd_key",),
    )
)
