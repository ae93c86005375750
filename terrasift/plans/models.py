"""Named models and the inputs they need."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from terrasift.plans import staging as S
from terrasift.sources.writers import publish_view, write_ordered


@dataclass(frozen=True)
class Model:
    """A table computed from named inputs, which are tables or other models."""

    name: str
    layer: str
    tags: tuple[str, ...]
    inputs: tuple[str, ...]
    fn: Callable[..., DataFrame]
    order: tuple[str, ...] = ()


MODELS = {
    m.name: m
    for m in (
        Model("stg_county_boundary", "staging", ("gis", "staging", "reference"), ("gis.county_boundary",), S.stage_counties),
        Model("stg_state_boundary", "staging", ("gis", "staging", "reference"), ("gis.state_boundary",), S.stage_states),
        Model("int_county_lookup", "intermediate", ("gis", "reference", "lookup"), ("stg_county_boundary",), S.county_lookup, ("state_name", "county_name")),
        Model("int_state_lookup", "intermediate", ("gis", "reference", "lookup"), ("stg_state_boundary",), S.state_lookup, ("state_name",)),
        Model("health_facilities", "staging", ("staging", "health"), ("cleaned_data.health_facilities", "int_state_lookup", "int_county_lookup"), S.stage_health),
        Model("population_estimates", "staging", ("staging", "population", "reference"), ("cleaned_data.population_estimates_2024_clean",), S.stage_population),
        Model("education_facilities", "staging", ("staging", "education"), ("cleaned_data.education_facilities",), S.stage_education),
        Model("jiaf_south_sudan_2026_clean", "staging", ("staging", "jiaf"), ("cleaned_data.jiaf_south_sudan_2026_clean",), S.stage_needs),
    )
}


def build(name: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    """A model from its inputs; inputs that are models themselves are built on the way."""
    if name in tables:
        return tables[name]
    if name not in MODELS:
        raise KeyError(f"unknown table or model '{name}'")
    model = MODELS[name]
    return model.fn(*[build(i, tables) for i in model.inputs])


def materialise(name: str, tables: Mapping[str, DataFrame], database: str, location: str | None = None) -> None:
    """Staging models become views, lookups become ordered tables."""
    model, df = MODELS[name], build(name, tables)
    if model.layer == "staging":
        publish_view(df, name)
    else:
        write_ordered(df, f"{database}.{name}", *model.order, location=location)
