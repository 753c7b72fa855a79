"""The input tables of the material-intensity plan."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession

from tonnage.sources import read_annotated, schemas


@dataclass(frozen=True)
class Inputs:
    """One DataFrame per table, with the column names of `tonnage.sources.schemas`."""

    hierarchy: DataFrame
    regions: DataFrame
    stock: DataFrame
    line_mix: DataFrame
    capacity: DataFrame
    k_intensity: DataFrame
    underground: DataFrame
    line_length: DataFrame
    equipment: DataFrame
    d_intensity: DataFrame
    generation: DataFrame
    population: DataFrame
    prices: DataFrame
    costs: DataFrame


# Lines above the header in each file as published.
PREAMBLE = {
    "hierarchy": 0,
    "regions": 6,
    "stock": 7,
    "line_mix": 7,
    "capacity": 7,
    "k_intensity": 7,
    "underground": 7,
    "line_length": 7,
    "equipment": 7,
    "d_intensity": 7,
    "generation": 0,
    "population": 0,
    "prices": 0,
    "costs": 0,
}

TABLE_SCHEMAS = {name: getattr(schemas, name.upper()) for name in PREAMBLE}


def read_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """One input table from its annotated CSV file or folder."""
    return read_annotated(spark, path, TABLE_SCHEMAS[name], PREAMBLE[name])


def read_inputs(spark: SparkSession, paths: Mapping[str, str]) -> Inputs:
    """All input tables; `paths` gives a file or folder for each field of Inputs."""
    return Inputs(**{f.name: read_table(spark, f.name, paths[f.name]) for f in fields(Inputs)})
