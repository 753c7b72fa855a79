"""Run the plan on files and write its two result tables as CSV.

    spark-submit tonnage/plans/export.py inputs.json results/ [partitions]

inputs.json maps each table of `tonnage.plans.inputs.Inputs` to a file or folder; partitions
is the number that shuffles start with (see `tonnage.session.PARTITIONS`).
"""

from __future__ import annotations

import json
import sys
from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import SparkSession

from tonnage.plans.inputs import PREAMBLE, read_inputs
from tonnage.plans.regional import run
from tonnage.session import PARTITIONS, SETTINGS
from tonnage.sources import read_header, write_csv
from tonnage.sources.staging import release

COEFFICIENTS = "material_coefficients"
COSTS = "nonmaterial_costs"


def export(spark: SparkSession, paths: Mapping[str, str], folder: str) -> None:
    """Write both tables; cost columns keep the spelling of the cost file."""
    coefs, costs = run(read_inputs(spark, paths))
    header = read_header(spark, paths["costs"], PREAMBLE["costs"])
    names = {
        "stub_technology": "stub.technology",
        "cost_input": header[3],
        "cost": header[5],
    }
    write_csv(coefs, f"{folder}/{COEFFICIENTS}")
    write_csv(costs, f"{folder}/{COSTS}", names)


def main() -> None:
    manifest, folder, *partitions = sys.argv[1:]
    builder = SparkSession.builder.appName("tonnage-export")
    for key, value in (SETTINGS | dict.fromkeys([PARTITIONS] * bool(partitions), *partitions)).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    export(spark, json.loads(Path(manifest).read_text(encoding="utf8")), folder)
    release(spark)
    spark.stop()


if __name__ == "__main__":
    main()
