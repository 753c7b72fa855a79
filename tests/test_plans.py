"""The whole plan from files to both results, against plain Python on a small world."""

from __future__ import annotations

import json
import math
import os
import statistics

import numpy as np
import pytest
from helpers import as_dict, plan
from pyspark.sql import functions as F

from tonnage.functions.units import MODEL_YEARS
from tonnage.operators import group_sum
from tonnage.plans import (
    base_year,
    capacity_total,
    country_intensity,
    driver,
    intensity_from_regions,
    intensity_from_stock,
    line_material,
    line_stock,
    mt_per_ej,
    own_capacity_intensity,
    read_inputs,
    region_intensity,
    region_material,
    run,
    source_comparison,
    tidy_stock,
    transformer_material,
)
from tonnage.plans.export import COEFFICIENTS, COSTS, export
from tonnage.plans.inputs import PREAMBLE, read_table

NOTES = ["# note one", '"# note, two"']

# A small world: four countries, two model regions, one country without capacity (D),
# one whose region of data set D has no lines (C), a total row and an unreadable row.
FILES = {
    "hierarchy": ["Country,K,D,ID", "A,K1,D1,1", "B,K1,D1,2", "C,K2,D2,2", "D,K2 ,D1,1"],
    "regions": ["ID,name", "1,North", "2,South"],
    "stock": [
        "Country,t,d,tt,dt,gt",
        "A,100,1000,10,20,5", "B,50,500,5,10,2", "C,80,800,8,16,4", "D,10,10,1,1,1",
        "Gone,-,-,-,-,-", "Total,240,2310,24,47,12",
    ],
    "line_mix": [
        "K,type,2017",
        'K1,OH <=220 kV,"3,000"', "K1,Cable <=220kV,1000", "K2,OH <=220 kV,600", "K2,OH >750 kV,200",
        "K3,OH <=220 kV,5",
    ],
    "capacity": ["Country,K,2017", "A,K1,10", "A,K1,10", "B,K1,5", "C,K2,8", "Elsewhere,K9,3"],
    "k_intensity": [
        "System,Component,type,mineral,intensity,unit",
        "transmission,transformer,,steel,700,t/GVA", "transmission,transformer,,copper,150,t/GVA",
        "distribution,transformer,,steel,1900,t/GVA", "distribution,transformer,,aluminium,410,t/GVA",
        "transmission,pylon,OH <=220 kV,steel,20,t/km", "transmission,conductor,OH <=220 kV,steel,2,t/km",
        "transmission,conductor,OH <=220 kV,aluminium,6,t/km", "transmission,pylon,OH >750 kV,steel,90,t/km",
        "transmission,conductor,OH > 750 kV,steel,9,t/km", "transmission,,Cable <=220 kV,copper,9,t/km",
        "distribution,,<=1 kV,copper,0.5,t/km", "distribution,,<=1 kV,aluminium,0.2,t/km",
        "distribution,,Cable 1-100 kV,copper,1.5,t/km", "distribution,,OH 1-100 kV,steel,1,t/km",
    ],
    "underground": ["D,income,HV,MV,LV", "D1,1000,10,40,60", "D2,1000,20,50,"],
    "line_length": [
        "D,Voltage," + ",".join(["km used in Study et al."] + [f"x{i}" for i in range(9)]),
        "D1,High,200," + "," * 8, "D1,Medium,900," + "," * 8, "D1,Low,3000,1" + "," * 8,
    ],
    "equipment": [
        "unit,Voltage,value", "substation,High,0.03", "transformer,High,0.06",
        "substation,Medium,0.07", "transformer,Medium,0.2", "substation,Low,0.9", "transformer,Low,1.5",
    ],
    "d_intensity": ["Component,mineral ,intensity,unit"] + [
        f"{v} {k},{m},{i * 100 + j * 10 + n},kg"
        for i, v in enumerate(("HV", "MV", "LV"), 1)
        for j, k in enumerate(("overhead", "underground", "transformer", "substation"))
        for n, m in enumerate(("steel", "aluminium", "copper"))
    ],
    "generation": [
        "Units,scenario,region,year,value", "EJ,Reference,North,2050,2", "EJ,Reference,North,2050,1",
        "EJ,Reference,South,2050,0.004", "EJ,Reference,South,2020,9", "EJ,Other,North,2050,77",
    ],
    "population": [
        "scenario,region,year,value", "Reference,North,2050,50", "Reference,South,2050,40",
        "Reference,South,2020,1", "Other,North,2050,1",
    ],
    "prices": ["mineral,unit,year,price"] + [
        f"{m},$/kg,{y},{p + (y - 2015) / 1000}"
        for m, p in (("steel", 0.1), ("aluminium", 0.49), ("copper", 1.45), ("tin", 3))
        for y in MODEL_YEARS
    ],
    "costs": ["sector,subsector,technology,input,year,cost"] + [
        f"{s},{s},{s},non-energy,{y},{c + (y - 2015) / 100}"
        for s, c in (("elect_td_bld", 9), ("elect_td_ind", 5), ("elect_td_trn", 7), ("gas", 1))
        for y in MODEL_YEARS
    ],
}


@pytest.fixture(scope="module")
def paths(tmp_path_factory):
    folder = tmp_path_factory.mktemp("inputs")
    out = {}
    for name, lines in FILES.items():
        notes = (NOTES * 4)[: PREAMBLE[name]]
        path = folder / f"{name}.csv"
        path.write_bytes("\r\n".join([*notes, *lines]).encode("utf-8-sig"))
        out[name] = str(path)
    return out


@pytest.fixture(scope="module")
def tables(spark, paths):
    return read_inputs(spark, paths)


def table(name: str) -> list[list[str]]:
    return [line.replace('"3,000"', "3000").split(",") for line in FILES[name][1:]]


# The same plan in plain Python, from the definitions.

PLACE = {c: (k.strip(), d, int(i)) for c, k, d, i in table("hierarchy")}
STOCK = {r[0]: [float(x) for x in r[1:]] for r in table("stock") if r[0] in PLACE}
GW = {"A": 20.0, "B": 5.0, "C": 8.0}
PCT_LV = {"D1": 60.0, "D2": 0.0}


def expected_k_tons() -> dict:
    mix, rate, per_gva = {}, {}, {}
    for k, kind, km in table("line_mix"):
        mix.setdefault(k, {})[kind] = float(km)
    for system, _, kind, mineral, x, _ in table("k_intensity"):
        box = rate if kind else per_gva
        key = (system, kind, mineral) if kind else (system, mineral)
        box[key] = box.get(key, 0) + float(x)
    tons = {}
    for c, (t, d, tt, dt, gt) in STOCK.items():
        k, d_region, _ = PLACE[c]
        km = {("transmission", kind): t * v / sum(mix[k].values()) for kind, v in mix[k].items()}
        cable = PCT_LV[d_region] * 0.01
        km["distribution", "<=1 kV"] = d * 0.63
        km["distribution", "Cable 1-100 kV"] = d * 0.37 * cable
        km["distribution", "OH 1-100 kV"] = d * 0.37 * (1 - cable)
        for (system, kind, mineral), x in rate.items():
            if (system, kind) in km:
                key = (c, "line", system, mineral)
                tons[key] = tons.get(key, 0) + km[system, kind] * x
        gva = {"transmission": tt + gt, "distribution": dt}
        for (system, mineral), x in per_gva.items():
            tons[c, "transformer", system, mineral] = gva[system] * x
    return tons


def expected_k() -> dict:
    out = {}
    for (c, _, _, mineral), v in expected_k_tons().items():
        if c in GW:
            out[c, mineral] = out.get((c, mineral), 0) + v / GW[c] / 1000
    return out


def expected_d_kg() -> dict:
    pct = {r[0]: dict(zip(("High", "Medium", "Low"), r[2:], strict=True)) for r in table("underground")}
    short = {"High": "HV", "Medium": "MV", "Low": "LV"}
    amounts = {}
    for r in table("line_length"):
        d, v, km = r[0], r[1], float(r[2])
        under = float(pct[d][v]) / 100
        amounts[d, f"{short[v]} overhead"] = km * (1 - under)
        amounts[d, f"{short[v]} underground"] = km * under
        for unit, voltage, n in table("equipment"):
            if voltage == v:
                amounts[d, f"{short[v]} {unit}"] = km * float(n)
    kg = {}
    for (d, component), v in amounts.items():
        for c, mineral, x, _ in table("d_intensity"):
            if c == component:
                kg[d, mineral] = kg.get((d, mineral), 0) + v * float(x)
    return kg


def expected_d() -> dict:
    out = {}
    for (d, mineral), kg in expected_d_kg().items():
        members = [c for c in GW if PLACE[c][1] == d]
        for c in members:
            out[c, mineral] = kg * (GW[c] / sum(GW[m] for m in members)) / (GW[c] * 1e6)
    return out


def expected_regions() -> dict:
    out = {}
    for source, values in (("K", expected_k()), ("D", expected_d())):
        for (c, mineral), v in values.items():
            i = PLACE[c][2]
            share = GW[c] / sum(GW[m] for m in GW if PLACE[m][2] == i)
            out[i, mineral, source] = out.get((i, mineral, source), 0) + v * share
    return out


def expected_coefficients() -> dict:
    line = {"steel": (-1.3, -0.41), "aluminium": (-1.5, -0.32), "copper": (-1.9, -0.47)}
    heads = {"North": 3 / 50 * 1000, "South": 0.004 / 40 * 1000}
    by_region = expected_regions()
    out = {}
    for i, region in ((1, "North"), (2, "South")):
        for mineral, (a, b) in line.items():
            used = [
                v for (r, m, s), v in by_region.items()
                if r == i and m == mineral and not (s == "D" and m == "copper")
            ]
            base = statistics.mean(used) * 1e-3 * 1e-6 / 8760 / (3.6e-3 * 1e-9)
            capped = min(base, math.exp(a + b * math.log(heads[region])))
            for y in MODEL_YEARS:
                out[region, mineral, y] = float(np.interp(y, [2015, 2050, 2100], [base, capped, capped]))
    return out


def expected_cost() -> dict:
    price = {(m, int(y)): float(p) for m, _, y, p in table("prices")}
    mineral_cost = {}
    for (region, mineral, y), v in expected_coefficients().items():
        key = (region, y)
        mineral_cost[key] = mineral_cost.get(key, 0) + v * price[mineral, y] * 0.13
    out = {}
    for sector, _, _, _, y, c in table("costs"):
        if sector.startswith("elect_td"):
            for region in ("North", "South"):
                own = mineral_cost[region, int(y)]
                middle = statistics.median(mineral_cost[r, int(y)] for r in ("North", "South"))
                out[region, sector, int(y)] = float(c) * own / middle - own
    return out


def close(want: dict) -> dict:
    return {k: pytest.approx(v, rel=1e-9) for k, v in want.items()}


def test_tidy_stock_drops_the_total_and_the_unreadable_row(tables):
    tidy = tidy_stock(tables.stock, tables.hierarchy)
    assert tidy.count() == 20
    assert {r.k_region for r in tidy.collect()} == {"K1", "K2"}


def test_line_and_transformer_material(tables):
    tidy = tidy_stock(tables.stock, tables.hierarchy)
    lines = line_stock(tidy, tables.line_mix, tables.underground)
    assert lines.where(F.col("country").isNull()).count() == 1  # a mix without a country
    want = expected_k_tons()
    for kind, material in (
        ("line", line_material(lines, tables.k_intensity)),
        ("transformer", transformer_material(tidy, tables.k_intensity)),
    ):
        got = as_dict(group_sum(material, ["country", "system", "mineral"], "value"), "value", "country", "system", "mineral")
        assert got == close({(c, s, m): v for (c, k, s, m), v in want.items() if k == kind})


def test_labels_that_differ_lose_their_material(tables):
    """No copper from the cable whose label lacks a space, and only pylons above 750 kV."""
    tidy = tidy_stock(tables.stock, tables.hierarchy)
    got = line_material(line_stock(tidy, tables.line_mix, tables.underground), tables.k_intensity)
    assert got.where("line_type like 'Cable <=220%'").count() == 0
    above = got.where("line_type like '%750%' and country = 'C'").collect()
    assert [(r.mineral, r.value) for r in above] == [("steel", 80 * 0.25 * 90)]


def test_country_intensities(tables):
    t = tables
    gw = capacity_total(t.capacity)
    k = intensity_from_stock(t.stock, t.line_mix, t.k_intensity, gw, t.hierarchy, t.underground)
    assert as_dict(k, "value", "country", "mineral") == close(expected_k())
    d = intensity_from_regions(t.line_length, t.underground, t.equipment, t.d_intensity, gw, t.hierarchy)
    got = as_dict(d, "value", "country", "mineral")
    assert got.pop(("C", None)) is None  # its region has no lines
    assert got == close(expected_d())
    for mineral in ("steel", "aluminium", "copper"):  # one value per region of data set D
        assert got["A", mineral] == pytest.approx(got["B", mineral])


def test_region_steps(tables):
    t = tables
    gw = capacity_total(t.capacity)
    by_region = region_intensity(country_intensity(t, gw), gw, t.hierarchy)
    want = expected_regions()
    wide = source_comparison(by_region.where(F.col("mineral").isNotNull()))
    for source in ("K", "D"):
        got = as_dict(wide, source, "region_id", "mineral")
        assert {k: v for k, v in got.items() if v is not None} == close(
            {(i, m): v for (i, m, s), v in want.items() if s == source}
        )
    base = as_dict(base_year(mt_per_ej(by_region)), "value", "region_id", "mineral")
    assert base[1, "copper"] == pytest.approx(want[1, "copper", "K"] * 1e-9 / 8760 / 3.6e-12)
    per_head = as_dict(driver(t.generation, t.population), "value", "scenario", "region")
    assert per_head == {
        ("Reference", "North"): pytest.approx(60.0), ("Reference", "South"): pytest.approx(0.1),
        ("Other", "North"): pytest.approx(77000.0),
    }


def test_both_results(tables):
    coefs, costs = run(tables)
    assert coefs.columns == ["region", "mineral", "year", "value"]
    assert as_dict(coefs, "value", "region", "mineral", "year") == close(expected_coefficients())
    assert as_dict(costs, "cost", "region", "supplysector", "year") == close(expected_cost())
    assert coefs.count() == 2 * 3 * 18
    assert "Python" not in plan(costs)


def test_a_capacity_of_zero_leaves_its_region_without_results(spark, paths, tmp_path):
    """0 / 0 and x / 0 are never capped to the projection, and a cost without its part is an error."""
    path = tmp_path / "capacity.csv"
    lines = [*(NOTES * 4)[: PREAMBLE["capacity"]], *FILES["capacity"], "D,K2,0"]
    path.write_bytes("\r\n".join(lines).encode("utf-8-sig"))
    coefs, costs = run(read_inputs(spark, paths | {"capacity": str(path)}))
    got = as_dict(coefs, "value", "region", "mineral", "year")
    minerals = {m for _, m, _ in got}
    assert all(got["North", m, y] is None for m in minerals for y in MODEL_YEARS)
    want = expected_coefficients()
    assert all(got["South", m, y] == pytest.approx(want["South", m, y]) for m in minerals for y in MODEL_YEARS)
    with pytest.raises(Exception, match="no match, or no value"):
        costs.collect()


def test_the_plan_stages_four_tables(tables, monkeypatch):
    from tonnage.sources import staging

    monkeypatch.setattr(staging, "_staged", [])
    _, costs = run(tables)
    costs.collect()
    assert len(staging._staged) == 4


def test_export_writes_both_tables(spark, paths, tmp_path):
    export(spark, paths, str(tmp_path / "out"))
    coefs = spark.read.csv(str(tmp_path / "out" / COEFFICIENTS), header=True)
    costs = spark.read.csv(str(tmp_path / "out" / COSTS), header=True)
    assert coefs.columns == ["region", "mineral", "year", "value"]
    assert costs.columns == [
        "region", "supplysector", "subsector", "stub.technology", "year", "input", "cost",
    ]
    got = {(r.region, r.mineral, int(r.year)): float(r.value) for r in coefs.collect()}
    assert got == close(expected_coefficients())
    assert costs.count() == 2 * 3 * 18


def test_own_capacity_variant(spark, tables):
    t = tables
    material = region_material(t.line_length, t.underground, t.equipment, t.d_intensity)
    mw = spark.createDataFrame([("D1", 4000.0)], "d_region string, mw double")
    got = as_dict(own_capacity_intensity(material, mw), "value", "d_region", "mineral")
    assert got == close({k: v / 4e6 for k, v in expected_d_kg().items()})


MANIFEST = os.environ.get("TONNAGE_INPUTS")

# Rows of the stages and totals in Mt, computed independently: of the small world above, and of
# the published tables, which TONNAGE_INPUTS may name as a JSON map of table to file.
SMALL = (
    [20, 21, 26, 16, 36],
    None,
)
PUBLISHED = (
    [885, 2124, 4248, 1062, 936],
    (
        {
            ("transmission", "steel"): 116.0319, ("transmission", "aluminium"): 71.9196,
            ("transmission", "copper"): 0.0004, ("distribution", "steel"): 189.8958,
            ("distribution", "aluminium"): 100.2097, ("distribution", "copper"): 239.1429,
        },
        {
            ("transmission", "steel"): 15.8956, ("transmission", "aluminium"): 2.4084,
            ("transmission", "copper"): 2.4084, ("distribution", "steel"): 41.3244,
            ("distribution", "aluminium"): 5.7854, ("distribution", "copper"): 5.7854,
        },
        {"steel": 251.3415, "aluminium": 146.0157, "copper": 32.5646},
    ),
)


def small_totals() -> tuple[dict, dict, dict]:
    sums = ({}, {}, {})
    for (_, kind, system, mineral), v in expected_k_tons().items():
        box = sums[kind == "transformer"]
        box[system, mineral] = box.get((system, mineral), 0) + v / 1e6
    for (_, mineral), v in expected_d_kg().items():
        sums[2][mineral] = sums[2].get(mineral, 0) + v / 1e9
    return tuple({k: round(v, 4) for k, v in s.items()} for s in sums)


def test_rows_and_totals_of_the_stages(spark, paths):
    files, (counts, totals) = (json.loads(open(MANIFEST).read()), PUBLISHED) if MANIFEST else (paths, SMALL)
    of_lines, of_transformers, of_regions = totals or small_totals()
    names = ("stock", "hierarchy", "line_mix", "underground", "k_intensity", "line_length", "equipment", "d_intensity")
    t = {name: read_table(spark, name, files[name]) for name in names}
    tidy = tidy_stock(t["stock"], t["hierarchy"])
    lines = line_stock(tidy, t["line_mix"], t["underground"])
    material = line_material(lines, t["k_intensity"])
    transformers = transformer_material(tidy, t["k_intensity"])
    regions = region_material(t["line_length"], t["underground"], t["equipment"], t["d_intensity"])
    found = [x.count() for x in (tidy, lines, material, transformers, regions)]
    assert found == counts

    def mt(df, *keys, unit):
        sums = df.groupBy(*keys).agg((F.sum("value") / unit).alias("mt"))
        return {k: round(v, 4) for k, v in as_dict(sums, "mt", *keys).items()}

    assert mt(material, "system", "mineral", unit=1e6) == of_lines
    assert mt(transformers, "system", "mineral", unit=1e6) == of_transformers
    assert mt(regions, "mineral", unit=1e9) == of_regions
