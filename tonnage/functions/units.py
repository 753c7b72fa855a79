"""Unit factors, paths between units, and the model's year grid."""

from __future__ import annotations

from collections import deque
from fractions import Fraction
from functools import cache

# Multiply an amount in the first unit by the factor to get the second.
# The way back is the reciprocal. Units that are linked, however far, measure one thing.
FACTORS: dict[tuple[str, str], float] = {
    # Plain numbers.
    ("billion", "million"): 1000.0,
    ("million", "thousand"): 1000.0,
    ("thousand", "one"): 1000.0,
    # Mass.
    ("t", "kg"): 1e3,
    ("kg", "g"): 1e3,
    ("Mt", "t"): 1e6,
    ("Mt", "kt"): 1e3,
    ("Tg", "kg"): 1e9,
    ("Tg", "Gg"): 1e3,
    ("t", "short t"): 1000 / 908,
    # Time.
    ("year", "day"): 365.25,
    ("day", "h"): 24.0,
    # Power, and the energy of a year at full load.
    ("GW", "kW"): 1e6,
    ("GW", "MW"): 1e3,
    ("kW", "kWh/year"): 8760.0,
    # Energy.
    ("kWh", "GJ"): 3.6e-3,
    ("MWh", "GJ"): 3.6,
    ("GWh", "EJ"): 3.6e-6,
    ("TWh", "EJ"): 3.6e-3,
    ("EJ", "GJ"): 1e9,
    ("EJ", "MJ"): 1e12,
    ("MJ", "kJ"): 1e3,
    ("Btu", "kJ"): 1.0551,
    ("kBtu", "EJ"): 1.0551e-12,
    ("TBtu", "EJ"): 0.0010551,
    ("kg H2", "GJ"): 0.12021,
    # Fuel oil by its energy.
    ("t RFO", "bbl RFO"): 6.66,
    ("t distillate", "bbl distillate"): 7.46,
    ("t RFO", "GJ"): 40.87,
    ("t distillate", "GJ"): 42.91,
    # Length.
    ("mile", "km"): 1.60934,
    ("nmile", "km"): 1.852,
    # Area.
    ("ha", "m2"): 1e4,
    ("bm2", "m2"): 1e9,
    ("ft2", "m2"): 0.0929,
    ("million ft2", "m2"): 92900.0,
    ("m2", "acre"): 0.0002471058,
    # Volume.
    ("bm3", "m3"): 1e9,
    ("million m3", "m3"): 1e6,
    ("km3", "million m3"): 1e3,
    ("gal", "m3"): 0.00378541,
}

# The base year and the five-year future grid.
BASE_YEAR = 2015
FUTURE_YEARS = tuple(range(2020, 2101, 5))
MODEL_YEARS = (BASE_YEAR, *FUTURE_YEARS)

# Hours at full load in a year, and the charge rate that levelises a capital cost.
FULL_LOAD_HOURS = 8760.0
FIXED_CHARGE_RATE = 0.13


@cache
def _neighbours() -> dict[str, list[str]]:
    near: dict[str, list[str]] = {}
    for a, b in FACTORS:
        near.setdefault(a, []).append(b)
        near.setdefault(b, []).append(a)
    return near


def listed_units() -> set[str]:
    """All units that have a factor of their own."""
    return set(_neighbours())


@cache
def _came_from(unit: str) -> dict[str, str]:
    """For each unit that can be reached, the one before it on a shortest way from unit."""
    before, open_ = {unit: unit}, deque([unit])
    while open_:
        at = open_.popleft()
        for near in _neighbours()[at]:
            if near not in before:
                before[near] = at
                open_.append(near)
    return before


def unit_path(from_unit: str, to_unit: str) -> list[str]:
    """The units on a way with the fewest steps; of several such ways the one listed first.

    An unknown unit, and a pair that no chain of factors links, is an error: they measure
    different things.
    """
    if unknown := [u for u in (from_unit, to_unit) if u not in _neighbours()]:
        raise ValueError(f"no factor for {unknown}")
    before = _came_from(from_unit)
    if to_unit not in before:
        raise ValueError(f"{from_unit} and {to_unit} measure different things: no factors lead from one to the other")
    way = [to_unit]
    while way[-1] != from_unit:
        way.append(before[way[-1]])
    return way[::-1]


def _step(a: str, b: str) -> Fraction:
    """The factor as it is written: a decimal number, or the reciprocal of one."""
    if (a, b) in FACTORS:
        return Fraction(repr(FACTORS[(a, b)]))
    return 1 / Fraction(repr(FACTORS[(b, a)]))


def factor(from_unit: str, to_unit: str) -> float:
    """Multiplier from one unit to another, over as many steps as it takes.

    A unit with a stroke that is not listed itself, such as kg/kW, goes part by part: the parts
    below the stroke divide. Steps are multiplied as fractions, so the result is the nearest
    double whatever the way.
    """
    return float(_exact(from_unit, to_unit))


def _exact(from_unit: str, to_unit: str) -> Fraction:
    listed = _neighbours()
    parts = from_unit.split("/"), to_unit.split("/")
    if len(parts[0]) == len(parts[1]) > 1 and not (from_unit in listed and to_unit in listed):
        out = _exact(parts[0][0], parts[1][0])
        for a, b in zip(parts[0][1:], parts[1][1:], strict=True):
            out /= _exact(a, b)
        return out
    way = unit_path(from_unit, to_unit)
    out = Fraction(1)
    for a, b in zip(way[:-1], way[1:], strict=True):
        out *= _step(a, b)
    return out


def factors_to(to_unit: str) -> dict[str, float]:
    """The factor of every listed unit that measures the same as to_unit, itself included."""
    if to_unit not in _neighbours():
        raise ValueError(f"no factor for {to_unit}")
    return {unit: factor(unit, to_unit) for unit in sorted(_came_from(to_unit))}
