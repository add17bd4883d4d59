"""Rules from a report standard: the JSON files in which an operator keeps limits, labels and switches.

A standard has an ``analysis_type`` and a ``rules`` object; ``rules_from_standards`` takes one for
each analysis (any of them may be missing) and gives the ``Rules`` of all reports. Entries that
change nothing in a result (sheet order, styles, notes) are left alone; one that has a meaning
here but a wrong form raises a ``ValueError`` that names it.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import SparkSession

from bidscope.plans.request import ANALYSES, Rules

_RANGE = r"\s*(-?\d+(?:\.\d+)?)\s*[–~-]\s*(-?\d+(?:\.\d+)?)"


def _limit(value) -> int:
    if isinstance(value, bool) or not isinstance(value, int) or value < 0:
        raise ValueError("a number of rows is expected")
    return value


def _switch(value) -> bool:
    if not isinstance(value, bool):
        raise ValueError("true or false is expected")
    return value


def _slots(value) -> dict[int, str]:
    return {int(k): str(v) for k, v in value.items()}


def _box(value) -> tuple:
    found = [re.search(name + _RANGE, value) for name in ("geo_lat", "geo_lon")]
    if not all(found):
        raise ValueError("ranges of geo_lat and geo_lon are expected")
    return tuple(float(x) for f in found for x in f.groups())


def price_bounds(labels: list[str]) -> tuple[float, ...]:
    """Upper bounds of price bucket labels ``a``, ``a-b``, ``b-c``, ..., ``z+``; each bucket begins where the last one ends."""
    bounds: list[float] = []
    for i, label in enumerate(labels):
        parts = re.fullmatch(r"(?:(\d+(?:\.\d+)?)-)?(\d+(?:\.\d+)?)(\+?)", label)
        if not parts or bool(parts[3]) != (i == len(labels) - 1):
            raise ValueError(f"{label!r} is no price bucket at place {i + 1}")
        low, high = parts[1], float(parts[2])
        begins = float(low) if low else (high if parts[3] else None)
        if begins != (bounds[-1] if bounds else None) or not parts[3] and bounds and high <= bounds[-1]:
            raise ValueError(f"{label!r} does not begin where the bucket before it ends")
        if not parts[3]:
            bounds.append(high)
    return tuple(bounds)


# Entries of each analysis' standard that change results: the rule they set, and how they are read.
_ENTRIES: dict[str, dict[str, tuple[str, Callable]]] = {
    "basic": {"app_top_n": ("app_top_n", _limit), "cross_table_limit": ("cross_limit", _limit),
              "drop_zero_bid_hours": ("drop_zero_bid_hours", _switch),
              "landing_page_requires_click": ("landing_page_requires_click", _switch)},
    "spend": {"adviewtype_mapping": ("ad_slot_names", _slots), "top_app_n": ("spend_app_rows", _limit),
              "top_region_n": ("spend_region_rows", _limit), "top_order_strategy_material_n": ("spend_osc_rows", _limit),
              "geo_region_rule": ("wuhan_box", _box)},
    "bidding": {"price_bucket": ("price_labels", tuple), "app_top_n": ("bid_app_rows", _limit),
                "cross_table_limit": ("cross_limit", _limit)},
}


def rules_from_standards(*standards: dict, base: Rules = Rules()) -> Rules:
    """``base`` with the entries of the standards; two that set one rule to different values are an error."""
    found: dict = {}
    for standard in standards:
        analysis = standard.get("analysis_type")
        if analysis not in ANALYSES:
            raise ValueError(f"unknown analysis_type {analysis!r}; expected one of {ANALYSES}")
        for entry, value in (standard.get("rules") or {}).items():
            if entry not in _ENTRIES[analysis]:
                continue
            rule, read = _ENTRIES[analysis][entry]
            try:
                values = {rule: read(value)}
                if rule == "price_labels":
                    values["price_bounds"] = price_bounds(list(value))
            except (ValueError, TypeError, AttributeError) as e:
                raise ValueError(f"{analysis} standard, {entry}: {e}") from None
            for name, v in values.items():
                if found.setdefault(name, v) != v:
                    raise ValueError(f"{analysis} standard, {entry}: another standard sets {name} to {found[name]!r}")
    return replace(base, **found)


def load_rules(spark: SparkSession, *paths: str, base: Rules = Rules()) -> Rules:
    """Rules from standard files (JSON, one object a file) on any file system that Spark reads."""
    return rules_from_standards(*[json.loads(spark.read.text(p, wholetext=True).first().value.removeprefix("﻿")) for p in paths], base=base)
