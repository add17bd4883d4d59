"""The fact as a cube of mergeable states (AG10, AG12, AG16, AG17, AG20).

A *cell* is a set of keys with states that merge: counts and sums add up, bounds take
the smaller or larger, active hours are a bit mask, an average is a sum and a count.
A response is a cell of one row (``as_cells``), the fact reduced to its finest key set
is a table of cells (``fact_cube``), and so is every report level rolled up from either
(``roll_up``). All tables are written against cells, so they give the same results from
the raw fact, from the cube and from a coarser level that holds their keys.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidscope.functions.exprs import order_strategy_creative, target_group
from bidscope.operators.facts import WIDE_FLAGS
from bidscope.plans.request import Rules

# Keys of the finest cells. The derived keys are functions of them, added after grouping.
KEYS = ["order_id", "strategy_id", "creative_id", "order_name", "strategy_name", "creative_name", "material_id",
        "material_type", "app_name", "app_bundle", "hour", "geo_region", "ad_slot", "price_bucket", "page_id"]
DERIVED_KEYS = ["order_strategy_creative", "target_group"]

# Columns of ``fact_events`` that cells and their names are made of.
CELL_EVENTS = ["response_time", "hour", "app_bundle", "app_name", "geo_region", "imp_adviewtype", "bid_price", "order_id", "strategy_id",
               "creative_id", "_direct", "win", "spend_raw", "click", "page_id", *WIDE_FLAGS]

# The states of a cell: how one response makes them, and how they merge.
_ADD, _LEAST, _MOST, _BITS = F.sum, F.min, F.max, F.bit_or


def _count(c: str) -> Column:
    return F.col(c).cast("bigint")


STATES = {
    "bids": (lambda: F.lit(1).cast("bigint"), _ADD),
    "wins": (lambda: _count("win"), _ADD),
    "clicks": (lambda: _count("click"), _ADD),
    "page_exp": (lambda: _count("page_exp"), _ADD),
    "jumps": (lambda: _count("jump"), _ADD),
    "complete": (lambda: _count("complete"), _ADD),
    "scroll": (lambda: _count("scroll"), _ADD),
    "video": (lambda: _count("video"), _ADD),
    "direct_jump_bids": (lambda: _count("direct_jump"), _ADD),
    "spend_raw": (lambda: F.col("spend_raw"), _ADD),
    "price_sum": (lambda: F.col("bid_price"), _ADD),
    "price_n": (lambda: F.when(F.col("bid_price").isNotNull(), 1).otherwise(0).cast("bigint"), _ADD),
    "price_min": (lambda: F.col("bid_price"), _LEAST),
    "price_max": (lambda: F.col("bid_price"), _MOST),
    "hour_mask": (lambda: F.call_function("shiftleft", F.lit(1), F.col("hour").cast("int")), _BITS),
    "start_time": (lambda: F.col("response_time"), _LEAST),
    "last_time": (lambda: F.col("response_time"), _MOST),
}


def measure(name: str, rules: Rules) -> Column:
    """A report measure as a column over merged states."""
    if name == "spend_yuan":
        return (F.col("spend_raw") / F.lit(float(rules.spend_divisor))).alias(name)
    if name == "active_hours":
        return F.coalesce(F.bit_count("hour_mask"), F.lit(0)).cast("bigint").alias(name)
    if name == "avg_bid_price":
        return F.try_divide(F.col("price_sum"), F.col("price_n")).alias(name)
    return F.col({"min_bid_price": "price_min", "max_bid_price": "price_max"}.get(name, name)).alias(name)


# States that a measure needs, where they are not the one of its own name.
MEASURE_STATES = {"spend_yuan": ["spend_raw"], "active_hours": ["hour_mask"], "avg_bid_price": ["price_sum", "price_n"],
                  "min_bid_price": ["price_min"], "max_bid_price": ["price_max"]}


def states_of(measures: Iterable[str]) -> list[str]:
    return list(dict.fromkeys(s for m in measures for s in MEASURE_STATES.get(m, [m])))


def as_cells(wide: DataFrame) -> DataFrame:
    """Every response of the wide fact as a cell of its own; a projection, so Catalyst prunes what is not used."""
    return wide.select(*KEYS, *DERIVED_KEYS, *[make().alias(s) for s, (make, _) in STATES.items()])


def merged(states: Iterable[str] = STATES) -> list[Column]:
    """Aggregates that merge the named states."""
    return [STATES[s][1](s).alias(s) for s in states]


def fact_cube(wide: DataFrame, rules: Rules = Rules(), dealt_by: Column | None = None) -> DataFrame:
    """The fact reduced once to its finest cells: one row for each combination of ``KEYS``.

    Combined map-side, so a hot app or strategy reaches its reducer as one row a task
    for each of its combinations. ``dealt_by``: a function of the keys by which the rows are dealt already
    (no value of it may hold more rows than a task should); grouped by it too, they are not shuffled again.
    """
    dealt = [] if dealt_by is None else [dealt_by.alias("_dealt")]
    return as_cells(wide).groupBy(*KEYS, *dealt).agg(*merged()).drop("_dealt").withColumns({
        "order_strategy_creative": order_strategy_creative("order_name", "strategy_name", "creative_name"),
        "target_group": target_group("strategy_id", rules.target_strategy_ids)})


def roll_up(cells: DataFrame, keys: Sequence[str], states: Iterable[str] = STATES) -> DataFrame:
    """Cells merged to coarser ``keys`` (null keys are keys, as everywhere)."""
    return cells.groupBy(*keys).agg(*merged(states))


def finest(key_sets: Iterable[Sequence[str]]) -> list[list[str]]:
    """The key sets that no other one contains; all others roll up from one of them."""
    sets = [list(ks) for ks in dict.fromkeys(tuple(ks) for ks in key_sets)]
    return [ks for ks in sets if not any(set(ks) < set(other) for other in sets)]


class Levels:
    """Report levels of one cube: each of the finest key sets rolled up from its cells and written,
    every other level rolled up from the smallest of them.

    The roll-ups read only their own keys. ``aggregate`` gives the same
    levels as one frame from one grouping-sets pass, which copies every cell for every set.
    """

    def __init__(self, key_sets: Iterable[Sequence[str]]):
        self.sets = finest(key_sets)
        self.keys = list(dict.fromkeys(k for ks in self.sets for k in ks))
        self.tables: list[DataFrame] = []

    def aggregate(self, cells: DataFrame) -> DataFrame:
        """All finest levels in one frame, told apart by ``level`` (the set's number)."""
        agg = cells.groupingSets(self.sets, *self.keys).agg(*merged(), F.grouping_id().alias("_gid"))
        level = F.lit(None).cast("int")
        for i, ks in enumerate(self.sets):
            gid = sum(1 << (len(self.keys) - 1 - j) for j, k in enumerate(self.keys) if k not in ks)
            level = F.when(F.col("_gid") == F.lit(gid), F.lit(i)).otherwise(level)
        return agg.withColumn("level", level).drop("_gid")

    def jobs(self, cells: DataFrame, write: Callable[[DataFrame, str], DataFrame]) -> list[Callable[[], DataFrame]]:
        """One job a level: roll it up and have ``write`` store it under its name."""
        return [lambda i=i, ks=ks: write(roll_up(cells, ks), f"level_{i}") for i, ks in enumerate(self.sets)]

    def get(self, keys: Sequence[str]) -> tuple[DataFrame, bool] | None:
        """Cells that hold ``keys``, from the smallest written level, and whether these are all of its keys."""
        holding = [i for i, ks in enumerate(self.sets) if set(keys) <= set(ks)]
        if not self.tables or not holding:
            return None
        best = min(holding, key=lambda i: len(self.sets[i]))
        return self.tables[best], len(self.sets[best]) == len(set(keys))
