"""Typed report request and report rules (the "standard")."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

ANALYSES = ("basic", "spend", "bidding")


def _as_date(value) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(str(value))


@dataclass(frozen=True)
class FunnelRequest:
    """One report: a day, an analysis and an optional order scope.

    ``prev_day`` defaults to the day before ``day``.
    """

    day: dt.date
    analysis: str = "basic"
    order_id: int | None = None
    prev_day: dt.date | None = None

    def __post_init__(self):
        object.__setattr__(self, "day", _as_date(self.day))
        if self.prev_day is None:
            object.__setattr__(self, "prev_day", self.day - dt.timedelta(days=1))
        else:
            object.__setattr__(self, "prev_day", _as_date(self.prev_day))
        if self.analysis not in ANALYSES:
            raise ValueError(f"unknown analysis {self.analysis!r}; expected one of {ANALYSES}")
        if self.order_id is not None:
            object.__setattr__(self, "order_id", int(self.order_id))

    def with_analysis(self, analysis: str) -> "FunnelRequest":
        return FunnelRequest(self.day, analysis, self.order_id, self.prev_day)

    def with_order(self, order_id: int | None) -> "FunnelRequest":
        return FunnelRequest(self.day, self.analysis, order_id, self.prev_day)


# Fixed values that must equal the reference's report standard.
WUHAN_BOX = (29.8, 31.6, 113.6, 115.2)          # lat_min, lat_max, lon_min, lon_max
WUHAN_TARGET_STRATEGY_IDS = (195, 199, 205, 212, 213)
AD_SLOT_NAMES = {4: "插屏", 5: "开屏", 10: "信息流"}
PRICE_BUCKET_BOUNDS = (100.0, 500.0, 1000.0, 1500.0, 2000.0)
PRICE_BUCKET_LABELS = ("100", "100-500", "500-1000", "1000-1500", "1500-2000", "2000+")
EMPTY_APP_LABEL = "(空)"
GEO_MISSING_LABEL = "地理缺失"
GEO_IN_LABEL = "武汉"
GEO_OUT_LABEL = "非武汉"
TARGET_IN_LABEL = "武汉定向"
TARGET_OUT_LABEL = "全国定向"
AD_SLOT_UNKNOWN = "未知"
AD_SLOT_OTHER = "其他"
PRICE_UNKNOWN = "未知"
TRACK_RID_PATTERN = r"[?&]rid=([^&]+)"
TRACK_PYCK_PATTERN = r"[?&]pyck=([^&]+)"
PAGE_ID_PATTERN = r"/dragIndex/([0-9]+)"
SPEND_DIVISOR = 100000.0


@dataclass(frozen=True)
class Rules:
    """Report rules; defaults are the numbers of the reference standard."""

    app_top_n: int = 30                 # TK1 apps whose invites are counted (basic)
    basic_app_rows: int = 31            # TK2 rows of the basic app table
    creative_rows: int = 200            # TK5
    cross_limit: int = 300              # TK6/TK7
    spend_app_rows: int = 50            # TK3
    spend_region_rows: int = 80         # TK3
    spend_osc_rows: int = 300           # TK3
    bid_app_rows: int = 30              # TK4 / CK3
    bid_osc_rows: int = 300             # TK4
    drop_zero_bid_hours: bool = True    # FLT5
    landing_page_requires_click: bool = True  # JN3
    spend_divisor: float = SPEND_DIVISOR
    wuhan_box: tuple = WUHAN_BOX
    target_strategy_ids: tuple = WUHAN_TARGET_STRATEGY_IDS
    ad_slot_names: dict = field(default_factory=lambda: dict(AD_SLOT_NAMES))
    price_bounds: tuple = PRICE_BUCKET_BOUNDS
    price_labels: tuple = PRICE_BUCKET_LABELS
    rid_pattern: str = TRACK_RID_PATTERN
    pyck_pattern: str = TRACK_PYCK_PATTERN
    page_id_pattern: str = PAGE_ID_PATTERN
    spend_attention_share: float = 0.3  # SC26

    def __hash__(self):
        return hash((self.spend_divisor, self.landing_page_requires_click, self.price_bounds, tuple(sorted(self.ad_slot_names.items()))))
