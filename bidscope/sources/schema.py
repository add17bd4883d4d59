"""Declared schemas of the eight inputs (the reference keeps no DDL; types are
inferred from its SQL) and the English <-> report label map."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, D, I, TS = T.StringType(), T.LongType(), T.DoubleType(), T.IntegerType(), T.TimestampNTZType()


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


SCHEMAS: dict[str, T.StructType] = {
    "bid_request": _schema(
        ("request_id", S), ("imp_id", S), ("request_time", TS), ("app_bundle", S),
        ("imp_bidfloor", D), ("geo_city", S), ("geo_lat", D), ("geo_lon", D),
        ("imp_adviewtype", I), ("imp_adlocation", S), ("imp_templateid", S)),
    "bid_response": _schema(
        ("response_id", S), ("bid_seat_id", S), ("bid_imp_id", S), ("response_time", TS),
        ("bid_price", D), ("order_id", L), ("strategy_id", L), ("creative_id", S),
        ("land_page", S), ("curl", S), ("dpl_url", S)),
    "bid_result": _schema(("response_id", S), ("bid_seat_id", S), ("response_time", TS), ("wpr", S)),
    "bid_click": _schema(("response_id", S), ("bid_seat_id", S), ("response_time", TS)),
    "track_event": _schema(
        ("event_time", TS), ("event_code", S), ("preset_attributes", S), ("root_id", S),
        ("parent_event_id", S)),
    "dim_strategy": _schema(
        ("strategy_id", L), ("strategy_name", S), ("order_name", S), ("order_id", L), ("etl_time", TS)),
    "dim_creative": _schema(
        ("creative_id", L), ("creative_name", S), ("order_name", S), ("strategy_name", S),
        ("material_id", S), ("material_type", S)),
    "app_mapping": _schema(
        ("app_package_name", S), ("app_name", S), ("is_verified", S), ("request_count", S),
        ("etl_time", S)),
}

# Time column of each event table (used for day windows and JDBC partitioning).
TIME_COLUMNS = {
    "bid_request": "request_time",
    "bid_response": "response_time",
    "bid_result": "response_time",
    "bid_click": "response_time",
    "track_event": "event_time",
}

# Report column labels of the reference, by English column name.
LABELS = {
    "d": "日期", "invites": "邀约", "bids": "出价", "wins": "竞得", "clicks": "点击",
    "page_exp": "落地页曝光", "jumps": "跳转", "spend_yuan": "花费(元)", "load_fail": "页面加载失败",
    "active_hours": "活跃小时", "strategies": "投放策略数", "avg_bid_price": "平均出价",
    "min_bid_price": "最低出价", "max_bid_price": "最高出价", "price_bucket": "出价分层",
    "ad_slot": "广告位类型", "target_group": "定向组", "order_strategy_creative": "订单策略素材",
    "direct_jump_bids": "直接跳转订单出价", "geo_region": "地域", "opportunity_invites": "机会邀约",
    "app_name": "APP名称", "rate_invite_bid": "邀约→出价", "rate_bid_win": "出价→竞得",
    "rate_win_click": "竞得→点击", "rate_click_page": "点击→落地页曝光", "rate_page_jump": "落地页曝光→跳转",
    "cost_per_win": "每次竞得花费", "cost_per_click": "每次点击花费", "cost_per_jump": "每次跳转花费",
    "cost_per_exposure": "每次曝光花费", "spend_share": "花费占比", "bid_share": "出价占比",
    "avg_floor": "平均底价", "unbid_estimate": "未进入出价(估算)", "load_fail_rate": "页面加载失败率",
    "page_id": "落地页ID", "visits": "访问数", "complete_visits": "完读访问", "scroll_visits": "滚动访问",
    "video_visits": "视频访问", "page_click_visits": "页面点击访问", "direct_jump_clicks": "点击后无落地页",
    "complete_rate": "完读率", "scroll_rate": "滚动率", "video_rate": "视频率", "page_click_rate": "页面点击率",
    "start_time": "开始时间", "last_time": "最后出价时间", "metric": "指标", "delta": "较前日变化",
    "delta_rate": "较前日变化率",
}
