"""Rules from report standards."""

import json

import pytest

from bidscope.plans import basic
from bidscope.plans.context import ReportContext
from bidscope.plans.request import FunnelRequest, Rules
from bidscope.plans.standard import load_rules, price_bounds, rules_from_standards
from bidscope.sources.fixture import TEST_DAY

BASIC = {"analysis_type": "basic", "rules": {"drop_zero_bid_hours": False, "landing_page_requires_click": False, "app_top_n": 7, "cross_table_limit": 11, "remove_cpc": True}}
SPEND = {"analysis_type": "spend", "rules": {"adviewtype_mapping": {"4": "a", "10": "b"}, "top_app_n": 5, "top_region_n": 3, "top_order_strategy_material_n": 9,
                                             "geo_region_rule": "in=geo_lat 10–20.5 and geo_lon 100.25-110"}}
BIDDING = {"analysis_type": "bidding", "rules": {"price_bucket": ["50", "50-75.5", "75.5+"], "app_top_n": 4, "cross_table_limit": 11}}


def test_all_entries():
    r = rules_from_standards(BASIC, SPEND, BIDDING)
    assert (r.drop_zero_bid_hours, r.landing_page_requires_click, r.app_top_n, r.cross_limit, r.bid_app_rows) == (False, False, 7, 11, 4)
    assert (r.spend_app_rows, r.spend_region_rows, r.spend_osc_rows, r.ad_slot_names) == (5, 3, 9, {4: "a", 10: "b"})
    assert r.wuhan_box == (10.0, 20.5, 100.25, 110.0) and r.price_bounds == (50.0, 75.5) and r.price_labels == ("50", "50-75.5", "75.5+")
    assert rules_from_standards() == Rules() and hash(rules_from_standards(BASIC)) == hash(rules_from_standards(BASIC))


def test_defaults_are_the_standard_buckets():
    r = Rules()
    assert price_bounds(list(r.price_labels)) == r.price_bounds


@pytest.mark.parametrize("standard, text", [
    ({"analysis_type": "other"}, "unknown analysis_type"),
    ({"analysis_type": "basic", "rules": {"app_top_n": "30"}}, "basic standard, app_top_n"),
    ({"analysis_type": "basic", "rules": {"drop_zero_bid_hours": 1}}, "drop_zero_bid_hours"),
    ({"analysis_type": "spend", "rules": {"geo_region_rule": "everywhere"}}, "geo_region_rule"),
    ({"analysis_type": "spend", "rules": {"adviewtype_mapping": ["a"]}}, "adviewtype_mapping"),
    ({"analysis_type": "bidding", "rules": {"price_bucket": ["100", "200-500", "500+"]}}, "does not begin"),
    ({"analysis_type": "bidding", "rules": {"price_bucket": ["100", "100-500"]}}, "no price bucket at place 2"),
    ({"analysis_type": "bidding", "rules": {"price_bucket": ["100", "100-50", "50+"]}}, "does not begin"),
])
def test_wrong_entries_are_named(standard, text):
    with pytest.raises(ValueError, match=text):
        rules_from_standards(standard)


def test_standards_that_disagree():
    with pytest.raises(ValueError, match="cross_limit"):
        rules_from_standards(BASIC, {"analysis_type": "bidding", "rules": {"cross_table_limit": 12}})


def test_files_and_a_table_by_them(spark, src_small, tmp_path):
    paths = []
    for s in (BASIC, SPEND):
        paths.append(str(tmp_path / f"{s['analysis_type']}.json"))
        (tmp_path / f"{s['analysis_type']}.json").write_text("﻿" + json.dumps(s, indent=2, ensure_ascii=False), encoding="utf-8")
    rules = load_rules(spark, *paths)
    assert rules == rules_from_standards(BASIC, SPEND)
    assert basic.app_hour(ReportContext(src_small, FunnelRequest(TEST_DAY), rules)).count() == 11
