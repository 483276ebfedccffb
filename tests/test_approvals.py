"""Approval rules: routing, limits, summaries, upserts and the applications reader."""

import json
import os

import pytest
from pyspark.sql import functions as F

from sparkwright.operators import approvals as ap
from sparkwright.params import ApprovalParams
from sparkwright.sinks import tables as sk
from sparkwright.sources.readers import read_applications

SCHEMA = "application_id string, customer_name string, annual_income bigint"


def apps(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


# One application on each side of the threshold and of the floor, and on both.
APPLICANTS = [("k-17", "Nadia Okafor", 100_001), ("k-18", "Piet de Wit", 100_000), ("k-19", "Sunniva", 25_000),
              ("k-20", "Tomás", 20_000), ("k-21", "Wu Lan", 412_345)]


def test_tiers_at_the_threshold(spark):
    tiers = {r.application_id: r.income_tier for r in ap.route(apps(spark, APPLICANTS)).collect()}
    assert tiers == {"k-17": "PREMIUM", "k-18": "STANDARD", "k-19": "STANDARD", "k-20": "STANDARD", "k-21": "PREMIUM"}
    premium, standard = ap.route_premium(apps(spark, APPLICANTS)), ap.route_standard(apps(spark, APPLICANTS))
    assert {r.application_id for r in premium.collect()} == {"k-17", "k-21"}
    assert {r.application_id for r in standard.collect()} == {"k-18", "k-19", "k-20"}


@pytest.mark.parametrize("incomes,present", [([7, 8], {"STANDARD": 2}), ([500_000], {"PREMIUM": 1}), ([], {}), ([1, 900_000], {"STANDARD": 1, "PREMIUM": 1})])
def test_branches_lists_only_tiers_with_rows(spark, incomes, present):
    rows = [(f"r{k}", "n", v) for k, v in enumerate(incomes)]
    assert {r.income_tier: r.applications for r in ap.branches(apps(spark, rows)).collect()} == present


def test_limits_products_and_floor(spark):
    got = {r.application_id: (r.credit_limit, r.card_product, r.floor_applied) for r in ap.approve(apps(spark, APPLICANTS)).collect()}
    assert got == {"k-17": (15_000.15, "Infinite Sapphire", False), "k-18": (8_000.0, "Classic Rewards", False),
                   "k-19": (2_000.0, "Classic Rewards", False), "k-20": (2_000.0, "Classic Rewards", True),
                   "k-21": (61_851.75, "Infinite Sapphire", False)}
    assert ap.approve(apps(spark, [])).count() == 0


def test_limits_match_python_round_on_many_incomes(spark):
    df = spark.range(0, 300_000, 7).select(F.lit("x").alias("application_id"), F.lit("n").alias("customer_name"),
                                            F.col("id").cast("int").alias("annual_income"))
    got = {r.annual_income: r.credit_limit for r in ap.approve(df).collect()}
    for inc, lim in got.items():
        exp = round(inc * 0.15, 2) if inc > 100_000 else round(max(inc * 0.08, 2_000), 2)
        assert lim == exp, inc


# --- summary -----------------------------------------------------------------

def test_summary_of_any_portfolio(spark):
    for rows, expected in ((APPLICANTS, (5, 88_851.90, 17_770.38)), (APPLICANTS[1:2], (1, 8_000.0, 8_000.0)), ([], (0, 0.0, None))):
        s = ap.approval_summary(ap.approve(apps(spark, rows))).first()
        mean = None if s.avg_credit_limit is None else float(s.avg_credit_limit)
        assert (s.total_accounts, float(s.total_credit_volume), mean) == expected


# --- upsert ------------------------------------------------------------------

def _upsert(spark, path, df, as_of="2026-01-02 00:00:00"):
    return sk.merge_table(spark, path, ap.approve(df).select(*ap.PORTFOLIO_COLUMNS), ["application_id"],
                          update_columns=["credit_limit"],
                          set_on_match={"last_updated": F.lit(as_of).cast("timestamp_ntz")},
                          insert_values={"last_updated": F.lit(None).cast("timestamp_ntz")})


def test_an_empty_run_writes_no_version(spark, tmp_dir):
    path = os.path.join(tmp_dir, "accounts")
    assert _upsert(spark, path, apps(spark, [])) == "" and sk.current_version(spark, path) == 0


def test_known_accounts_change_only_limit_and_stamp(spark, tmp_dir):
    path = os.path.join(tmp_dir, "accounts")
    _upsert(spark, path, apps(spark, APPLICANTS[:3]))
    before = {r.application_id: r for r in sk.read_table(spark, path).collect()}
    assert len(before) == 3 and not any(r.last_updated for r in before.values())
    # One account returns with another name and a premium income, one is new, two don't return.
    _upsert(spark, path, apps(spark, [("k-19", "S. Berg", 300_000), ("k-99", "Ivo", 31_000)]))
    after = {r.application_id: r for r in sk.read_table(spark, path).collect()}
    assert set(after) == {"k-17", "k-18", "k-19", "k-99"}
    changed = {c for c in after["k-19"].asDict() if after["k-19"][c] != before["k-19"][c]}
    assert changed == {"credit_limit", "last_updated"} and after["k-19"].credit_limit == 45_000.0
    assert after["k-17"] == before["k-17"] and after["k-99"].last_updated is None


def test_repeating_a_run_adds_versions_not_rows(spark, tmp_dir):
    path = os.path.join(tmp_dir, "accounts")
    for version in (1, 2, 3):
        _upsert(spark, path, apps(spark, APPLICANTS))
        assert (sk.current_version(spark, path), sk.read_table(spark, path).count()) == (version, 5)


def test_upsert_rejects_duplicate_source_keys(spark, tmp_dir):
    with pytest.raises(ValueError, match="duplicate"):
        _upsert(spark, os.path.join(tmp_dir, "a"), apps(spark, [("D", "x", 1), ("D", "y", 2)]))


# --- ingest ------------------------------------------------------------------

def _write(tmp_dir, text):
    p = os.path.join(tmp_dir, "apps.csv")
    with open(p, "w") as f:
        f.write(text)
    return p


def test_read_applications_strips_and_types(spark, tmp_dir):
    p = _write(tmp_dir, 'annual_income,application_id,customer_name\n  120000 , A1 ,"  Ann\tLee "\n5000,A2,"Multi\nLine"\n')
    rows = sorted(read_applications(spark, p).collect())
    assert rows[0].application_id == "A1" and rows[0].customer_name == "Ann\tLee" and rows[0].annual_income == 120000
    assert rows[1].customer_name == "Multi\nLine"


@pytest.mark.parametrize("body", ["A1,Ann,12x\n", "A1,Ann,\n", "A1,Ann,12.0\n", "A1,Ann,1_000\n",
                                  "A1,Ann,99999999999999999999\n", "A1\n"])
def test_read_applications_rejects_bad_income(spark, tmp_dir, body):
    p = _write(tmp_dir, "application_id,customer_name,annual_income\n" + body)
    with pytest.raises(Exception):
        read_applications(spark, p).collect()


def test_blank_names_and_large_incomes_are_read(spark, tmp_dir):
    p = _write(tmp_dir, 'application_id,customer_name,annual_income\n,,5\nA2,"  ",3000000000\n')
    assert sorted(tuple(r) for r in read_applications(spark, p).collect()) == [("", "", 5), ("A2", "", 3_000_000_000)]


def test_ingest_stats_and_empty_load(spark):
    s = ap.ingest_stats(apps(spark, APPLICANTS)).first()
    assert (s.applications, s.min_income, s.max_income) == (5, 20_000, 412_345)
    with pytest.raises(Exception, match="no applications"):
        ap.ingest_stats(apps(spark, [])).collect()


def test_params_from_json():
    cfg = {"premium_income_threshold": 1, "premium_rate": 0.2, "standard_rate": 0.1, "standard_floor": 5,
           "card_products": {"premium": "P", "standard": "S"}}
    p = ApprovalParams.from_json(json.dumps(cfg))
    assert (p.threshold, p.premium_product) == (1, "P")
    del cfg["standard_floor"]
    with pytest.raises(KeyError):
        ApprovalParams.from_json(json.dumps(cfg))
    assert ApprovalParams.from_json(None) == ApprovalParams()


def test_land_applications_observes_stats(spark, tmp_dir):
    stats = ap.land_applications(apps(spark, APPLICANTS), os.path.join(tmp_dir, "apps"))
    assert stats == {"applications": 5, "min_income": 20_000, "max_income": 412_345}
    with pytest.raises(ValueError):
        ap.land_applications(apps(spark, []), os.path.join(tmp_dir, "empty"))
