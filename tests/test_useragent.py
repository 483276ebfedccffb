"""User-agent rules: every row of the A/B divergence table is a case."""

import pytest
from pyspark.sql import functions as F

from sparkwright.functions.useragent import parse_browser, parse_os

WIN_EDGE = ("Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) "
            "Chrome/120.0.0.0 Safari/537.36 Edg/120.0.0.0")
MAC_SAFARI = ("Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7) AppleWebKit/605.1.15 (KHTML, like Gecko) "
              "Version/17.3 Safari/605.1.15")
IPHONE = ("Mozilla/5.0 (iPhone; CPU iPhone OS 17_2 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) "
          "Version/17.2 Mobile/15E148 Safari/604.1")
ANDROID = ("Mozilla/5.0 (Linux; Android 14; Pixel 8) AppleWebKit/537.36 (KHTML, like Gecko) "
           "Chrome/120.0.0.0 Mobile Safari/537.36")
CHROMIUM = ("Mozilla/5.0 (X11; Linux x86_64) AppleWebKit/537.36 (KHTML, like Gecko) Chromium/119.0 "
            "Chrome/119.0 Safari/537.36")
OPR = ("Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) "
       "Chrome/120.0.0.0 Safari/537.36 OPR/106.0.0.0")
OPERA = "Opera/9.80 (Windows NT 6.1; U; en) Presto/2.12.388 Version/12.18"
IPAD_LOWER = "mozilla/5.0 (ipad; cpu os 16_0) applewebkit/605.1.15 version/16.0 safari/604.1"
FIREFOX = "Mozilla/5.0 (X11; Linux x86_64; rv:121.0) Gecko/20100101 Firefox/121.0"

CASES = [
    # agent, A browser, A os, B browser, B os
    (WIN_EDGE, "Edge", "Windows", "Edge", "Windows"),
    (MAC_SAFARI, "Safari", "macOS", "Safari", "macOS"),
    (IPHONE, "Safari", "macOS", "Safari", "iOS"),
    (ANDROID, "Chrome", "Android", "Chrome", "Android"),
    (CHROMIUM, "Other", "Linux", "Chrome", "Linux"),
    (OPR, "Chrome", "Windows", "Chrome", "Windows"),
    (OPERA, "Opera", "Windows", "Opera", "Windows"),
    (IPAD_LOWER, "Safari", "iOS", "Safari", "iOS"),
    (FIREFOX, "Firefox", "Linux", "Firefox", "Linux"),
    ("curl/8.4.0", "Other", "Other", "Other", "Other"),
    (None, "Other", "Other", "Other", "Other"),
]


@pytest.fixture(scope="module")
def parsed(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, ua string")
    rows = df.select("i", parse_browser("ua", "A").alias("ba"), parse_os("ua", "A").alias("oa"),
                     parse_browser(F.col("ua"), "B").alias("bb"), parse_os("ua", "B").alias("ob")).collect()
    return {r.i: (r.ba, r.oa, r.bb, r.ob) for r in rows}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_divergence_table(parsed, i):
    assert parsed[i] == CASES[i][1:]


def test_rules_stay_in_codegen(spark):
    df = spark.createDataFrame([(WIN_EDGE,)], "ua string").select(parse_browser("ua").alias("b"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
