"""Term lookup beside regular expressions, report periods beside a loop, geodesics beside control points and integrals."""

import datetime as dt
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.functions import geo
from sluice.operators import runs, terms


@pytest.mark.parametrize("limit", [1 << 20, 6])
def test_terms_beside_a_pattern(spark, monkeypatch, limit):
    """One list of terms, and several beyond the bound."""
    monkeypatch.setattr(terms, "TERM_BYTES", limit)
    rng = random.Random(3)
    words = ["ab", "abc", "ca", "가나", "b.b", "bb"]
    texts = ["".join(rng.choice("abc .!\n가나") for _ in range(rng.randint(0, 300))) for _ in range(120)] + [None, "", "ab" * 500]
    docs = spark.createDataFrame(list(enumerate(texts)), "page long, text string").repartition(3)
    table = spark.createDataFrame([(w,) for w in [*words, *words, "", None]], "name string")
    got = {r.page: (r.first_term, r.hits, r.passages) for r in terms.find_terms(docs, table, "page", "text", "name", before=8, after=12, most=5).collect()}
    one = "|".join(map(re.escape, sorted(words, key=lambda w: (-len(w), w))))
    for i, text in enumerate(texts):
        first = re.search(one, text or "")
        if not first:
            assert i not in got
            continue
        starts = {m.start() for w in words for m in re.finditer(f"(?={re.escape(w)})", text)}
        assert got[i] == (first[0], len(starts), re.findall(rf"[^.!?\n]{{0,8}}(?:{one})[^.!?\n]{{0,12}}", text)[:5])
    assert terms.find_terms(docs, table.limit(0), "page", "text", "name").count() == 0


def test_every_run_in_its_periods(spark):
    rng = random.Random(1)
    start = dt.datetime(2024, 1, 1)
    found = [(i, f"j{i % 5}", rng.choice(["SUCCESS", "FAILED"]), "PASSED", float(i % 7), None, start + dt.timedelta(minutes=rng.randrange(0, 6 * 1440))) for i in range(400)]
    found += [(900 + i, "edge", "SUCCESS", None, 1.0, None, start + dt.timedelta(days=2, hours=h, minutes=m)) for i, (h, m) in enumerate([(9, 15), (9, 14), (17, 0), (16, 59)])]
    df = spark.createDataFrame(found, "id int, job_id string, run_status string, dq_status string, elapsed_seconds double, failure_stage string, finished_at timestamp_ntz")
    days = spark.sql("SELECT explode(sequence(date '2024-01-01', date '2024-01-08')) AS day")
    got = {(r.label, r.start): r.total_runs for r in runs.by_period(df, runs.report_periods(days)).collect()}
    assert sum(got.values()) == len(found)
    for (_, begin), n in got.items():
        end = begin.replace(hour=17, minute=0) if begin.hour == 9 else (begin + dt.timedelta(days=1)).replace(hour=9, minute=15)
        assert n == sum(begin <= r[-1] < end for r in found)
        assert runs.report_period(end) == (begin, end)
    # overlapping periods of any length; an empty one
    odd = [("whole", start, start + dt.timedelta(days=30)), ("hour", start + dt.timedelta(days=1), start + dt.timedelta(days=1, hours=1)), ("none", start, start)]
    periods = spark.createDataFrame(odd, "label string, start timestamp_ntz, end timestamp_ntz")
    got = {r.label: r.total_runs for r in runs.by_period(df, periods).collect()}
    assert got["whole"] == len(found) and "none" not in got and got.get("hour", 0) == sum(odd[1][1] <= r[-1] < odd[1][2] for r in found)


def metres(spark, *pairs):
    df = spark.createDataFrame([(i, *map(float, p)) if None not in p else (i, *p) for i, p in enumerate(pairs)], "i int, a double, b double, c double, d double")
    return [r.m for r in geo.with_geodesic(df, *map(F.col, "abcd"), "m").orderBy("i").collect()]


def meridian(low, high):
    """The arc of a meridian by Gauss-Legendre quadrature."""
    e2 = geo.FLATTENING * (2 - geo.FLATTENING)
    x, w = np.polynomial.legendre.leggauss(60)
    half, mid = math.radians(high - low) / 2, math.radians(high + low) / 2
    return float(half * sum(w * geo.SEMI_MAJOR * (1 - e2) / (1 - e2 * np.sin(mid + half * x) ** 2) ** 1.5))


def test_geodesic_control_points(spark):
    dms = lambda d, m, s: math.copysign(abs(d) + m / 60 + s / 3600, d)
    line = (dms(-37, 57, 3.72030), dms(144, 25, 29.52440), dms(-37, 39, 10.15610), dms(143, 55, 35.38390))
    got = metres(spark, line, (0, 0, 0, 90), (0, 10, 0, 11), (0, 5, 90, 5), (10, 20, 37.5, 20), (-45, 179.5, 45, 179.5), (12, 30, 12, 30), (None, 1.0, 1.0, 1.0), (50, -179, 50, 179), (50, 1, 50, -1))
    want = [54972.271, geo.SEMI_MAJOR * math.pi / 2, geo.SEMI_MAJOR * math.pi / 180, meridian(0, 90), meridian(10, 37.5), meridian(-45, 45), 0.0]
    assert np.allclose(got[:7], want, atol=1e-3, rtol=0)
    assert got[7] is None and abs(got[8] - got[9]) < 1e-6
    # nearly opposite positions have the defined answer, and none is far off
    far = metres(spark, (0, 0, 0.3, 179.8), (0, 0, 0, 180), (30, 0, -29.9, 179.9), (90, 0, -90, 0))
    assert all(19_880_000 < m < 20_050_000 for m in far)


def test_geodesic_is_no_udf(spark):
    plan = geo.with_geodesic(spark.range(3).select((F.col("id") * 10.5).alias("a")), F.col("a"), F.lit(1.0), F.lit(2.0), F.col("a"), "m")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and plan.columns == ["a", "m"] and plan.count() == 3
