import math
import random

import numpy as np
import pytest

from labeltext.operators import counts, drift
from labeltext.plans.drift_report import drift_report

REF, CUR = "phase1_reference", "phase2_increment"


def slices(spark, reference, current):
    rows = [(i, t, 0, REF) for i, t in enumerate(reference)]
    rows += [(1000 + i, t, 1, CUR) for i, t in enumerate(current)]
    return spark.createDataFrame(
        rows, "raw_index bigint, text_combined string, label bigint, slice string"
    )


def distance(spark, left, right):
    rows = [(REF, k, n) for k, n in left.items()] + [(CUR, k, n) for k, n in right.items()]
    table = spark.createDataFrame(rows, "slice string, key string, n bigint")
    return drift.js_distance(drift.side_by_side(table, "key")).first()[0]


def test_js_of_proportional_counts_is_zero(spark):
    assert distance(spark, {"0": 70, "1": 30}, {"0": 140, "1": 60}) == pytest.approx(0, abs=1e-9)


def test_js_one_sided_and_empty(spark):
    value = distance(spark, {"a": 1, "b": 3}, {"b": 2, "c": 2})
    p, q = np.array([0.25, 0.75, 0]), np.array([0, 0.5, 0.5])
    m = (p + q) / 2
    expected = math.sqrt(sum(0.5 * x * math.log(x / y) for v in (p, q) for x, y in zip(v, m) if x))
    assert value == pytest.approx(expected)
    assert distance(spark, {"a": 1}, {"b": 1}) == pytest.approx(math.sqrt(math.log(2)))
    assert distance(spark, {"a": 1}, {}) is None


def lengths(spark, a, b):
    return drift.length_counts(slices(spark, ["x" * n for n in a], ["x" * n for n in b]))


def test_ks_extremes(spark):
    assert drift.ks_test(lengths(spark, [1, 2, 3], [1, 2, 3])).first()[:2] == (0.0, 1.0)
    assert drift.ks_test(lengths(spark, [1, 2], [5, 6, 7])).first()[0] == 1.0
    assert drift.ks_test(lengths(spark, [1, 2], [])).first()[0] is None


def test_lengths_equal_numpy(spark):
    rng = random.Random(4)
    a = [rng.randint(0, 40) if rng.random() < 0.6 else 7 for _ in range(300)]
    b = [rng.randint(5, 60) for _ in range(200)]
    table = lengths(spark, a, b)
    stat, p_value = drift.ks_test(table).first()
    grid = np.arange(0, 61)
    gap = max(abs(np.mean(np.array(a) <= x) - np.mean(np.array(b) <= x)) for x in grid)
    assert stat == pytest.approx(gap)
    lam = gap * math.sqrt(300 * 200 / 500)
    series = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 100))
    assert p_value == pytest.approx(series, abs=1e-9)
    stats = {r["slice"]: r for r in drift.length_stats(table).collect()}
    for name, values in ((REF, a), (CUR, b)):
        row = stats[name]
        assert row["mean"] == pytest.approx(np.mean(values))
        assert row["median"] == pytest.approx(np.median(values))
        assert row["p90"] == pytest.approx(np.quantile(values, 0.9))
        assert row["max"] == max(values)
    bins = drift.length_histogram(table, 10).where(f"slice = '{REF}'").orderBy("bin").collect()
    expected, edges = np.histogram(a, bins=10)
    found = {r["bin"]: r for r in bins}
    assert [found[i]["n"] if i in found else 0 for i in range(10)] == expected.tolist()
    assert sum(r["density"] for r in bins) * (edges[1] - edges[0]) == pytest.approx(1)


@pytest.mark.parametrize("x", [0.05, 0.3, 0.7, 0.99, 1.0, 1.5, 3.0])
def test_kolmogorov_tail_series_agree(spark, x):
    from pyspark.sql import functions as F

    value = spark.range(1).select(drift.kolmogorov_tail(F.lit(x))).first()[0]
    direct = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * x * x) for k in range(1, 2001))
    assert value == pytest.approx(direct, abs=1e-9)


def test_vocabulary(spark):
    df = slices(spark, ["aa bb"], ["aa cc cc Cc"])
    pairs = drift.token_pairs(df)
    row = drift.vocabulary_drift(pairs).first().asDict()
    assert row == {"reference_vocab_size": 2, "current_vocab_size": 3, "new_token_count": 2,
                   "new_token_rate": 0.75}
    assert tuple(drift.new_tokens(pairs, 1).first()) == ("cc", 2)
    both = drift.token_counts(df, by=["slice"])
    new = drift.vocabulary_difference(both.where(f"slice = '{CUR}'"), both.where(f"slice = '{REF}'"))
    assert sorted(r["token"] for r in new.collect()) == ["Cc", "cc"]
    nothing = drift.vocabulary_drift(drift.token_pairs(slices(spark, ["aa"], ["!"]))).first()
    assert nothing["new_token_rate"] == 0.0


def test_report_sections(spark):
    df = slices(spark, ["aa bb", "aa"], ["cc dd", None])
    manifest = spark.createDataFrame([(0, "s"), (1, "s"), (1000, "t")],
                                     "raw_index bigint, source string")
    report = drift_report(df, manifest)
    rows = {(r["section"], r["slice"], r["name"]): r["value"] for r in report.collect()}
    assert rows[("rows", REF, "rows")] == 2
    assert rows[("source", CUR, "t")] == 1
    assert rows[("label", None, "jensen_shannon_distance")] == pytest.approx(math.sqrt(math.log(2)))
    assert rows[("text_length", CUR, "mean")] == 2.5
    assert rows[("new_tokens", None, "cc")] == 1
    assert not any(k[0] == "prediction" for k in rows)


def test_source_distribution_without_key(spark):
    manifest = spark.createDataFrame([(0, "s")], "raw_index bigint, source string")
    df = slices(spark, ["aa"], ["bb"]).drop("raw_index")
    assert counts.source_distribution(df, manifest).isEmpty()
