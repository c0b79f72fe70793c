import hashlib
import random

import pytest
from pyspark.sql import functions as F

from labeltext.operators import ranking, sampling
from labeltext.operators.counts import key_overlap, phase_summary, split_summary, with_sample_rows


def by_label(df):
    return {r["label"]: r["count"] for r in df.groupBy("label").count().collect()}


def test_split_sizes_and_repeatability(keyed):
    first = sampling.train_val_test_split(keyed)
    sizes = {r["split"]: (r["rows"], r["label_0"], r["label_1"])
             for r in split_summary(first).collect()}
    assert {k: v[0] for k, v in sizes.items()} == {"train": 70, "val": 15, "test": 15}
    assert sizes["train"][1:] == (49, 21)
    again = sampling.train_val_test_split(keyed.repartition(5))
    assert sorted(first.collect()) == sorted(again.collect())
    plain = sampling.train_val_test_split(keyed, stratify=False)
    assert {r["split"]: r["rows"] for r in split_summary(plain).collect()} == {
        "train": 70, "val": 15, "test": 15,
    }


def test_sample_counts(keyed):
    assert by_label(sampling.stratified_sample(keyed, 0.6)) == {0: 42, 1: 18}
    assert sampling.stratified_sample(keyed, 0.25, stratify=False).count() == 25
    assert sampling.stratified_sample(keyed, 1.0).count() == 100
    assert sampling.stratified_sample(keyed, 0.001).count() == 0


def test_phases_are_disjoint(keyed):
    phased = sampling.phase_partition(keyed)
    rows = {r["phase"]: r["rows"] for r in phase_summary(phased).collect()}
    assert rows == {"phase1_reference": 60, "phase2_increment": 20, "phase2_sample": 80,
                    "phase3_holdout": 20}
    overlap = key_overlap(with_sample_rows(phased), "phase",
                          [(["phase2_sample"], ["phase3_holdout"])]).first()
    assert (overlap["in_both"], overlap["only_left"], overlap["only_right"]) == (0, 80, 20)


def test_rank_equals_sorted_hashes(spark):
    """One group holds most rows; ranks still equal those of a plain sort."""
    rng = random.Random(2)
    rows = [(i, 0 if rng.random() < 0.9 else 1) for i in rng.sample(range(10**6), 1500)]
    df = spark.createDataFrame(rows, "raw_index bigint, label bigint")

    def digest(i):
        return hashlib.md5(f"7:{i}".encode()).hexdigest()

    expected = {}
    for label in (0, 1):
        keys = sorted((k for k, g in rows if g == label), key=lambda k: (digest(k), k))
        expected.update({k: i + 1 for i, k in enumerate(keys)})
    for chars in (1, 2, 4):
        out = ranking.seeded_rank(df, ["label"], "raw_index", 7, chars).collect()
        assert {r["raw_index"]: r["rank"] for r in out} == expected
    cut = ranking.rank_slices(
        df, ["label"], "raw_index", 7, ["a", "b", "c"],
        lambda t: t.withColumn("r0", F.lit(10)).withColumn("r1", F.lit(100)), 2,
    )
    want = {k: "a" if r <= 10 else "b" if r <= 100 else "c" for k, r in expected.items()}
    assert {r["raw_index"]: r["phase"] for r in cut.collect()} == want
    keys = ranking.key_rank(df, ["label"], "raw_index").where("label = 0").orderBy("raw_index")
    assert [r["rank"] for r in keys.collect()] == list(range(1, keys.count() + 1))


@pytest.mark.parametrize("descending", [False, True])
def test_running_sums_equal_brute_force(spark, descending):
    rng = random.Random(3)
    rows = [(g, float(x), rng.randint(0, 5)) for g in "ab"
            for x in rng.sample(range(-500, 500), 300)]
    df = spark.createDataFrame(rows, "g string, x double, n bigint").repartition(6)
    out = ranking.running_sums(df, ["g"], "x", ["n"], descending, range_rows=16).collect()
    assert len(out) == len(rows)
    for r in out:
        inside = [n for g, x, n in rows
                  if g == r["g"] and (x >= r["x"] if descending else x <= r["x"])]
        assert r["cum_n"] == sum(inside)


def test_bad_parameters(spark, keyed):
    with pytest.raises(ValueError):
        sampling.stratified_sample(keyed, 0)
    with pytest.raises(ValueError):
        sampling.stratified_sample(keyed, 1.2)
    with pytest.raises(ValueError):
        sampling.stratified_sample(keyed.drop("label"), 0.5)
    with pytest.raises(ValueError):
        sampling.phase_partition(keyed, 0.5, 0.2, 0.2)
    with pytest.raises(ValueError):
        sampling.phase_partition(keyed, sample=0.7)
    with pytest.raises(ValueError):
        sampling.phase_partition(keyed, stratify=False)
    with pytest.raises(ValueError):
        sampling.train_val_test_split(keyed, 0.7, 0.3, 0.0)
    with pytest.raises(ValueError):
        sampling.train_val_test_split(keyed, 0.7, 0.2, 0.2)


def test_small_ranges_and_shuffled_joins_agree(spark):
    """Results don't depend on how many ranges there are or on how Spark joins."""
    rows = [(g, float(x), 1) for g in range(6) for x in range(20)]
    df = spark.createDataFrame(rows, "g int, x double, n bigint")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = ranking.running_sums(df, ["g"], "x", ["n"], range_rows=4).collect()
        assert all(r["cum_n"] == r["x"] + 1 for r in out) and len(out) == 120
        keyed = df.select(F.col("g").alias("label"), (F.col("g") * 100 + F.col("x")).cast("bigint").alias("raw_index"))
        kept = sampling.stratified_sample(keyed, 0.5)
        assert {r["count"] for r in kept.groupBy("label").count().collect()} == {10}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_ranks_of_sparse_keys(spark):
    rng = random.Random(4)
    keys = sorted({rng.randrange(-(2**63), 2**63) for _ in range(900)})
    table = spark.createDataFrame([(k, k % 10 == 0) for k in rng.sample(keys, 900)], "key bigint, few boolean")
    got = {(r["few"], r["key"]): r["rank"] for r in ranking.key_rank(table, ["few"], "key").collect()}
    want = {}
    for few in (True, False):
        want |= {(few, k): n for n, k in enumerate((k for k in keys if (k % 10 == 0) == few), start=1)}
    assert got == want
    held = ranking.ranges(table, ["few"], F.col("key").asc(), range_rows=100)
    sizes = [r["count"] for r in held.groupBy("_range").count().collect()]
    assert sum(sizes) == 900 and max(sizes) < 400 and len(sizes) >= 7
