import random

import pytest
from pyspark.sql import functions as F

from labeltext.operators import prepare
from labeltext.operators.counts import distribution


def raw(spark, rows):
    return spark.createDataFrame(rows, "raw_index bigint, text_combined string, label string")


def test_clean_dataset_drops_copies(spark):
    df = raw(spark, [(0, "Hello   WORLD", "0"), (1, "Hello   WORLD", "0"),
                     (2, "Reset password now", "1")])
    out = prepare.clean_dataset(df, key=None)
    assert out.columns == ["text_combined", "label"]
    assert sorted(r["text_combined"] for r in out.collect()) == ["hello world", "reset password now"]
    counts = {r["label"]: r["n"] for r in distribution(out, "label").collect()}
    assert counts == {0: 1, 1: 1}
    summary = prepare.cleaning_summary(df).first().asDict()
    assert summary == {"raw_rows": 3, "cleaned_rows": 2, "rows_removed": 1, "label_0": 1,
                       "label_1": 1}


def test_first_copy_survives_and_labels_separate(spark):
    df = raw(spark, [(5, "same text", "1"), (3, "SAME text", "1"), (4, "same  text", "0"),
                     (6, None, "0"), (7, "ab", "0"), (8, "abc", "x"), (9, "abc", "1.0")])
    out = sorted(tuple(r) for r in prepare.clean_dataset(df).collect())
    assert out == [(3, "same text", 1), (4, "same text", 0), (9, "abc", 1)]
    kept = prepare.clean_dataset(df, drop_duplicates=False)
    assert kept.count() == 4


def test_hot_text_matches_brute_force(spark):
    """A third of all rows are copies of one text."""
    rng = random.Random(1)
    rows = [(i, "hot copy" if rng.random() < 0.34 else f"text {rng.randint(0, 300)}",
             str(rng.randint(0, 1))) for i in range(2000)]
    first = {}
    for i, text, label in rows:
        first.setdefault((text, int(label)), i)
    out = prepare.clean_dataset(raw(spark, rows).repartition(7)).collect()
    assert sorted(r["raw_index"] for r in out) == sorted(first.values())


def test_missing_columns(spark):
    with pytest.raises(ValueError, match="label"):
        prepare.clean_dataset(spark.createDataFrame([("a",)], "text_combined string"))


def test_copies_across(spark):
    df = spark.createDataFrame(
        [("a", "One text"), ("a", "other"), ("b", "one  TEXT"), ("b", "new"), ("b", "Other")],
        "phase string, text_combined string",
    )
    assert tuple(prepare.copies_across(df, "phase", ["a"], ["b"]).first()) == (3, 2)


def test_digests_decide_like_texts_and_no_text_is_shuffled(spark):
    texts = ["Ab  c", "ab c", " AB C ", "x", "", None, "long enough", "long enough", "other"]
    labels = [0, 0, 1, 0, 1, 1, 0, None, 7]
    rows = [(k, *row) for k, row in enumerate(zip(texts, labels, strict=True))]
    df = spark.createDataFrame(rows, "raw_index bigint, text_combined string, label bigint")
    narrow = df.select("raw_index", "label", prepare.text_digest(F.col("text_combined")).alias(prepare.DIGEST))
    by_text = prepare.distinct_keys(prepare.cleaned_rows(df, keep=["raw_index"]))
    by_digest = prepare.distinct_keys(prepare.digested_rows(narrow, keep=["raw_index"]))
    assert sorted(by_digest.collect()) == sorted(by_text.collect()) == [(0, 0), (2, 1), (6, 0)]
    assert prepare.cleaning_summary(narrow).collect() == prepare.cleaning_summary(df).collect()
    assert prepare.cleaning_summary(df).first().asDict() == {
        "raw_rows": 9, "cleaned_rows": 3, "rows_removed": 6, "label_0": 2, "label_1": 1
    }


def test_queries_on_digests_move_no_text(spark):
    from labeltext.plans.catalogue import QUERIES

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("label_distribution", "cleaning_summary"):
            plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution()
            lines = plan.optimizedPlan().toString().splitlines()
            join = next(k for k, line in enumerate(lines) if "Join" in line)
            # Texts become digests below the join; nothing above it knows them.
            assert not any("text" in line or "sha2" in line for line in lines[: join + 1]), name
            assert sum("sha2" in line for line in lines[join + 1 :]) == 1, name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
