import pytest

from labeltext.operators.quality import all_passed, validate_datasets

GOOD = [("some text one", 0), ("some text two", 1)]


def table(spark, rows):
    return spark.createDataFrame(rows, "text_combined string, label bigint")


def test_all_datasets_pass(spark):
    names = {"cleaned": [0, 1], "train": [0, 1, 0], "val": [0, 1], "test": [1, 0]}
    data = {n: table(spark, [(f"{n} email text {i}", v) for i, v in enumerate(labels)])
            for n, labels in names.items()}
    verdicts = validate_datasets(data)
    assert all_passed(verdicts) and verdicts.count() == 4


@pytest.mark.parametrize(
    "rows, reason",
    [
        ([], "empty"),
        ([*GOOD, ("text", None)], "nulls"),
        ([*GOOD, (None, 1)], "nulls"),
        ([*GOOD, ("text", 2)], "invalid_labels"),
        ([("text", 1), ("text b", 1)], "missing_class"),
        ([*GOOD, ("ab", 1)], "short_rows"),
        ([*GOOD, (None, 2), ("ab", 1)], "nulls"),
    ],
)
def test_first_failing_rule(spark, rows, reason):
    verdict = validate_datasets({"d": table(spark, rows)}).first()
    assert not verdict["passed"] and verdict["reason"] == reason


def test_missing_column_and_imbalance(spark):
    verdict = validate_datasets({"d": table(spark, GOOD).drop("label")}).first()
    assert verdict["reason"] == "missing_columns"
    rows = [(f"text {i}", 0) for i in range(11)] + [("text x", 1)]
    verdict = validate_datasets({"d": table(spark, rows)}).first()
    assert verdict["passed"] and verdict["imbalance_warning"]
