import pytest
from pyspark.sql import functions as F

from labeltext.functions import scoring as S


@pytest.mark.parametrize(
    "score, kind, expected",
    [(1.23456, "decision_function", "77.5%"), (-1.5, "decision_function", "81.8%"),
     (0.91, "probability", "91.0%"), (None, "probability", "N/A"), (0.0, None, "50.0%"),
     (250.0, "confidence", "100.0%"), (87.0, "confidence", "87.0%"), (-3.0, "probability", "0.0%"),
     (0.1225, "probability", "12.2%")],
)
def test_confidence(spark, score, kind, expected):
    df = spark.createDataFrame([(score, kind)], "s double, k string")
    text = S.confidence_text(F.col("s"), F.col("k"))
    assert df.select(text).first()[0] == expected


def test_names_and_finite(spark):
    df = spark.createDataFrame([(0, 1.0), (1, float("nan")), (7, float("inf")), (None, None)],
                               "p bigint, s double")
    rows = df.select(S.label_name(F.col("p")), S.display_name(F.col("p")), S.finite(F.col("s")))
    assert [tuple(r) for r in rows.collect()] == [
        ("legitimate", "Legitimate", 1.0), ("phishing", "Phishing", None), ("7", "Unknown", None),
        (None, "Unknown", None),
    ]
