"""The quality columns of the model queries are true for working models only."""

import pytest
from pyspark.sql import functions as F

from astroframe.plans.checks import ml_models as Q
from astroframe.plans.checks.runs import good


@pytest.fixture(scope="module")
def labels(spark):
    """Four classes, the first with half of the rows."""
    return spark.range(2000).select("id", F.when(F.col("id") % 2 == 0, 0).otherwise(1 + F.col("id") % 6 / 2).cast("int").alias("label"))


def test_constant_and_shuffled_answers_fail(labels):
    right = labels.withColumn("prediction", F.when(F.col("id") % 20 == 3, 0).otherwise(F.col("label")))
    constant = labels.withColumn("prediction", F.lit(0))
    shuffled = labels.withColumn("prediction", (F.xxhash64("id") % 4).cast("int"))
    assert Q.accurate(right)
    for bad in (constant, shuffled):
        assert not Q.accurate(bad) and not Q.accurate(bad, 0.0, 0.1)


def test_scores_that_ignore_the_rows_fail(spark):
    df = spark.range(2000).select("id", (F.abs(F.randn(1)) + F.when(F.col("id") < 20, 9).otherwise(0)).alias("x"))
    rare = Q.most_extreme(df, ["x"])
    assert Q.low_share(df.withColumn("anomaly_score_raw", -F.col("x")), rare) == 1.0
    for score in (F.lit(0.0), F.xxhash64("id")):
        assert Q.low_share(df.withColumn("anomaly_score_raw", score), rare) < 0.8
    usual = F.col("id") >= 20
    assert Q.flag_shares(df, F.col("x") > 8, usual) == (0.0, 1.0)
    same = Q.flag_shares(df, F.pmod(F.xxhash64("id"), F.lit(100)) == 0, usual)
    assert not same[1] >= 0.3


def test_metrics_of_a_constant_answer_fail():
    assert good({"accuracy": 0.95, "confusion_matrix": [[50, 0], [5, 45]]})
    assert not good({"accuracy": 0.9, "confusion_matrix": [[90, 0], [10, 0]]})
