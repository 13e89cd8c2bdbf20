"""The scan for secrets in a session that has observed something."""

from pyspark.sql import Observation, functions as F

from tractwise.llm import secrets


def test_a_session_that_observed_does_not_go_to_tasks(spark):
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 3}
    found = spark.range(40).select(
        F.col("id").alias("doc_id"), F.lit(0).alias("start"), F.lit(16).alias("end"), F.lit("x").alias("candidate"),
        *[(F.col("id") % (2 + i)).cast("double").alias(f) for i, f in enumerate(secrets.FEATURES)],
        (F.col("id") % 2).cast("double").alias("label"))
    model = secrets.train(found, trees=3, depth=2)
    scored = secrets.scan(found, model)
    assert scored.count() == 40 and not model.stages[-1].hasSummary
    assert scored.where("probability between 0 and 1").count() == 40
