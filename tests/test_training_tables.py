"""Tables that a fit reads again and again: tasks of a pass, passes over the rows."""

from pyspark.sql import functions as F
from weather_rows import weather

from driftline.operators import models, split
from driftline.plans import run
from driftline.plans.weather import WEATHER


def test_a_pass_of_a_fit_has_a_task_a_core(spark, monkeypatch):
    seen = []
    fit = models.fit_candidate

    def counted(train, name, **overrides):
        seen.append(train.rdd.getNumPartitions())
        return fit(train, name, **overrides)

    monkeypatch.setattr(models, "fit_candidate", counted)
    # Many small partitions and a single one: neither reaches the fit.
    dealt = weather(spark, 240).repartition(60, "Date")
    for rows in (dealt, dealt.coalesce(1)):
        parts = split.time_split(rows, WEATHER.date, target=WEATHER.target)
        _, told, _ = models.train_candidates(parts, WEATHER, ["logreg"], overrides={"logreg": {"maxIter": 3}})
        assert told.first()["n_rows"] == parts.where("split = 'test'").count()
    assert seen == [spark.sparkContext.defaultParallelism] * 2


def test_partitions_follow_the_rows(spark):
    cores = spark.sparkContext.defaultParallelism
    assert models.training_partitions(spark, 0) == cores
    assert models.training_partitions(spark, cores * models.PARTITION_ROWS) == cores
    assert models.training_partitions(spark, cores * models.PARTITION_ROWS + 1) == 2 * cores


def test_retraining_drops_duplicates_once(spark, monkeypatch):
    rows = weather(spark, 240)
    read = spark.sparkContext.accumulator(0)

    def mark(part):
        for batch in part:
            read.add(batch.num_rows)
            yield batch

    small = {"gbt": {"maxIter": 2}}
    told = run.retrain_recent(rows.mapInArrow(mark, rows.schema), WEATHER, serving_auc=0.5, model_mb=0.5, overrides=small)
    assert told.select(F.col("model_name")).first()[0] == "gbt"
    assert read.value == 240
