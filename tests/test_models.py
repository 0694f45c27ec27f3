from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from bidtrail.plans import scoring


def lead_table(spark):
    rows = spark.range(200).withColumn("label", (F.col("id") % 2).cast("double"))
    for name in scoring.LEAD_TEXTS:
        rows = rows.withColumn(name, F.when(F.col("label") == 1, "yes").otherwise("no"))
    for name in scoring.LEAD_NUMBERS:
        rows = rows.withColumn(name, F.when(F.col("id") % 5 != 0, F.col("label") * 3))
    return rows


def test_lead_model_learns_and_survives_saving(spark, rows, tmp_path):
    table = lead_table(spark)
    model = scoring.train_lead_model(table, str(tmp_path / "m"), epochs=30)
    scored = scoring.score_leads(model, table)
    assert scored.columns == [*table.columns, "predict", "false_prob", "true_prob"]
    assert scored.where("abs(false_prob + true_prob - 1) > 1e-9").isEmpty()
    named = scored.withColumn("actual", F.when(F.col("label") == 1, "TRUE").otherwise("FALSE"))
    assert scoring.mispredictions(named, "actual", "predict").count() == 0
    again = scoring.score_leads(PipelineModel.load(str(tmp_path / "m")), table)
    assert rows(again) == rows(scored)


def test_mispredictions(spark, rows):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("a", "b"), ("b", None), (None, None)], "x string, y string")
    assert rows(scoring.mispredictions(df, "x", "y")) == [("a", "b", 2), ("b", None, 1)]


def test_boosted_trees_take_three_classes(spark):
    data = [(float(i % 3), Vectors.dense([i % 3 + (i % 7) * 0.01, 1.0])) for i in range(90)]
    df = spark.createDataFrame(data, ["label", "features"])
    scored = scoring.train_boosted_trees(df, depth=2).transform(df)
    assert scoring.mispredictions(scored, "label", "prediction").count() == 0


def test_titles(spark):
    titles = spark.createDataFrame([("line cook wanted", 0.0), ("java developer job", 1.0)] * 20, "title string, label double")
    model = scoring.title_pipeline(size=64).fit(titles)
    odd = spark.createDataFrame([("the of and",), ("cook",)], "title string")
    scored = scoring.classify_titles(model, odd).collect()
    assert len(scored) == 2 and all(abs(sum(r["probabilities"]) - 1) < 1e-9 for r in scored)


def test_training_rows_are_dealt_out_by_number(spark, monkeypatch):
    """Rows of one small file were all kept by one task while the model was fitted."""
    table = spark.range(10).withColumn("n", F.lit(1))
    assert [scoring.training_parts(table, n) for n in (10, 9, 3, 1)] == [1, 2, 4, 10]
    given = []
    pipeline = scoring.lead_pipeline()
    monkeypatch.setattr(type(pipeline), "fit", lambda self, rows: given.append(rows.rdd.getNumPartitions()) or pipeline)
    monkeypatch.setattr(scoring, "training_parts", lambda rows: -(-rows.count() // 50))
    scoring.train_lead_model(lead_table(spark))
    assert given == [4]
