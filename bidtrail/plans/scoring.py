"""Lead model, boosted trees and title classifier, as MLlib pipelines."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier, OneVsRest
from pyspark.ml.feature import FeatureHasher, HashingTF, StandardScaler, StopWordsRemover, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored

# Inputs of the lead model.  site_lead_kw is left out: it is the answer of an earlier visit.
LEAD_TEXTS = (
    "ad_exchange_name city_name state_name keyword_name ua_browser_group ua_os_group bid_click_kw site_open_kw "
    "site_search_kw site_click_kw"
).split()
LEAD_NUMBERS = "ad_slot_width ad_slot_height ad_slot_floor_price bidding_price paying_price".split()
HASHED_FEATURES = 64
# Training length of the models.
EPOCHS = 5
TREES = 5
TITLE_FEATURES = 4096
# Rows of a task while the lead model is fitted: it keeps them as dense vectors of HASHED_FEATURES numbers, some 50 MB.
TRAINING_ROWS = 100_000


def lead_pipeline(epochs: int = EPOCHS, hidden: int = 16) -> Pipeline:
    """Feed-forward network for a 0/1 column `label`.  Hashing needs no vocabulary, so it does not grow with the data."""
    return Pipeline(
        stages=[
            FeatureHasher(inputCols=[*LEAD_TEXTS, *LEAD_NUMBERS], outputCol="hashed", numFeatures=HASHED_FEATURES),
            StandardScaler(inputCol="hashed", outputCol="features"),
            MultilayerPerceptronClassifier(layers=[HASHED_FEATURES, hidden, 2], maxIter=epochs, seed=7),
        ]
    )


def train_lead_model(rows: DataFrame, path: str | None = None, epochs: int = EPOCHS) -> PipelineModel:
    """Fit on rows with a 0/1 column `label`; save the model if a path is given.

    Training passes over its rows several times, so they are stored first.  A stored row takes a few bytes and many times
    that while the model is fitted, so rows are dealt out by number, not by the size of their files.
    """
    needed = stored(rows.select("label", *LEAD_TEXTS, *LEAD_NUMBERS))
    model = lead_pipeline(epochs).fit(needed.repartition(training_parts(needed)))
    if path:
        model.write().overwrite().save(path)
    return model


def training_parts(rows: DataFrame, part_rows: int = TRAINING_ROWS) -> int:
    """Tasks that training is spread over; no fewer than the cluster's own shuffle partitions where each has 1,000 rows."""
    n, tasks = rows.count(), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(tasks, n // 1_000), -(-n // part_rows))


def score_leads(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Append predict ('TRUE' or 'FALSE'), false_prob and true_prob."""
    probability = vector_to_array("probability")
    scored = model.transform(rows)
    return scored.select(
        *rows.columns,
        F.when(F.col("prediction") == 1, "TRUE").otherwise("FALSE").alias("predict"),
        F.get(probability, F.lit(0)).alias("false_prob"),
        F.get(probability, F.lit(1)).alias("true_prob"),
    )


def train_boosted_trees(rows: DataFrame, trees: int = TREES, depth: int = 5):
    """Boosted trees for any number of classes (column label, numbered from 0): one binary model per class."""
    binary = GBTClassifier(maxIter=trees, maxDepth=depth, seed=7)
    return OneVsRest(classifier=binary, parallelism=4).fit(rows.select("label", "features"))


def mispredictions(scored: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Wrong predictions counted by actual and predicted class."""
    wrong = scored.where(~F.col(actual).eqNullSafe(F.col(predicted)))
    return wrong.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count("*").alias("n")
    )


def title_pipeline(size: int = TITLE_FEATURES) -> Pipeline:
    """Hashed word counts and a classifier for columns title and label.

    Hashing needs no vocabulary: no word is left out however rare, and the model's size does not follow the data.
    """
    return Pipeline(
        stages=[
            Tokenizer(inputCol="title", outputCol="words"),
            StopWordsRemover(inputCol="words", outputCol="content"),
            HashingTF(inputCol="content", outputCol="features", numFeatures=size),
            LogisticRegression(maxIter=20),
        ]
    )


def classify_titles(model: PipelineModel, titles: DataFrame) -> DataFrame:
    """Class and class probabilities of each title; works on a table or a stream."""
    kept = titles.columns
    return model.transform(titles).select(
        *kept, F.col("prediction").cast("int").alias("predicted"), vector_to_array("probability").alias("probabilities")
    )
