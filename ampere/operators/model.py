"""Random-forest load model (K10-K12) with ``pyspark.ml``.

Features as in the reference training job: hour of day, day of week
(Sunday = 1 convention of ``dayofweek``), temperature, wind speed,
humidity and a one-hot ISO vector (unseen ISOs kept in an extra slot).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, functions as F

from ampere.functions.timecols import hour_of_day, weekday_sun1
from ampere.operators.clean import assert_min_rows, require_weather

# Fixed values of the reference model.
NUM_TREES = 50
MAX_DEPTH = 10
SEED = 42
MIN_TRAIN_ROWS = 100
CATEGORICAL = ("iso_code",)
NUMERIC = ("hour_of_day", "day_of_week", "temperature", "wind_speed", "humidity")
TEST_EVERY = 5          # one row in five is for the test
TASK_ROWS = 250_000     # training rows a task


def training_frame(df: DataFrame) -> DataFrame:
    """B14 filter + the training-time features."""
    t = require_weather(df)
    return t.withColumns({"hour_of_day": hour_of_day("timestamp_utc"),
                          "day_of_week": weekday_sun1("timestamp_utc")})


def forest_pipeline(label: str = "load_mw", categorical: Sequence[str] = CATEGORICAL,
                    numeric: Sequence[str] = NUMERIC, **forest) -> Pipeline:
    """Categorical columns one-hot (values not seen in training in a slot of
    their own) next to the numeric ones, then a random forest."""
    codes = [f"{c}__code" for c in categorical]
    slots = [f"{c}__slots" for c in categorical]
    return Pipeline(stages=[
        StringIndexer(inputCols=list(categorical), outputCols=codes, handleInvalid="keep"),
        OneHotEncoder(inputCols=codes, outputCols=slots),
        VectorAssembler(inputCols=[*numeric, *slots], outputCol="inputs"),
        RandomForestRegressor(labelCol=label, featuresCol="inputs", **forest)])


def split_rows(df: DataFrame, row_key: str = "id", every: int = TEST_EVERY) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by the modulo of an integer row key: the same split
    for any partitioning."""
    test = F.pmod(F.col(row_key), F.lit(every)) == 0
    return df.where(~test), df.where(test)


def dealt_evenly(df: DataFrame, along: Sequence[str] = (*CATEGORICAL, *NUMERIC),
                 task_rows: int | None = None) -> DataFrame:
    """Rows in partitions of about ``task_rows`` at most; where none holds more, ``df`` stays as it is.

    A scan makes about as many partitions as there are cores, up to its byte limit, and the forest holds
    a partition's binned rows and bag counts as one block and walks them in every pass: without this,
    task and block grow with the table.  Rows alike in ``along`` follow each other, since rows that end in
    the same nodes are counted faster in a row than mixed."""
    task_rows = task_rows or TASK_ROWS
    sizes = df.select(F.spark_partition_id().alias("_p")).groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    rows, largest, parts = sizes.agg(F.sum("_n"), F.max("_n"), F.count("_n")).first()
    if (largest or 0) <= task_rows:
        return df
    return df.repartition(max(parts, math.ceil(rows / task_rows))).sortWithinPartitions(*along)


def train_and_evaluate(df: DataFrame, num_trees: int = NUM_TREES, max_depth: int = MAX_DEPTH,
                       seed: int = SEED, row_key: str = "id"):
    """K10 + K11: fit on four fifths of the rows; return (model, metrics
    DataFrame with rmse, mae, train_rows, test_rows)."""
    t = training_frame(df)
    assert_min_rows(t, MIN_TRAIN_ROWS)          # B14: too little weather -> stop
    train, test = split_rows(t, row_key)
    model = forest_pipeline(numTrees=num_trees, maxDepth=max_depth, seed=seed).fit(dealt_evenly(train))
    return model, evaluate(model.transform(test), train)


def evaluate(preds: DataFrame, train: DataFrame | None = None) -> DataFrame:
    """K11 as one aggregate: RMSE and MAE of ``prediction`` vs ``load_mw``
    (the formulas of ``RegressionEvaluator``), with the row counts."""
    err = F.col("prediction") - F.col("load_mw")
    m = preds.agg(F.sqrt(F.avg(err * err)).alias("rmse"), F.avg(F.abs(err)).alias("mae"),
                  F.count(F.lit(1)).alias("test_rows"))
    if train is not None:
        m = m.withColumn("train_rows", train.select(F.count(F.lit(1))).scalar())
    return m


def save_model(model: PipelineModel, path: str) -> str:
    """Overwrite-save."""
    model.write().overwrite().save(path)
    return path


def load_and_score(path: str, df: DataFrame) -> DataFrame:
    """Reload a saved pipeline and score rows with weather."""
    return PipelineModel.load(path).transform(training_frame(df))
