"""Churn classifier: assembly, grid search, scoring and flat predictions."""

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.operators.features import feature_names
from usagelens.operators.sampling import oversample, random_split
from usagelens.storage import materialize


def assemble(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Adds the vector ``features``."""
    return VectorAssembler(inputCols=columns or feature_names(), outputCol="features").transform(df)


def hard_evaluator() -> BinaryClassificationEvaluator:
    """ROC-AUC of the 0/1 prediction."""
    return BinaryClassificationEvaluator(
        labelCol="label", rawPredictionCol="prediction", metricName="areaUnderROC"
    )


def train(
    df: DataFrame,
    trees: tuple[int, ...] = (50, 100),
    depths: tuple[int, ...] = (5, 10),
    folds: int = 3,
    parallelism: int = 2,
    seed: int = 42,
    fold_by: list[str] | None = None,
) -> CrossValidatorModel:
    """Random forest with cross-validated number of trees and depth.

    Every fit is a distributed Spark job; ``parallelism`` fits run side by side. With ``fold_by``
    rows with the same key share a fold, so copies of one row are never learned from and judged
    by at once, and folds stay the same when tasks run again; without it folds are random.
    """
    forest = RandomForestClassifier(
        featuresCol="features",
        labelCol="label",
        predictionCol="prediction",
        probabilityCol="probability",
        seed=seed,
    )
    grid = (
        ParamGridBuilder()
        .addGrid(forest.numTrees, list(trees))
        .addGrid(forest.maxDepth, list(depths))
        .build()
    )
    search = CrossValidator(
        estimator=forest,
        estimatorParamMaps=grid,
        evaluator=hard_evaluator(),
        numFolds=folds,
        parallelism=parallelism,
        seed=seed,
    )
    # The search caches its folds, so leave out what no fit reads.
    read = df.select("features", "label")
    if fold_by:
        search.setFoldCol("fold")
        read = df.select("features", "label", fold_of(fold_by, folds).alias("fold"))
    return search.fit(read)


def fold_of(key: list[str], folds: int) -> Column:
    """The number of the fold, from 0, that rows with this key are in."""
    return F.pmod(F.xxhash64(*[F.col(c).cast("string") for c in key]), F.lit(folds)).cast("int")


def score(model, df: DataFrame) -> DataFrame:
    """Adds prediction, probability and raw prediction."""
    return model.transform(df)


def flatten_predictions(df: DataFrame) -> DataFrame:
    """Vectors as scalar columns, and the features as one comma-separated text."""
    vectors = ("probability", "rawPrediction", "features")
    kept = [c for c in df.columns if c not in vectors]
    probability, raw = vector_to_array("probability"), vector_to_array("rawPrediction")
    return df.select(
        *kept,
        probability[0].alias("probability_0"),
        probability[1].alias("probability_1"),
        raw[0].alias("rawPrediction_0"),
        raw[1].alias("rawPrediction_1"),
        F.concat_ws(",", vector_to_array("features").cast("array<string>")).alias("features_str"),
    )


def train_and_score(
    features: DataFrame,
    factor: float = 20.0,
    share: float = 0.8,
    seed: int = 42,
    split_first: bool = False,
    learn_rows: int | None = None,
    key: list[str] | None = None,
    **grid,
) -> tuple[CrossValidatorModel, DataFrame]:
    """Balance, split, fit and score a feature table.

    By default class 1 is oversampled before the split, so copies of one row can
    land in both parts; ``split_first=True`` balances the training part only. The
    split writes the sampled rows, and the training part is written before the many
    passes of the search: what a part holds is then fixed even if executors are
    lost midway. ``learn_rows`` bounds the training rows the search learns from, on
    average, to a random sample of all of them; the whole test part is scored. Copies and folds
    follow from ``key``, by default date and subscriber where the table has them.
    """
    key = key or [c for c in ("Date", "User") if c in features.columns] or None
    if split_first:
        train_part, test_part = random_split(features, share, seed)
        train_part = oversample(train_part, "label", factor, seed, key)
    else:
        balanced = oversample(features, "label", factor, seed, key)
        train_part, test_part = random_split(balanced, share, seed)
    train_part = materialize(train_part, "train")
    if learn_rows is not None and (n := train_part.count()) > learn_rows:
        train_part = train_part.sample(learn_rows / n, seed)
    model = train(assemble(train_part), seed=seed, fold_by=key, **grid)
    return model, score(model, assemble(test_part))
