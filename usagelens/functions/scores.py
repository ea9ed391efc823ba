"""Aggregate expressions for model quality and goodness of fit."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def f1_score(tp: Column, fp: Column, fn: Column) -> Column:
    """2TP / (2TP + FP + FN), NULL when the denominator is 0."""
    return F.try_divide(2.0 * tp, 2.0 * tp + fp + fn)


def hard_auc(label: Column, prediction: Column) -> Column:
    """Area under the two-point ROC curve of 0/1 predictions: (TPR + TNR) / 2.

    NULL unless both classes are present.
    """
    label, prediction = label.cast("double"), prediction.cast("double")
    tpr = F.avg(F.when(label == 1, (prediction == 1).cast("double")))
    tnr = F.avg(F.when(label == 0, (prediction == 0).cast("double")))
    return (tpr + tnr) / 2


def r_squared(truth: Column, guess: Column) -> Column:
    """1 - sum((truth - guess)^2) / sum((truth - mean(truth))^2) over pairs without NULL.

    A constant ``truth`` gives 1 for a perfect guess, else 0.
    """
    both = truth.isNotNull() & guess.isNotNull()
    residual = F.sum((truth - guess) * (truth - guess))
    paired = F.when(both, truth)
    # var_pop merges centred moments, so this has no cancellation of large squares.
    spread = F.var_pop(paired) * F.count(paired)
    flat = F.when(residual == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    return F.when(spread == 0, flat).otherwise(1 - F.try_divide(residual, spread))


def correlation(x: Column, y: Column) -> Column:
    """Pearson correlation over pairs without NULL, NULL when either side is constant.

    The built-in ``corr`` divides by zero on a constant, which ANSI mode refuses.
    """
    both = x.isNotNull() & y.isNotNull()
    deviations = F.stddev_pop(F.when(both, x)) * F.stddev_pop(F.when(both, y))
    return F.try_divide(F.covar_pop(x, y), deviations)
