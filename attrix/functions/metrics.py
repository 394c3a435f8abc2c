"""Classification metrics as aggregate expressions.

They run as ordinary partial/final aggregates, so scoring a validation set of
any size never gathers rows on the driver.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

EPS = 1e-15


def positive_probability(probability_col: str = "probability") -> Column:
    """Probability of the last (positive) class from an MLlib probability vector."""
    arr = vector_to_array(F.col(probability_col))
    return F.element_at(arr, -1)


def log_loss(label: str | Column, p_positive: str | Column, eps: float = EPS) -> Column:
    """Mean binary cross-entropy with probabilities clipped to [eps, 1 - eps]."""
    y = F.col(label) if isinstance(label, str) else label
    p = F.col(p_positive) if isinstance(p_positive, str) else p_positive
    pc = F.least(F.greatest(p.cast("double"), F.lit(eps)), F.lit(1.0 - eps))
    p_true = F.when(y == 1, pc).otherwise(F.lit(1.0) - pc)
    return F.avg(-F.ln(p_true))


def accuracy(label: str | Column, prediction: str | Column) -> Column:
    """Share of rows whose prediction equals the label."""
    y = F.col(label) if isinstance(label, str) else label
    yhat = F.col(prediction) if isinstance(prediction, str) else prediction
    return F.avg(F.when(yhat.cast("double") == y.cast("double"), F.lit(1.0)).otherwise(F.lit(0.0)))
