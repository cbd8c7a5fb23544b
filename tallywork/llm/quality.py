"""Quality classifier: regularised quadratic discriminant over statistics of whole texts.

Each class is a normal distribution over the standardised statistics. Its covariance is shrunk
towards the pooled covariance and towards a multiple of the identity. The Cholesky factor of each
covariance is computed once, when the model is fitted; a score is the difference of the two log
densities (Mahalanobis distance and log determinant), squashed to 0..1.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallywork.llm.stats import labelled_sample, matrix
from tallywork.llm.texts import arrow_rows

FIT_ROWS = 8000
THRESHOLD = 0.3


@dataclass(frozen=True)
class Gaussian:
    """One class: mean, inverse of the covariance's Cholesky factor, log determinant, log prior."""

    mean: np.ndarray
    whiten: np.ndarray
    log_det: float
    log_prior: float

    def log_density(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) @ self.whiten.T
        return self.log_prior - 0.5 * (np.einsum("ij,ij->i", z, z) + self.log_det)


@dataclass(frozen=True)
class QualityModel:
    """A fitted discriminant; ``classes`` is empty if the labels lacked one of the two classes."""

    centre: np.ndarray
    scale: np.ndarray
    classes: tuple[Gaussian, ...]
    temperature: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Likelihood of label 1, from 0 to 1; 0.5 for all if a class was missing."""
        if not self.classes:
            return np.full(len(x), 0.5)
        z = (x - self.centre) / self.scale
        bad, good = (c.log_density(z) for c in self.classes)
        margin = np.clip((good - bad) / self.temperature, -40, 40)
        return 1 / (1 + np.exp(-margin))


def fit(
    x: np.ndarray,
    y: np.ndarray,
    *,
    to_pooled: float = 0.3,
    to_identity: float = 0.05,
    temperature: float = 4.0,
) -> QualityModel:
    """Fit on statistics ``x`` (rows of texts) and labels ``y`` (0 or 1).

    ``to_pooled`` and ``to_identity`` are the shares of the pooled covariance and of the identity in
    each class's covariance.
    """
    width = x.shape[1]
    if min(np.sum(y == 0), np.sum(y == 1)) < 2:
        return QualityModel(np.zeros(width), np.ones(width), (), temperature)
    centre, scale = x.mean(axis=0), x.std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    z = (x - centre) / scale
    covariances = [np.cov(z[y == k], rowvar=False) for k in (0, 1)]
    shares = [np.mean(y == k) for k in (0, 1)]
    pooled = sum(share * cov for share, cov in zip(shares, covariances, strict=True))
    classes = []
    for k in (0, 1):
        cov = (1 - to_pooled) * covariances[k] + to_pooled * pooled
        level = max(np.trace(cov) / width, 1e-6)
        cov = (1 - to_identity) * cov + to_identity * level * np.eye(width)
        factor = np.linalg.cholesky(cov)
        log_det = 2 * float(np.log(np.diag(factor)).sum())
        classes.append(
            Gaussian(z[y == k].mean(axis=0), np.linalg.inv(factor), log_det, np.log(shares[k]))
        )
    return QualityModel(centre, scale, tuple(classes), temperature)


def fit_quality(docs: DataFrame, labels: DataFrame, *, rows: int = FIT_ROWS) -> QualityModel:
    """Fit on at most ``rows`` labelled documents that are not held out; see ``labelled_sample``."""
    return fit(*labelled_sample(docs, labels, "quality", rows))


def score_quality(
    docs: DataFrame, model: QualityModel, *, keep: list[str], text: str = "text"
) -> DataFrame:
    """Columns ``keep`` and the ``score`` of every whole text, in one pass without a shuffle.

    Rows are scored one by one: repeated rows get equal scores, an empty table gives an empty
    result. A NULL or empty text counts as a text without words and gets the score that the model
    gives to zero statistics. Other columns are not read, whatever their names.
    """

    def make(texts: list[bytes]) -> list[pa.Array]:
        return [pa.array(model.score(matrix(texts)[1]))]

    return arrow_rows(docs, keep, text, make, "score double")
