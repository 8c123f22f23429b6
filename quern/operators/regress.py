"""Linear models from sufficient statistics.

Two passes over the rows: one for the mean and deviation of every term, one for the matrix of products of the
standardised terms (a row per pair of terms from each task).  Only that matrix, a few thousand numbers whatever the
number of rows, reaches the driver, where the normal equations are solved.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def terms(features: int, degree: int) -> list[tuple[int, ...]]:
    """All products of up to ``degree`` features, as places of the features."""
    return [t for d in range(1, degree + 1) for t in combinations_with_replacement(range(features), d)]


class Design:
    """The terms of a model over the columns of a table; ``shift`` and ``scale`` change the features before they are multiplied."""

    def __init__(self, features: list[str], label: str, degree: int = 1, shift=None, scale=None):
        self.features, self.label, self.terms = features, label, terms(len(features), degree)
        n = len(features)
        self.shift, self.scale = (np.zeros(n), np.ones(n)) if shift is None else (np.asarray(shift), np.asarray(scale))

    def matrix(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """(terms, label) of the rows that miss nothing."""
        held = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in range(batch.num_columns)], axis=1)
        held = held[~np.isnan(held).any(1)]
        x = (held[:, :-1] - self.shift) / self.scale
        return np.stack([x[:, list(t)].prod(1) for t in self.terms], axis=1), held[:, -1]

    def summed(self, df: DataFrame, part: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
        """Sum over all rows of what ``part`` makes of a batch: an array of a fixed size."""

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = 0
            for batch in batches:
                total = total + part(*self.matrix(batch))
            if not np.isscalar(total):
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["i", "v"])

        columns = [F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate([*self.features, self.label])]
        rows = df.select(*columns).mapInArrow(work, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).toArrow()
        out = np.zeros(rows.num_rows)
        out[rows["i"].to_numpy()] = rows["v"].to_numpy()
        return out


def standard(total: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """(n, means, deviations) from sums of 1, the values and their squares; a constant has the deviation 1."""
    n, sums, squares = total[0], *np.split(total[1:], 2)
    mean = sums / max(n, 1)
    spread = np.sqrt(np.maximum(squares / max(n, 1) - mean * mean, 0))
    return n, mean, np.where(spread > 1e-12 * np.maximum(np.abs(mean), 1), spread, 1)


def moments(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    held = np.column_stack((x, y))
    return np.concatenate(([len(y)], held.sum(0), (held * held).sum(0)))


class Model:
    """Least squares with the penalty ``alpha`` on the squared coefficients of the terms as they are."""

    def __init__(self, df: DataFrame, design: Design, alpha: float = 0.0):
        self.design = design
        total = design.summed(df, moments)
        if not total.size:
            raise ValueError("no complete rows to fit")
        self.n, mean, spread = standard(total)
        self.mean, self.spread, self.label_mean = mean[:-1], spread[:-1], mean[-1]

        def products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            z = np.column_stack(((x - self.mean) / self.spread, y - self.label_mean))
            return z.T @ z

        k = len(design.terms) + 1
        gram = design.summed(df, products).reshape(k, k)
        a, b = gram[:-1, :-1], gram[:-1, -1]
        self.z = np.linalg.lstsq(a + alpha * np.diag(1 / self.spread ** 2), b, rcond=1e-12)[0]
        self.coefficients = self.z / self.spread
        self.intercept = self.label_mean - self.mean @ self.coefficients
        self.r2 = 1 - (gram[-1, -1] - 2 * self.z @ b + self.z @ a @ self.z) / gram[-1, -1] if gram[-1, -1] else 0.0

    def score(self, test: DataFrame) -> float:
        """R² on other rows, from the residuals themselves; 0 if their label does not vary."""

        def residuals(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            off = y - self.label_mean - (x - self.mean) / self.spread @ self.z
            far = y - self.label_mean
            return np.array([len(y), off @ off, far.sum(), far @ far])

        total = self.design.summed(test, residuals)
        if not total.size:
            return 0.0
        n, errors, far, squares = total
        varied = squares - far * far / n if n else 0.0
        return 1 - errors / varied if varied > 0 else 0.0


def _report(df: DataFrame, names: list[str], values: list[float]) -> DataFrame:
    return df.sparkSession.createDataFrame(
        [(n, float(v)) for n, v in zip(names, values)], "term string, value double")


def fit(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """Least squares: one row per coefficient, plus the intercept and R².  Rows that miss a value are left out."""
    model = Model(df, Design(features, label))
    return _report(df, [*features, "intercept", "r2"], [*model.coefficients, model.intercept, model.r2])


def fit_polynomial(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """Scale, expand to degree 2, least squares: R² on the same rows."""
    _, mean, spread = standard(Design(features, label).summed(df, moments))
    return _report(df, ["r2"], [Model(df, Design(features, label, 2, mean[:-1], spread[:-1])).r2])


def is_test(*key: str) -> Column:
    """15 % of the rows by a hash of their key: the same rows on every run."""
    return F.substring(F.md5(F.concat_ws("-", *key)), 1, 4) < "2666"  # 0x2666 / 0x10000 = 0.15


def ridge(train: DataFrame, test: DataFrame, features: list[str], label: str, alpha: float, degree: int = 1) -> DataFrame:
    """Ridge regression: coefficients (degree 1) and R² on the test rows."""
    model = Model(train, Design(features, label, degree), alpha)
    score = model.score(test)
    if degree > 1:
        return _report(train, ["r2"], [score])
    return _report(train, [*features, "intercept", "r2"], [*model.coefficients, model.intercept, score])
