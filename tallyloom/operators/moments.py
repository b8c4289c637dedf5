"""Linear models from sums of products: one pass over the rows for any number of folds and penalties.

Everything a penalized least-squares fit needs of its rows is the sum of products of each two features. These sums are
made per fold; those of the training rows of a fold are the total less the fold's own; its held-out error follows from
the fold's own. So a grid of penalties by folds reads the rows once, and each fit is a small system on the driver.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

import numpy as np
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, functions as F

from tallyloom.operators.coding import require_few_levels

ONE, LABEL = "(one)", "(label)"


def moments(df: DataFrame, numeric: list[str], categories: list[str], label: str, by: str) -> DataFrame:
    """(by, left, right, total): sums of products of two features, each pair once, with a 1 and the label among them.

    A level of a category is a feature of its own, named ``category=level``. A row only gives products of the features it
    has, so that a category of many levels costs no more than one of two. Products are summed up before the shuffle.
    """
    one = [(F.lit(ONE), F.lit(1.0)), (F.lit(LABEL), F.col(f"`{label}`").cast("double"))]
    own = [(F.lit(c), F.col(f"`{c}`").cast("double")) for c in numeric]
    levels = [(F.concat(F.lit(f"{c}="), F.col(f"`{c}`").cast("string")), F.lit(1.0)) for c in categories]
    features = [*one, *own, *levels]
    products = [F.struct(a.alias("left"), b.alias("right"), (x * y).alias("product")) for i, (a, x) in enumerate(features) for b, y in features[i:]]
    unfolded = df.select(F.col(f"`{by}`").alias("by"), F.inline(F.array(*products)))
    return unfolded.groupBy("by", "left", "right").agg(F.sum("product").alias("total"))


class Sums:
    """Collected sums of one set of rows."""

    def __init__(self, totals: dict[tuple[str, str], float]):
        self.totals = totals

    def of(self, a: str, b: str) -> float:
        return self.totals.get((a, b), self.totals.get((b, a), 0.0))

    def vector(self, a: str, names: list[str]) -> np.ndarray:
        return np.array([self.of(a, b) for b in names])

    def matrix(self, names: list[str]) -> np.ndarray:
        return np.array([[self.of(a, b) for b in names] for a in names]).reshape(len(names), len(names))

    def levels(self, category: str) -> list[str]:
        """The category's features by falling number of rows, ties by alphabet."""
        found = [(-n, b) for (a, b), n in self.totals.items() if a == ONE and b.startswith(f"{category}=") and n > 0.5]
        return [b for _, b in sorted(found)]

    def features(self, numeric: list[str], categories: list[str]) -> list[str]:
        """Numeric columns and all levels but the last of each category."""
        return [*numeric, *(b for c in categories for b in self.levels(c)[:-1])]


@dataclass
class LinearFit:
    names: list[str]
    coefficients: np.ndarray
    intercept: float

    def rmse(self, rows: Sums) -> float:
        """Error over the rows of ``rows``, from their sums."""
        b, a = self.coefficients, self.intercept
        n, y = rows.of(ONE, ONE), rows.of(ONE, LABEL)
        error = rows.of(LABEL, LABEL) - 2 * b @ rows.vector(LABEL, self.names) - 2 * a * y
        error += b @ rows.matrix(self.names) @ b + 2 * a * (b @ rows.vector(ONE, self.names)) + n * a * a
        return float(np.sqrt(max(error, 0.0) / n))


def _optimum_for(signs: np.ndarray, gram: np.ndarray, target: np.ndarray, l1: float, l2: float) -> np.ndarray | None:
    """The optimum if its coefficients have these signs, else nothing."""
    on = np.flatnonzero(signs)
    b = np.zeros(len(target))
    b[on] = np.linalg.lstsq(gram[np.ix_(on, on)] + l2 * np.eye(len(on)), target[on] - l1 * signs[on], rcond=None)[0]
    left = target - gram @ b - l2 * b
    if (b[on] * signs[on] < 0).any() or np.abs(left - l1 * signs)[on].max(initial=0) > 1e-9 or np.abs(np.delete(left, on)).max(initial=0) > l1 + 1e-12:
        return None
    return b


def _descend(gram: np.ndarray, target: np.ndarray, l1: float, l2: float) -> np.ndarray:
    """The optimum with an absolute penalty: sweeps over the coordinates find the signs, which then give it exactly."""
    b = np.zeros(len(target))
    for sweep in range(100_000):
        most = 0.0
        for j in range(len(b)):
            if gram[j, j] + l2 == 0:
                continue
            pull = target[j] - gram[j] @ b + gram[j, j] * b[j]
            new = np.sign(pull) * max(abs(pull) - l1, 0.0) / (gram[j, j] + l2)
            most, b[j] = max(most, abs(new - b[j])), new
        if most < 1e-13:
            break
        if sweep % 10 == 9 and (exact := _optimum_for(np.sign(b), gram, target, l1, l2)) is not None:
            return exact
    return b


def solve(rows: Sums, names: list[str], strength: float, mix: float, intercept: bool) -> LinearFit:
    """The optimum that ``LinearRegression`` looks for: features and label scaled by their deviations, the penalty by the label's."""
    n = rows.of(ONE, ONE)
    mean, own = rows.vector(ONE, names) / n, rows.of(ONE, LABEL) / n
    gram, target = rows.matrix(names) / n, rows.vector(LABEL, names) / n
    spread, label = np.sqrt(np.maximum(np.diag(gram) - mean**2, 0)), np.sqrt(max(rows.of(LABEL, LABEL) / n - own**2, 0))
    label = label or abs(own) or 1.0
    spread[spread < 1e-12 * np.sqrt(np.maximum(np.diag(gram), 1e-300))] = 0
    if intercept:
        gram, target = gram - np.outer(mean, mean), target - mean * own
    scale = np.divide(1.0, spread, out=np.zeros_like(spread), where=spread > 0)
    gram, target = gram * np.outer(scale, scale), target * scale / label
    l1, l2 = mix * strength / label, (1 - mix) * strength / label
    if l1:
        b = _descend(gram, target, l1, l2)
    else:
        b = np.linalg.lstsq(gram + l2 * np.eye(len(names)), target, rcond=None)[0]
    b = b * label * scale
    return LinearFit(names, b, float(own - mean @ b) if intercept else 0.0)


def linear_grid_metrics(
    rows: DataFrame, numeric: list[str], categories: list[str], model: LinearRegression, points: list[dict], fold_column: str, folds: int,
    most_levels: int = 1_000,
) -> list[list[float]]:
    """Held-out root mean squared error per point and fold, as cross-validation of ``model`` behind the category stages gives it.

    Levels are ordered on the training rows of each fold, and the last has no dummy there; a level that only held-out rows have
    is an error, as in those stages. The driver holds the sums, at most the square of all levels per fold, so
    more than ``most_levels`` of them are refused before any is moved.
    """
    label = model.getLabelCol()
    if categories:
        require_few_levels(rows, categories, most_levels)
    sums: dict[int, dict] = defaultdict(dict)
    for r in moments(rows, numeric, categories, label, fold_column).toLocalIterator():
        sums[r["by"]][r["left"], r["right"]] = r["total"]
    total: dict[tuple[str, str], float] = defaultdict(float)
    for own in sums.values():
        for pair, value in own.items():
            total[pair] += value
    metrics: list[list[float]] = [[] for _ in points]
    for fold in range(folds):
        held = Sums(sums[fold])
        train = Sums({pair: value - held.totals.get(pair, 0.0) for pair, value in total.items()})
        names = train.features(numeric, categories)
        for c in categories:
            if unseen := set(held.levels(c)) - set(train.levels(c)):
                raise ValueError(f"levels that only held-out rows have: {sorted(unseen)[:5]}")
        for values, point in zip(metrics, points):
            chosen = {p.name: v for p, v in point.items()}
            get = lambda name: chosen.get(name, model.getOrDefault(name))
            fit = solve(train, names, get("regParam"), get("elasticNetParam"), get("fitIntercept"))
            values.append(fit.rmse(held))
    return metrics
