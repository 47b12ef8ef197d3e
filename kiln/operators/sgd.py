"""Linear regression by stochastic gradient descent, a row at a time."""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.operators.barrier import run_steps
from kiln.operators.boost import _numbers
from kiln.operators.kernel import KernelMap, SupportModel
from kiln.operators.network import epoch_picks


def descend(state: list[np.ndarray], batch: np.ndarray, n: int, alpha: float, eta0: float, power: float, tol: float, patience: int) -> list[np.ndarray]:
    """Squared-loss steps over the rows (x, 1, y) of a batch, one after the other,
    at the rate eta0 / t^power with an L2 penalty ``alpha`` (not on the constant).
    state: weights; (steps done, loss of this epoch, best loss, epochs without
    gain, stopped). After an epoch of n rows whose mean loss is not below the best
    by ``tol``, for ``patience`` epochs in a row, nothing moves any more."""
    w, (t, loss, best, idle, stopped) = state[0].copy(), state[1]
    if stopped:
        return state
    shrink = np.append(np.full(len(w) - 1, alpha), 0.0)
    for row in batch:
        x, y = row[:-1], row[-1]
        e = x @ w - y
        loss += 0.5 * e * e
        t += 1
        w = w - eta0 / t ** power * (e * x + shrink * w)
        if t % n == 0:
            idle = idle + 1 if loss / n > best - tol else 0
            best, loss = min(best, loss / n), 0.0
            if idle >= patience:
                stopped = 1.0
                break
    return [w, np.array([t, loss, best, idle, stopped])]


@dataclass(frozen=True)
class SgdRegressor:
    """The library's defaults (at most 1,000 epochs, stopped when five in a row
    gain less than 0.001). Features are standardised first, without which the steps
    diverge; the weights are given for the features as they are. Rows without a label are left out."""
    epochs: int = 1000
    alpha: float = 1e-4
    eta0: float = 0.01
    power: float = 0.25
    tol: float = 1e-3
    patience: int = 5
    seed: int = 0
    label: str = "label"
    features: str = "features"

    def fit(self, df: DataFrame) -> SupportModel:
        rows = (df.select(_numbers(df, self.features).alias("x"), F.col(self.label).cast("double").alias("y"))
                  .where("y IS NOT NULL AND NOT isnan(y)").withColumn("h", F.xxhash64("x", "y")))
        stats = (rows.select(F.posexplode("x").alias("f", "v")).groupBy("f").agg(F.avg("v").alias("m"), F.stddev_pop("v").alias("s")).orderBy("f").collect())
        if not stats:
            return SupportModel(self.features, KernelMap(None, None, 0.0), np.zeros(1), 0.0)
        mean, scale = np.array([r["m"] for r in stats]), np.array([r["s"] or 1.0 for r in stats])
        z = F.zip_with(F.zip_with("x", F.lit(mean.tolist()), lambda a, b: a - b), F.lit(scale.tolist()), lambda a, b: a / b)
        row = F.concat(z, F.array(F.lit(1.0), F.col("y")))
        n = rows.count()
        start = [np.zeros(len(mean) + 1), np.array([0.0, 0.0, np.inf, 0.0, 0.0])]
        step = partial(descend, n=n, alpha=self.alpha, eta0=self.eta0, power=self.power, tol=self.tol, patience=self.patience)
        _, (w, _) = run_steps(rows, row, ["h"], start, partial(epoch_picks, epochs=self.epochs, batch=min(n, 1024), seed=self.seed), step)
        slope = w[:-1] / scale
        return SupportModel(self.features, KernelMap(None, None, 0.0), np.append(slope, w[-1] - slope @ mean), 0.0)
