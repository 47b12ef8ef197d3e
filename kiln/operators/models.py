"""Regression baselines with ``pyspark.ml`` (M1-M16): splits, linear models
with scikit-learn-equivalent penalties, tree ensembles, metrics, parameter
grids, random search, importances. The single regression tree is in ``tree.py``.

Fitting runs on the executors (one aggregation pass per optimiser iteration
or tree level); the driver holds only parameters and small result tables.
"""

from __future__ import annotations

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.functions.columns import hash8
from kiln.operators.boost import Booster
from kiln.operators.relational import ranked

SPARK_MAX_DEPTH = 30  # Spark's tree depth limit; deeper/unlimited settings are clamped


def holdout(df: DataFrame, frac: float = 0.2, seed: int = 0, id_col: str = "id",
            name: str = "split") -> DataFrame:
    """M1: seeded split by a hash of the row id: stable under repartitioning
    and recomputation (``randomSplit`` depends on partition layout)."""
    cut = f"{min(int(frac * 2 ** 32), 2 ** 32 - 1):08x}"
    return df.withColumn(name, F.when(hash8(seed, id_col) < cut, F.lit("test")).otherwise(F.lit("train")))


def assemble(df: DataFrame, cols, out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)


def label_stats(df: DataFrame, label: str) -> tuple[float, int]:
    """(population sd of the label, row count): two numbers for the penalty mappings."""
    r = df.agg(F.stddev_pop(label).alias("sd"), F.count(F.lit(1)).alias("n")).first()
    return float(r.sd or 0.0), int(r.n)


def ols(label: str = "label", features: str = "features") -> LinearRegression:
    """M2: ordinary least squares with intercept (normal equations)."""
    return LinearRegression(featuresCol=features, labelCol=label, solver="normal", regParam=0.0)


def lasso(alpha: float = 0.1, label: str = "label", features: str = "features") -> LinearRegression:
    """M3: ``(1/2n)||y - Xw||^2 + alpha ||w||_1`` (scikit-learn ``Lasso``)."""
    return LinearRegression(featuresCol=features, labelCol=label, regParam=alpha, elasticNetParam=1.0,
                            standardization=False, maxIter=1000, tol=1e-10)


def ridge(alpha: float, sd_y: float, n: int, label: str = "label", features: str = "features") -> LinearRegression:
    """M4: ``||y - Xw||^2 + alpha ||w||^2`` (scikit-learn ``Ridge``).

    Spark scales the label by its sd inside the solver, so the penalty maps to
    ``regParam = alpha * sd_y / n``.
    """
    return LinearRegression(featuresCol=features, labelCol=label, regParam=alpha * sd_y / n,
                            elasticNetParam=0.0, standardization=False, solver="normal")


def enet(alpha: float, rho: float, sd_y: float, label: str = "label", features: str = "features") -> LinearRegression:
    """M5: scikit-learn ``ElasticNet(alpha, l1_ratio=rho)``:
    ``lam = a*rho + sd*a*(1-rho)``, ``elasticNetParam = a*rho / lam``."""
    lam = alpha * rho + sd_y * alpha * (1 - rho)
    return LinearRegression(featuresCol=features, labelCol=label, regParam=lam,
                            elasticNetParam=(alpha * rho / lam) if lam else 0.0,
                            standardization=False, maxIter=1000, tol=1e-10)


def forest(n_trees: int = 100, max_depth: int | None = None, label: str = "label",
           features: str = "features", seed: int = 0, **kw) -> RandomForestRegressor:
    """M6: random forest; ``max_depth=None`` (unlimited) is clamped to Spark's 30."""
    d = SPARK_MAX_DEPTH if max_depth is None else min(int(max_depth), SPARK_MAX_DEPTH)
    return RandomForestRegressor(featuresCol=features, labelCol=label, numTrees=n_trees, maxDepth=d,
                                 seed=seed, **kw)


def bagged_trees(n: int = 10, label: str = "label", features: str = "features", seed: int = 0,
                 max_depth: int = SPARK_MAX_DEPTH) -> RandomForestRegressor:
    """M7: bagging of full trees: bootstrap rows, every feature at each split."""
    return RandomForestRegressor(featuresCol=features, labelCol=label, numTrees=n, featureSubsetStrategy="all",
                                 bootstrap=True, subsamplingRate=1.0, maxDepth=max_depth, seed=seed)


def boosted(kind: str = "leaf", n: int = 100, label: str = "label", features: str = "features") -> Booster:
    """M8: the two external boosters with their defaults: ``depth`` grows six levels
    at step 0.3 with an L2 penalty of 1 from a first margin of 0.5, ``leaf`` up to 80
    leaves best first at step 0.1 with 20 rows in each from the mean."""
    if kind == "depth":
        return Booster(trees=n, step=0.3, max_depth=6, l2=1.0, min_weight=1.0, base=0.5, label=label, features=features)
    return Booster(trees=n, step=0.1, max_leaves=80, min_rows=20, label=label, features=features)


def evaluate(pred: DataFrame, y: str = "label", yhat: str = "prediction", by=None) -> DataFrame:
    """MSE, RMSLE (null when a value is negative, where it is undefined)
    and R2 per group, in one aggregate."""
    by = [by] if isinstance(by, str) else list(by or [])
    yy, pp = F.col(y).cast("double"), F.col(yhat).cast("double")
    g = pred.groupBy(*by) if by else pred.groupBy()
    return g.agg(F.avg((yy - pp) ** 2).alias("mse"),
                 F.when(F.min(F.least(yy, pp)) >= 0,
                        F.sqrt(F.avg((F.log1p(yy) - F.log1p(pp)) ** 2))).alias("rmsle"),
                 (F.lit(1.0) - F.try_divide(F.sum((yy - pp) ** 2), F.var_pop(yy) * F.count(F.lit(1)))).alias("r2"))


def leaderboard(models: dict, train: DataFrame, valid: DataFrame, label: str = "label") -> DataFrame:
    """Fit each estimator on ``train``; MSE/RMSLE/R2 on train and validation.
    Every model is fitted and measured here, so that callers may let go of cached
    tables; the result is two rows for each."""
    rows = []
    for name, est in models.items():
        m = est.fit(train)
        both = (m.transform(train).withColumn("dataset", F.lit("training"))
                .unionByName(m.transform(valid).withColumn("dataset", F.lit("validation"))))
        rows += [(name, r.dataset, r.mse, r.rmsle, r.r2) for r in evaluate(both, label, "prediction", "dataset").collect()]
    return train.sparkSession.createDataFrame(rows, "model string, dataset string, mse double, rmsle double, r2 double")


def param_grid(spark, lists: dict) -> DataFrame:
    """Every combination of the listed values. Each list is exploded in
    turn from one seed row, so the grid is built in a single task without a
    join (a cross join of parallelized lists multiplies their partitions)."""
    out = spark.range(1).select()
    for name, vals in lists.items():
        out = out.withColumn(name, F.explode(F.array(*[F.lit(v) for v in vals])))
    return out


def sample_settings(grid: DataFrame, n: int, seed: int = 0) -> list[dict]:
    """n settings drawn without replacement (hash order, bounded to n rows)."""
    rows = (grid.withColumn("_h", F.xxhash64(*[F.col(c).cast("string") for c in grid.columns], F.lit(seed)))
                .orderBy("_h").limit(n).drop("_h").collect())
    return [r.asDict() for r in rows]


def forest_params(est: RandomForestRegressor, s: dict) -> dict:
    """Map one scikit-learn forest setting to Spark parameters (min_samples_split
    has no Spark counterpart and is not applied)."""
    # scikit-learn's regressor "auto" means every feature
    feat = {"auto": "all", "sqrt": "sqrt", "log2": "log2"}.get(s.get("max_features"), "auto")
    d = s.get("max_depth")
    return {est.numTrees: int(s["n_estimators"]), est.featureSubsetStrategy: feat,
            est.maxDepth: SPARK_MAX_DEPTH if d is None else min(int(d), SPARK_MAX_DEPTH),
            est.minInstancesPerNode: int(s["min_samples_leaf"]), est.bootstrap: bool(s["bootstrap"])}


def random_search(est, train: DataFrame, grid: DataFrame, n_iter: int = 100, folds: int = 3, seed: int = 0,
                  label: str = "label", parallelism: int = 4):
    """``n_iter`` sampled settings, k-fold cross-validation, best refit on all
    of ``train``. Returns (best model, list of settings with their mean MSE)."""
    settings = sample_settings(grid, n_iter, seed)
    ev = RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="mse")
    found = CrossValidator(estimator=est, estimatorParamMaps=[forest_params(est, s) for s in settings], evaluator=ev,
                           numFolds=folds, seed=seed, parallelism=parallelism).fit(train)
    return found.bestModel, [s | {"mean_mse": float(m)} for s, m in zip(settings, found.avgMetrics)]


def importances(spark, model, names) -> DataFrame:
    """Forest importances, their population sd across trees, ranked."""
    rows = []
    for t, tree in enumerate(model.trees):
        imp = tree.featureImportances.toArray()
        rows += [(t, i, float(v)) for i, v in enumerate(imp)]
    per_tree = spark.createDataFrame(rows, "tree int, idx int, imp double")
    overall = spark.createDataFrame([(i, names[i], float(v)) for i, v in enumerate(model.featureImportances.toArray())],
                                    "idx int, feature string, importance double")
    sd = per_tree.groupBy("idx").agg(F.stddev_pop("imp").alias("std"))
    return ranked(overall.join(sd, "idx"), "importance", tiebreak=("feature",)).drop("idx")


def membership_ols(df: DataFrame, members, y: str):
    """No-intercept least squares of ``y`` on set membership. ``members``
    is an array column of member names (or a list of nullable name columns,
    melted first); returns (model, member names in feature order)."""
    from pyspark.ml.feature import CountVectorizer
    if not isinstance(members, str):
        df = df.withColumn("_members", F.filter(F.array(*[F.col(c) for c in members]), lambda x: x.isNotNull()))
        members = "_members"
    n = df.select(F.explode(members).alias("m")).agg(F.count_distinct("m")).first()[0]
    cv = CountVectorizer(inputCol=members, outputCol="features", binary=True, minDF=1.0, vocabSize=max(n, 1)).fit(df)
    # the normal equations take 4,096 features at most
    lr = LinearRegression(featuresCol="features", labelCol=y, fitIntercept=False, solver="normal" if n <= 4096 else "l-bfgs")
    return lr.fit(cv.transform(df)), list(cv.vocabulary)


def grid_lists():
    """The reference's forest search space -- fixed values --"""
    n_estimators = [int(200 + i * (2000 - 200) / 9) for i in range(10)]
    max_depth = [int(10 + i * 10) for i in range(11)] + [None]
    return {"n_estimators": n_estimators, "max_features": ["auto", "sqrt"], "max_depth": max_depth,
            "min_samples_split": [2, 5, 10], "min_samples_leaf": [1, 2, 4], "bootstrap": [True, False]}


__all__ = ["holdout", "assemble", "ols", "lasso", "ridge", "enet", "forest", "bagged_trees", "boosted",
           "evaluate", "leaderboard", "param_grid", "random_search",
           "importances", "membership_ols", "grid_lists", "predict_labels"]


def predict_labels(scored: DataFrame, names: list[str], n: int | None = None, seed: int = 0,
                   key: str | None = None, probabilities: str = "probabilities") -> DataFrame:
    """Q15: predicted class index and name (first maximum of the class
    probabilities), for a seeded sample of ``n`` rows (all rows if None)."""
    from kiln.functions.arrays import argmax
    from kiln.operators.relational import sample_n
    rows = sample_n(scored, n, seed=seed, key=key) if n else scored
    lab = F.array(*[F.lit(c) for c in names])
    return (rows.withColumn("predicted", argmax(probabilities))
                .withColumn("predicted_name", F.element_at(lab, F.col("predicted") + 1)))
