"""Matching models: logistic regression by Newton steps, forests on Spark ML; store, load with a schema check, score."""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from accordant import policy
from accordant.functions.numbers import round_dp
from accordant.operators.metrics import classification_report, roc_auc
from accordant.session import durable

META_SCHEMA = ("model_name string, model_version string, model_type string, feature_schema_version string, "
               "features array<string>, training_rows long, training_date string, metrics map<string,double>")


#: Decimals of stored coefficients.
DIGITS = 8


@dataclass(frozen=True)
class LinearModel:
    """P(label = 1) = 1 / (1 + exp(-(intercept + weights . features))); missing features count as 0."""

    features: list[str]
    intercept: float
    weights: list[float]
    steps: int = 0
    gradient: float = 0.0  # largest entry of the gradient of the loss, per row

    def probability(self) -> Column:
        z = F.lit(self.intercept)
        for name, weight in zip(self.features, self.weights, strict=True):
            z = z + F.lit(weight) * F.coalesce(F.col(name), F.lit(0.0))
        return 1 / (1 + F.exp(-z))

    def match_probability(self) -> Column:
        return round_dp(self.probability(), 4)


def fit_newton(train: DataFrame, features: list[str] = policy.FEATURES, c: float = 1.0, most_steps: int = 50, tolerance: float = 1e-10) -> LinearModel:
    """L2 logistic regression (inverse penalty ``c`` on the summed loss, none on the intercept) by Newton steps.

    Rows with the same features and label are counted once; each step is one aggregation of the loss, the
    gradient and the Hessian, whose size depends on the number of features alone. A step that would
    raise the loss is halved. Coefficients are rounded to ``DIGITS`` decimals. A table with no rows gives zeros.
    """
    x = [F.coalesce(F.nanvl(F.col(f).cast("double"), F.lit(0.0)), F.lit(0.0)).alias(f"x{i + 1}") for i, f in enumerate(features)]
    names = [f"x{i + 1}" for i in range(len(features))]
    rows = durable(train.select(*x, F.col("label").cast("double").alias("y")).groupBy(*names, "y").agg(F.count(F.lit(1)).alias("n")))
    d = len(features) + 1
    terms = [F.lit(1.0), *[F.col(n) for n in names]]
    pairs = [(j, k) for j in range(d) for k in range(j, d)]
    ridge = np.array([0.0] + [1.0 / c] * (d - 1))

    def sums(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, float]:
        z = sum((F.lit(float(b)) * t for b, t in zip(w[1:], terms[1:])), F.lit(float(w[0])))
        p = 1 / (1 + F.exp(-z))
        at = rows.select("n", "y", *names, z.alias("z"), p.alias("p"))
        loss = F.col("n") * (F.greatest("z", F.lit(0.0)) + F.log1p(F.exp(-F.abs("z"))) - F.col("y") * F.col("z"))
        r = at.agg(F.sum("n").alias("rows"), F.sum(loss).alias("loss"),
                   *[F.sum(F.col("n") * (F.col("y") - F.col("p")) * t).alias(f"g{j}") for j, t in enumerate(terms)],
                   *[F.sum(F.col("n") * F.col("p") * (1 - F.col("p")) * terms[j] * terms[k]).alias(f"h{j}_{k}") for j, k in pairs]).first()
        if not r["rows"]:
            return 0.0, np.zeros(d), np.eye(d), 1.0
        h = np.zeros((d, d))
        for j, k in pairs:
            h[j, k] = h[k, j] = r[f"h{j}_{k}"]
        return r["loss"] + 0.5 * float(ridge @ w**2), np.array([r[f"g{j}"] for j in range(d)]) - ridge * w, h + np.diag(ridge), float(r["rows"])

    w, taken = np.zeros(d), 0
    loss, gradient, hessian, total = sums(w)
    while taken < most_steps:
        step = np.linalg.solve(hessian, gradient)
        ahead = sums(w + step)
        while ahead[0] > loss * (1 + 1e-12) + 1e-12 and np.max(np.abs(step)) > tolerance:
            step = step / 2
            ahead = sums(w + step)
        w, (loss, gradient, hessian, total), taken = w + step, ahead, taken + 1
        if np.max(np.abs(step)) <= tolerance:
            break
    else:
        raise ArithmeticError("coefficients did not settle")
    kept = np.round(w, DIGITS) + 0.0
    return LinearModel(list(features), float(kept[0]), [float(v) for v in kept[1:]], taken, float(np.max(np.abs(gradient)) / total))


def fit_logistic(train: DataFrame, features: list[str] = policy.FEATURES, c: float = 1.0) -> PipelineModel:
    """L2 logistic regression with the usual inverse penalty ``c`` on the summed loss."""
    rows = train.count()
    classifier = LogisticRegression(featuresCol="_features", labelCol="label", regParam=1.0 / (c * rows),
                                    elasticNetParam=0.0, standardization=False, maxIter=1000)
    return _fit(train, features, classifier)


def fit_forest(train: DataFrame, features: list[str] = policy.FEATURES, trees: int = 100, depth: int = 30) -> PipelineModel:
    """Random forest; trees grow as deep as Spark allows (30 levels)."""
    classifier = RandomForestClassifier(featuresCol="_features", labelCol="label", numTrees=trees, maxDepth=depth, seed=42)
    return _fit(train, features, classifier)


def _fit(train: DataFrame, features: list[str], classifier) -> PipelineModel:
    assembler = VectorAssembler(inputCols=features, outputCol="_features")
    data = train.select(*[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in features],
                        F.col("label").cast("double").alias("label"))
    return Pipeline(stages=[assembler, classifier]).fit(data)


def model_features(model: PipelineModel) -> list[str]:
    return list(model.stages[0].getInputCols())


def score(df: DataFrame, model: PipelineModel | LinearModel) -> DataFrame:
    """Rows with ``probability`` (eight decimals for a linear model), ``match_probability`` (four decimals) and ``prediction``."""
    if isinstance(model, LinearModel):
        return df.withColumn("probability", F.round(model.probability(), 8)).withColumns({
            "match_probability": round_dp(F.col("probability"), 4), "prediction": (F.col("probability") >= 0.5).cast("int")})
    names = model_features(model)
    out = model.transform(df.na.fill(0, names))
    p = vector_to_array(F.col("probability")).getItem(1)
    keep = [c for c in df.columns]
    return out.select(*keep, p.alias("probability"), round_dp(p, 4).alias("match_probability"),
                      F.col("prediction").cast("int").alias("prediction"))


def probability_of(model: PipelineModel | LinearModel) -> Column:
    """P(match) of a fitted logistic model as a plain expression (no vector column, no extra stage)."""
    if isinstance(model, LinearModel):
        return model.match_probability()
    fitted = model.stages[-1]
    return LinearModel(model_features(model), float(fitted.intercept), [float(w) for w in fitted.coefficients.toArray()]).match_probability()


def evaluate(scored: DataFrame, by: list[str] = ()) -> DataFrame:
    """Precision, recall, F1 and ROC-AUC per group."""
    by = list(by)
    report = classification_report(scored, "label", "prediction", by)
    auc = roc_auc(scored, "label", "probability", by).select(*by, "roc_auc")
    if by:
        return report.join(auc, by)
    return report.withColumn("roc_auc", auc.select("roc_auc").scalar())


COEFFICIENTS = "name string, value double"


def save_model(spark: SparkSession, model: PipelineModel | LinearModel, path: str, training_rows: int, training_date: str,
               metrics: dict[str, float]) -> None:
    """Model directory plus a one-row metadata table next to it; a linear model is a table of coefficients."""
    if isinstance(model, LinearModel):
        names, kind = list(model.features), "LinearModel"
        rows = [("(intercept)", model.intercept), *zip(names, model.weights)]
        spark.createDataFrame(rows, COEFFICIENTS).coalesce(1).write.mode("overwrite").parquet(f"{path}/model")
    else:
        names, kind = model_features(model), policy.MODEL["type"]
        model.write().overwrite().save(f"{path}/model")
    row = (policy.MODEL["name"], policy.MODEL["version"], kind, policy.MODEL["feature_schema_version"], names, training_rows, training_date, metrics)
    spark.createDataFrame([row], META_SCHEMA).write.mode("overwrite").json(f"{path}/meta")


def load_model(spark: SparkSession, path: str, features: list[str] = policy.FEATURES) -> tuple[PipelineModel | LinearModel, DataFrame]:
    """Stored model and metadata; a different feature list is an error."""
    meta = spark.read.schema(META_SCHEMA).json(f"{path}/meta")
    row = meta.first()
    if row["model_type"] == "LinearModel":
        values = {r["name"]: r["value"] for r in spark.read.schema(COEFFICIENTS).parquet(f"{path}/model").collect()}  # one row for a feature
        model, names = LinearModel(row["features"], values["(intercept)"], [values[n] for n in row["features"]]), row["features"]
    else:
        model = PipelineModel.load(f"{path}/model")
        names = model_features(model)
    if list(names) != list(features):
        raise ValueError(f"feature schema mismatch: {names} != {list(features)}")
    return model, meta


def load_or_fit(spark: SparkSession, path: str, train: DataFrame, fallback: bool = False) -> tuple[PipelineModel | LinearModel, bool]:
    """Stored model, or with ``fallback`` a model fitted now; the flag tells which."""
    try:
        return load_model(spark, path)[0], False
    except Exception as error:
        missing = any(x in str(error) for x in ("PATH_NOT_FOUND", "does not exist"))
        if not (fallback and missing):  # a stored model that doesn't fit is an error
            raise
        return fit_newton(train), True


def prediction_ledger(scored: DataFrame, at: Column) -> DataFrame:
    """Rows for the prediction log."""
    return scored.select(
        "pair_id", F.lit(policy.MODEL["name"]).alias("model_name"), F.lit(policy.MODEL["version"]).alias("model_version"),
        F.col("route").alias("prediction"), F.col("match_probability").cast("decimal(5,4)").alias("probability"),
        F.lit(policy.MODEL["feature_schema_version"]).alias("feature_schema_version"), at.alias("created_at"))


def metrics_json(metrics: dict[str, float]) -> str:
    return json.dumps({k: round(float(v), 4) for k, v in metrics.items()})
