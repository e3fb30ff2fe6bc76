"""Rule and learned scores."""

from __future__ import annotations

from pathlib import Path

import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.features import FEATURES
from tessera.operators.metrics import group_f05

SEED = 20260926


def rule_score(features: DataFrame) -> DataFrame:
    """prediction: same country and one of the four exact flags."""
    hit = F.expr("country_exact = 1 and (name_exact = 1 or name_compact_exact = 1 or address_exact = 1 or address_compact_exact = 1)")
    return features.withColumn("prediction", F.when(hit, 1).otherwise(0))


def discover(df: DataFrame, prefixes: tuple[str, ...] = ("name_", "address_", "country_", "block_", "num_")) -> list[str]:
    """Numeric feature columns by prefix, in order of name."""
    kinds = ("tinyint", "smallint", "int", "bigint", "float", "double")
    return sorted(c for c, t in df.dtypes if t in kinds and c.startswith(prefixes))


def assembled(df: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    missing = [c for c in features if c not in df.columns]
    if missing:
        raise ValueError(f"missing features: {missing}")
    return VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep").transform(df.fillna(0, features))


def train(labelled: DataFrame, features: list[str] = FEATURES, kind: str = "gbt", valid: DataFrame | None = None, rounds: int = 20, depth: int = 5):
    """A fitted classifier; with valid, boosting stops early on it."""
    rows = labelled.select("label", *features, F.lit(False).alias("is_valid"))
    if valid is not None:
        rows = rows.unionByName(valid.select("label", *features, F.lit(True).alias("is_valid")))
    rows = assembled(rows.withColumn("label", F.col("label").cast("double")), features)
    if kind == "gbt":
        model = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=0.1, seed=SEED, **({"validationIndicatorCol": "is_valid"} if valid is not None else {}))
    elif kind == "forest":
        model = RandomForestClassifier(numTrees=rounds, maxDepth=depth, seed=SEED)
    else:
        model = LogisticRegression(maxIter=50, regParam=1e-3)
    return model.fit(rows)


def best_rounds(train_rows: DataFrame, valid: DataFrame, steps: tuple[int, ...] = (10, 20, 40), features: list[str] = FEATURES, measure=group_f05):
    """(model, rounds, measure) of the boosting length whose proxy on valid is best; it stops at the first step that is no better."""
    best = None
    for rounds in steps:
        model = train(train_rows, features, rounds=rounds)
        found = measure(predict(model, valid, features)).first()["macro_f05_proxy"]
        if best is not None and found <= best[2]:
            break
        best = (model, rounds, found)
    return best


def predict(model, df: DataFrame, features: list[str] = FEATURES, name: str = "score") -> DataFrame:
    """df with the probability of a match."""
    out = model.transform(assembled(df, features))
    return out.select(*df.columns, vector_to_array("probability")[1].alias(name))


def ensemble(labelled: DataFrame, features: list[str] = FEATURES) -> dict:
    return {f"p_{k}": train(labelled, features, k) for k in ("gbt", "forest", "linear")}


def predict_ensemble(models: dict, df: DataFrame, weights=(0.5, 0.3, 0.2), features: list[str] = FEATURES) -> DataFrame:
    """All components and their weighted blend as score."""
    out = df
    for name, model in models.items():
        out = predict(model, out, features, name)
    total = sum(weights)
    return out.withColumn("score", sum((F.col(n) * F.lit(w / total) for n, w in zip(models, weights)), F.lit(0.0)))


def importance(model, features: list[str] = FEATURES) -> list[tuple[str, float]]:
    return sorted(zip(features, (float(x) for x in model.featureImportances)), key=lambda x: (-x[1], x[0]))


def write_importance(model, path: str, features: list[str] = FEATURES) -> None:
    """feature,importance lines, the most important first."""
    Path(path).write_text("".join(f"{a},{b}\n" for a, b in [("feature", "importance"), *importance(model, features)]))


def score_with(df: DataFrame, fn, features: list[str]) -> DataFrame:
    """Scores of any Python model: fn takes a pandas frame of features and returns a list."""

    def run(frames):
        for f in frames:
            f["score"] = fn(f[features])
            yield f

    schema = ", ".join(f"`{c}` {t}" for c, t in df.dtypes) + ", score double"
    return df.mapInPandas(run, schema)


def score_batches(df: DataFrame, fn, features: list[str]) -> DataFrame:
    """Like score_with, but fn takes an Arrow batch of features; Spark's spark.sql.execution.arrow.maxRecordsPerBatch bounds its rows."""
    names = df.columns
    schema = ", ".join(f"`{c}` {t}" for c, t in df.dtypes) + ", score double"

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(fn(b.select(features)), pa.float64())], names=[*names, "score"])

    return df.mapInArrow(run, schema)


def save(model, path: str) -> None:
    (model if isinstance(model, PipelineModel) else PipelineModel([model])).write().overwrite().save(path)


def load(path: str):
    return PipelineModel.load(path)
