"""Training frame, reproducible split, random-forest fit and evaluation (Spark ML)."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import md5_prefix_int
from ..schemas import MODEL_FEATURES
from .metrics import auc_exact, classification_metrics
from .scoring import score

# Model parameters of the reference
NUM_TREES = 50
MAX_DEPTH = 5
SEED = 42
TRAIN_PCT = 80


def training_frame(features: DataFrame, keep: tuple = ()) -> DataFrame:
    """Model inputs in canonical order plus ``label`` (is_fraud as DOUBLE); rows with any NULL
    are dropped, as the reference's ``dropna`` does (unlabelled rows cannot train)."""
    return (features.select(*[F.col(c) for c in keep], *[F.col(c) for c in MODEL_FEATURES],
                            F.col("is_fraud").cast("double").alias("label"))
            .na.drop("any", subset=MODEL_FEATURES + ["label"]))


def split_bucket(key: str = "transaction_id"):
    """0-9 from the md5 of the key: a split that does not change with partitioning."""
    return md5_prefix_int(F.col(key).cast("string")) % 10


def hash_split(df: DataFrame, key: str = "transaction_id", train_pct: int = TRAIN_PCT):
    """(train, test) by key hash; ``train_pct`` in steps of 10."""
    b = split_bucket(key)
    cut = train_pct // 10
    return df.filter(b < cut), df.filter(b >= cut)


def random_split(df: DataFrame, seed: int = SEED, weights=(0.8, 0.2)):
    """The reference's ``randomSplit`` (depends on the input partitioning)."""
    return tuple(df.randomSplit(list(weights), seed=seed))


def build_pipeline(num_trees: int = NUM_TREES, max_depth: int = MAX_DEPTH,
                   seed: int = SEED) -> Pipeline:
    assembler = VectorAssembler(inputCols=MODEL_FEATURES, outputCol="features")
    rf = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=num_trees,
                                maxDepth=max_depth, seed=seed)
    return Pipeline(stages=[assembler, rf])


def fit_model(train: DataFrame, **params) -> PipelineModel:
    return build_pipeline(**params).fit(train)


def evaluate(model: PipelineModel, test: DataFrame) -> dict:
    """auc (exact), f1_score (class-weighted), accuracy of ``model`` on ``test``. The scored
    frame is persisted while the metrics run, so they do not rescore the rows (its lineage is
    one transform: a lost block is simply rescored)."""
    scored = score(test, model).select("label", "prediction", "fraud_probability").persist()
    try:
        auc = auc_exact(scored, "label", "fraud_probability").first()["auc"]
        m = classification_metrics(scored, "label", "prediction").first()
    finally:
        scored.unpersist()
    return {"auc": auc, "f1_score": m["f1"], "accuracy": m["accuracy"]}


def scored_sample(model: PipelineModel, test: DataFrame, n: int = 20,
                  order: str = "transaction_id") -> DataFrame:
    """``n`` scored rows (label, prediction, probability as array, amount, risk_score); an
    explicit order makes the sample reproducible."""
    from pyspark.ml.functions import vector_to_array
    out = model.transform(test)
    return (out.select(*([order] if order in out.columns else []), "label",
                       F.col("prediction").cast("int").alias("prediction"),
                       vector_to_array("probability").alias("probability"),
                       "amount", "risk_score")
            .orderBy(order).limit(n))
