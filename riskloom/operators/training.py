"""Models: gradient boosted classifier and the normal-behaviour profile."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.config import ML_FEATURES, ML_MODEL_VERSION
from riskloom.operators.scoring import probability_to_score
from riskloom.session import ensure_checkpoint_dir


@dataclass(frozen=True)
class BoostingSettings:
    test_share: float = 0.2
    seed: int = 42
    max_depth: int = 5
    step_size: float = 0.1
    rounds: int = 200
    row_share: float = 0.8
    feature_share: str = "0.8"


def stratified_split(df: DataFrame, label: str, key: str, test_share: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """Train and test parts with the same share of every label.

    The part follows from a hash of the key and the seed, so a recomputed task never moves a row
    from one part to the other; the share per label holds in expectation.
    """
    u = F.pmod(F.xxhash64(F.lit(seed), F.col(label), F.col(key)), F.lit(1_000_000))
    cut = int(test_share * 1_000_000)
    return df.where(u >= cut), df.where(u < cut)


def train_classifier(
    features: DataFrame, label: str = "label", key: str = "id", settings: BoostingSettings = BoostingSettings()
) -> tuple[PipelineModel, float]:
    """Fit boosted trees on the feature columns and return the model with its AUC on the test part."""
    ensure_checkpoint_dir(features.sparkSession)
    train, test = stratified_split(features, label, key, settings.test_share, settings.seed)
    gbt = GBTClassifier(
        featuresCol="features", labelCol=label, maxDepth=settings.max_depth, stepSize=settings.step_size,
        maxIter=settings.rounds, subsamplingRate=settings.row_share, featureSubsetStrategy=settings.feature_share,
        seed=settings.seed, checkpointInterval=10,
    )
    assembler = VectorAssembler(inputCols=ML_FEATURES, outputCol="features", handleInvalid="keep")
    model = Pipeline(stages=[assembler, gbt]).fit(train)
    auc = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC").evaluate(model.transform(test))
    return model, auc


def save_model(model: PipelineModel, path: str) -> None:
    """Stores the stages; the assembler keeps the ordered feature names."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def predict(features: DataFrame, model: PipelineModel) -> DataFrame:
    """Score with a trained model; absent features count as 0."""
    names = model.stages[0].getInputCols()
    filled = features.withColumns(
        {c: F.coalesce(F.col(c), F.lit(0.0)) if c in features.columns else F.lit(0.0) for c in names}
    )
    p = vector_to_array("probability")[1]
    scored = model.transform(filled).withColumn("xgb_score", p)
    return scored.select(
        *features.columns, "xgb_score", (F.col("xgb_score") * 0.5).alias("ae_score"),
        probability_to_score(F.col("xgb_score")).alias("ml_score"), F.lit(ML_MODEL_VERSION).alias("model_version"),
    )


# ------------------------------------------------------------------ normal-behaviour profile
def fit_mean(normal: DataFrame) -> dict[str, float]:
    """Mean of each feature over normal transactions: the model is these few numbers."""
    return normal.agg(*[F.avg(c).alias(c) for c in ML_FEATURES]).first().asDict()


def anomaly_errors(features: DataFrame, mean: dict[str, float]) -> DataFrame:
    """Distance of each transaction to the mean vector."""
    total = F.lit(0.0)
    for c in ML_FEATURES:
        total = total + F.pow(F.col(c) - F.lit(mean[c] or 0.0), F.lit(2.0))
    return features.withColumn("error", F.sqrt(total))


def error_profile(errors: DataFrame, sigmas: float = 3.0) -> DataFrame:
    mean, std = F.avg("error"), F.stddev_pop("error")
    return errors.agg(
        F.count("*").alias("n_rows"), mean.alias("error_mean"), std.alias("error_std"),
        (mean + std * sigmas).alias("threshold"),
    )


def anomaly_flags(errors: DataFrame, threshold: float) -> DataFrame:
    return errors.withColumn("is_anomaly", F.col("error") > threshold)


def amount_label(threshold: float = 15_000.0) -> Column:
    """Stand-in label while no confirmed cases exist: large amounts."""
    return F.when(F.col("amount_raw") > threshold, 1.0).otherwise(0.0)
