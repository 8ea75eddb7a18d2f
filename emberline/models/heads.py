"""The ignition head (P) and the burned-area head (A): boosted trees, and pyspark.ml's linear models."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import is_missing
from ..operators import metrics as E
from ..operators.prepare import drop_missing_label, fill_with, order_features, positives
from ..sources.tables import read_feature_list, write_feature_list
from .boosting import BoostedModel, Boosting, fit_trees, patience_rounds  # noqa: F401

VECTOR, WEIGHT = "_vector", "_weight"


@dataclass
class Head:
    """A trained head with what scoring needs: feature names, medians, and its kind."""

    model: PipelineModel | Model | BoostedModel
    label: str
    names: list[str]
    medians: list[float | None] = field(default_factory=list)

    @property
    def is_classifier(self) -> bool:
        return self.label == "ignition"

    def vectors(self, df: DataFrame, features: str = "features") -> DataFrame:
        return with_vector(df, self.medians, features)

    def score(self, df: DataFrame, name: str, features: str = "features") -> DataFrame:
        """Probability of ignition, or predicted log area, as column ``name``.

        The features must carry names: they are put into the head's order, and a column without
        names, or with missing ones, is an error.
        """
        metadata = df.schema[features].metadata
        ordered = order_features(df.withColumn("_own", F.col(features)), features, self.names)
        if isinstance(self.model, BoostedModel):
            filled = fill_with(ordered, self.medians, features, zero=True)
            scored = filled.withColumn("_score", self.model.score(features))
            scored = scored.drop(features).withColumnRenamed("_own", features).withMetadata(features, metadata)
            return scored.select(*df.columns, F.col("_score").alias(name))
        scored = self.model.transform(self.vectors(ordered, features))
        scored = scored.drop(features).withColumnRenamed("_own", features).withMetadata(features, metadata)
        if self.is_classifier:
            value = vector_to_array("probability")[1]
        else:
            value = F.col("prediction")
        return scored.select(*df.columns, value.alias(name))


def with_vector(
    df: DataFrame, medians: Sequence[float | None], features: str = "features"
) -> DataFrame:
    """Fill with medians (0 where a feature never had a value) and turn into an ml vector."""
    filled = fill_with(df.withColumn("_filled", F.col(features)), medians, "_filled", zero=True)
    return filled.withColumn(VECTOR, array_to_vector("_filled")).drop("_filled")


def class_weight(train: DataFrame, label: str = "ignition") -> float:
    """``neg/pos``, or 1 when a class is missing."""
    row = train.agg(
        F.sum((F.col(label) == 0).cast("bigint")).alias("neg"),
        F.sum((F.col(label) == 1).cast("bigint")).alias("pos"),
    ).first()
    return row["neg"] / row["pos"] if row["neg"] and row["pos"] else 1.0


def boosted_classifier(
    train: DataFrame,
    val: DataFrame | None,
    names: Sequence[str],
    medians: Sequence[float | None],
    boosting: Boosting | None = None,
    label: str = "ignition",
) -> Head:
    """Ignition head: log loss, positives weighted by ``neg/pos``."""
    b = boosting or Boosting()
    ready = _gapless(train, medians, label)
    weight = class_weight(ready, label)
    ready = ready.withColumn(WEIGHT, F.when(F.col(label) == 1, weight).otherwise(1.0))
    return _boosted(ready, val, names, medians, b, label)


def boosted_regressor(
    train: DataFrame,
    val: DataFrame | None,
    names: Sequence[str],
    medians: Sequence[float | None],
    boosting: Boosting | None = None,
    label: str = "log_burned_area",
) -> Head:
    """Area head on all rows with a label, those without fire included."""
    ready = _gapless(train, medians, label).withColumn(WEIGHT, F.lit(1.0))
    return _boosted(ready, val, names, medians, boosting or Boosting(), label)


def _boosted(ready: DataFrame, val: DataFrame | None, names, medians, b: Boosting, label: str) -> Head:
    rows = ready.select(F.col(label).alias("label"), F.col(WEIGHT).alias("weight"), "features")
    held = None if val is None else _gapless(val, medians, label).select(F.col(label).alias("label"), "features")
    return Head(fit_trees(rows, held, b, label == "ignition"), label, list(names), list(medians))


def _gapless(df: DataFrame, medians: Sequence[float | None], label: str) -> DataFrame:
    """Labels and filled features of the rows with a label."""
    kept = drop_missing_label(df, label).withColumn(label, F.col(label).cast("double"))
    return fill_with(kept.select(label, "features"), medians, "features", zero=True)


def logistic_baseline(
    train: DataFrame, names: Sequence[str], medians: Sequence[float | None], label: str = "ignition"
) -> Head:
    """L2 with C = 1 on unscaled features: the penalty per row is 1/n in Spark's objective."""
    ready = _labelled(train, medians, label)
    n = max(1, ready.count())
    estimator = LogisticRegression(
        featuresCol=VECTOR,
        labelCol=label,
        maxIter=1000,
        regParam=1.0 / n,
        elasticNetParam=0.0,
        standardization=False,
        tol=1e-4,
    )
    return Head(estimator.fit(ready), label, list(names), list(medians))


def linear_baseline(
    train: DataFrame,
    names: Sequence[str],
    medians: Sequence[float | None],
    label: str = "log_burned_area",
) -> Head | None:
    """Least squares on rows with burned area; None if there are none."""
    ready = with_vector(positives(train, label), medians)
    if ready.isEmpty():
        return None
    estimator = LinearRegression(featuresCol=VECTOR, labelCol=label, regParam=0.0)
    return Head(estimator.fit(ready), label, list(names), list(medians))


def _labelled(df: DataFrame, medians: Sequence[float | None], label: str) -> DataFrame:
    kept = drop_missing_label(df, label).withColumn(label, F.col(label).cast("double"))
    return with_vector(kept, medians).select(VECTOR, label)


def validation_metrics(head: Head, val: DataFrame) -> DataFrame:
    """Long metric rows of one head on validation data."""
    scored = head.score(val.where(~is_missing(F.col(head.label).cast("double"))), "_score")
    if head.is_classifier:
        decided = E.classification_metrics(scored, head.label, "_score")
        ranked = E.ranking_metrics(scored, head.label, "_score")
        return E.unpivot_metrics(ranked, [], ranked.columns).unionByName(
            E.unpivot_metrics(decided, [], [c for c in decided.columns if c != "n"])
        )
    errors = E.regression_metrics(scored, head.label, "_score")
    return E.unpivot_metrics(errors, [], ["rmse", "mae", "r2"])


# --- storage ------------------------------------------------------------------------------------


def save_head(head: Head, path: str, spark: SparkSession) -> None:
    """Model, feature list and medians side by side under ``path``."""
    root = path.rstrip("/")
    if isinstance(head.model, BoostedModel):
        head.model.save(spark, f"{root}/trees")
    else:
        pipeline = head.model if isinstance(head.model, PipelineModel) else PipelineModel([head.model])
        pipeline.save(f"{root}/model")
    write_feature_list(spark, head.names, f"{root}/features")
    rows = [(head.label, i, m) for i, m in enumerate(head.medians)] or [(head.label, None, None)]
    spark.createDataFrame(rows, "label string, position int, median double").coalesce(1).write.parquet(
        f"{root}/medians"
    )


def load_head(path: str, spark: SparkSession) -> Head:
    root = path.rstrip("/")
    rows = spark.read.parquet(f"{root}/medians").orderBy("position").collect()
    trees = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/trees")
    boosted = trees.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(trees)
    return Head(
        BoostedModel.load(spark, f"{root}/trees") if boosted else PipelineModel.load(f"{root}/model"),
        rows[0]["label"],
        read_feature_list(spark, f"{root}/features"),
        [r["median"] for r in rows if r["position"] is not None],
    )
