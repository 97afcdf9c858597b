"""Supervised text classifier on Spark ML, stored with a metadata record."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, NaiveBayes
from pyspark.ml.feature import (
    IDF,
    HashingTF,
    IndexToString,
    RegexTokenizer,
    StringIndexerModel,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tagloom.labels import DEFAULT_SPACE, LabelSpace

METADATA = "framework string, base_model_id string, model_path string, labels array<string>"


def train_text_classifier(
    train: DataFrame,
    labels: LabelSpace = DEFAULT_SPACE,
    text_col: str = "instruction",
    label_col: str = "intent",
    algorithm: str = "naive_bayes",
    features: int = 1 << 16,
) -> PipelineModel:
    """Fit tokens -> hashed counts -> model; the model writes its label to ``raw_output``.

    Label ids come from the label space, so no pass over the data is spent on indexing.
    ``logistic`` adds an IDF stage and reads the data once per iteration.
    """
    indexer = StringIndexerModel.from_labels(
        list(labels), inputCol=label_col, outputCol="_label", handleInvalid="skip"
    )
    tokenizer = RegexTokenizer(
        inputCol=text_col, outputCol="_tokens", pattern=r"(?U)\W+", toLowercase=True
    )
    stages = [tokenizer]
    if algorithm == "naive_bayes":
        stages.append(HashingTF(inputCol="_tokens", outputCol="_features", numFeatures=features))
        stages.append(NaiveBayes(featuresCol="_features", labelCol="_label", predictionCol="_id"))
    elif algorithm == "logistic":
        stages.append(HashingTF(inputCol="_tokens", outputCol="_counts", numFeatures=features))
        stages.append(IDF(inputCol="_counts", outputCol="_features"))
        stages.append(
            LogisticRegression(
                featuresCol="_features",
                labelCol="_label",
                predictionCol="_id",
                maxIter=20,
                regParam=0.01,
            )
        )
    else:
        raise ValueError(f"Unknown algorithm {algorithm!r}; use naive_bayes or logistic.")
    stages.append(IndexToString(inputCol="_id", outputCol="raw_output", labels=list(labels)))
    rows = train.select(text_col, label_col).where(F.col(text_col).isNotNull())
    return Pipeline(stages=stages).fit(indexer.transform(rows))


def predict_with(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` plus ``raw_output``; the model's working columns are left out."""
    return model.transform(df).select(*df.columns, "raw_output")


def save_classifier(
    model: PipelineModel,
    spark: SparkSession,
    path: str,
    base_model_id: str,
    labels: LabelSpace = DEFAULT_SPACE,
) -> None:
    """Store the model under ``path/model`` and its metadata under ``path/metadata``."""
    model_path = save_metadata(spark, path, "spark-ml", base_model_id, labels)
    model.write().overwrite().save(model_path)


def save_metadata(
    spark: SparkSession, path: str, framework: str, base_model_id: str, labels: LabelSpace
) -> str:
    """Store the metadata record; returns where the model belongs."""
    model_path = f"{path}/model"
    row = [(framework, base_model_id, model_path, list(labels))]
    spark.createDataFrame(row, METADATA).write.mode("overwrite").json(f"{path}/metadata")
    return model_path


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(METADATA).json(f"{path}/metadata")
    except AnalysisException as failure:
        raise FileNotFoundError(
            f"No classifier at {path}; train one and save it with save_classifier first."
        ) from failure


def load_classifier(spark: SparkSession, path: str) -> tuple[PipelineModel, DataFrame]:
    """Model and metadata row stored by :func:`save_classifier`."""
    metadata = read_metadata(spark, path)
    return PipelineModel.load(metadata.first().model_path), metadata
