from pyspark.sql import DataFrame, SparkSession


def whole_texts(spark: SparkSession, path: str) -> DataFrame:
    """One row (value) for each file: JSON payloads and Markdown documents are read whole."""
    return spark.read.text(path, wholetext=True)
