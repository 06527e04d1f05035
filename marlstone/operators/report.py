from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BATCH = 12


def by_decision(verdicts: DataFrame) -> DataFrame:
    """Rows of the report: decision, name, url and evidence; sort by decision and name."""
    return verdicts.select("decision", F.col("c_name").alias("name"), F.col("c_url").alias("url"), F.array_join("evidence", "; ").alias("evidence"))


def batches(rows: DataFrame, size: int = BATCH) -> DataFrame:
    """rows with their batch, in source order. Ranks are two-level (parts of 100,000 places, then within a part), so no task sees all."""
    part = F.floor(F.col("_pos") / 100_000)
    parts = rows.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    parts = parts.withColumn("_before", F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).drop("_n")
    rank = F.row_number().over(Window.partitionBy("_part").orderBy("_pos"))
    ranked = rows.withColumn("_part", part).join(parts, "_part").withColumn("_rank", F.col("_before") + rank)
    return ranked.withColumn("batch", F.floor((F.col("_rank") - 1) / size).cast("long")).drop("_part", "_before", "_rank")


def summary_line(counts: DataFrame) -> DataFrame:
    return counts.select(F.format_string("added=%d refreshed=%d deferred=%d rejected=%d", "added", "refreshed", "deferred", "rejected").alias("line"))
