"""When a lane has seen enough: distinct things surveyed in source order, and candidates in all.

The running number of distinct things at a row is the number of first occurrences up to it. First occurrences are found by grouping, and
their numbers are added up in two levels (parts of 100,000 places, then within a part), so neither a lane nor a thing is one task.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Lanes, what each counts, and after how many it stops; candidates of a lane in all.
STOPS = {"github-awesome": {"repo": 30, "query": 6}, "marketplaces": {"host": 8}, "vendor-orgs": {"org": 20}, "recent-posts": {"query": 6}}
TOTAL = 200
PART = 100_000


def things() -> dict[str, Column]:
    """What of a candidate can be counted; null counts nothing. Columns: url (canonical) and evidence."""
    some = lambda c: F.when(c != "", c)
    return {
        "repo": some(F.lower(F.regexp_extract("url", r"^https://github\.com/([^/?#]+/[^/?#]+)", 1))),
        "org": some(F.lower(F.regexp_extract("url", r"^https://github\.com/([^/?#]+)", 1))),
        "host": some(F.regexp_extract("url", r"^https?://([^/?#]+)", 1)),
        "query": some(F.regexp_extract(F.array_join("evidence", "\n"), r"query '([^'\n]+)'", 1)),
    }


def running_distinct(rows: DataFrame, counted: dict[str, Column]) -> DataFrame:
    """rows (_pos, unique; lane) with `seen_<thing>` for each of counted, the distinct ones of the lane up to the row, and `seen_all`, its rows."""
    kinds = list(counted)
    given = rows.withColumn("_things", F.array(*(F.struct(F.lit(k).alias("kind"), c.alias("thing")) for k, c in counted.items())))
    each = given.select("lane", "_pos", F.inline("_things")).where("thing is not null")
    firsts = each.groupBy("lane", "kind", "thing").agg(F.min("_pos").alias("_pos"))
    flags = firsts.groupBy("_pos").agg(*(F.count_if(F.col("kind") == k).alias(f"_n_{k}") for k in kinds))
    marked = rows.join(flags, "_pos", "left").fillna(0, [f"_n_{k}" for k in kinds]).withColumns({"_n_all": F.lit(1).cast("long"), "_part": F.floor(F.col("_pos") / PART)})
    names = [*kinds, "all"]
    parts = marked.groupBy("lane", "_part").agg(*(F.sum(f"_n_{k}").alias(f"_in_{k}") for k in names))
    before = Window.partitionBy("lane").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("lane").alias("_lane"), F.col("_part").alias("_at"), *(F.coalesce(F.sum(f"_in_{k}").over(before), F.lit(0)).alias(f"_before_{k}") for k in names))
    within = Window.partitionBy("lane", "_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    both = marked.join(parts, F.col("lane").eqNullSafe(F.col("_lane")) & (F.col("_part") == F.col("_at")))
    return both.select(*rows.columns, *((F.col(f"_before_{k}") + F.sum(f"_n_{k}").over(within)).alias(f"seen_{k}") for k in names))


def surveyed(candidates: DataFrame, stops: dict[str, dict[str, int]] = STOPS, total: int = TOTAL) -> DataFrame:
    """candidates with the running counts and `stopped`: null, or what the lane had enough of before this row. A row still belongs to the survey
    while no count is above its stop, so more of a thing that was surveyed is kept until a new one would exceed it. Lanes without stops
    have the total only."""
    rows = running_distinct(candidates, things())
    over = [F.when((F.col("lane") == lane) & (F.col(f"seen_{k}") > n), k) for lane, caps in stops.items() for k, n in caps.items()]
    return rows.withColumn("stopped", F.coalesce(*over, F.when(F.col("seen_all") > total, "total"), F.lit(None).cast("string")))


def within_stops(candidates: DataFrame, stops: dict[str, dict[str, int]] = STOPS, total: int = TOTAL) -> DataFrame:
    """Candidates that lanes keep."""
    return surveyed(candidates, stops, total).where("stopped is null").select(*candidates.columns)
