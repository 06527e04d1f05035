"""Candidates that the catalogue does not know yet."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.url import canonical_url


def known_urls(registry: DataFrame) -> DataFrame:
    return registry.select(canonical_url(F.col("url")).alias("url")).distinct()


def known_names(registry: DataFrame) -> DataFrame:
    return registry.where("name is not null").select("name").distinct()


def _canonical(candidates: DataFrame) -> DataFrame:
    present = F.when(F.col("url").isNull(), F.raise_error(F.lit("a candidate has no url"))).otherwise(F.col("url"))
    return candidates.withColumn("url", canonical_url(present.cast("string")))


def drop_known_urls(candidates: DataFrame, registry: DataFrame) -> DataFrame:
    return _canonical(candidates).join(known_urls(registry), "url", "left_anti")


def drop_known_names(candidates: DataFrame, registry: DataFrame) -> DataFrame:
    """A candidate without a name is kept."""
    return candidates.join(known_names(registry), "name", "left_anti")


def first_by_url(candidates: DataFrame) -> DataFrame:
    """Of candidates with one canonical URL the first in source order."""
    order = Window.partitionBy("url").orderBy("_pos")
    return candidates.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")


def new_candidates(candidates: DataFrame, registry: DataFrame) -> DataFrame:
    """Survivors with canonical URLs. Only survivors reserve their URL, so both anti-joins come first; the join side that is small at run
    time is broadcast by the adaptive planner, and a large one is shuffled. Order: `_pos`, for the sink to sort by."""
    return first_by_url(drop_known_names(drop_known_urls(candidates, registry), registry))


def dedupe_stats(candidates: DataFrame, registry: DataFrame) -> DataFrame:
    """One row: new and skipped."""
    new = new_candidates(candidates, registry).agg(F.count("*").alias("new"))
    return candidates.agg(F.count("*").alias("total")).crossJoin(new).select("new", (F.col("total") - F.col("new")).alias("skipped"))


def lane_cap(candidates: DataFrame, cap: int) -> DataFrame:
    """At most `cap` candidates of each lane, in source order."""
    order = Window.partitionBy("lane").orderBy("_pos")
    return candidates.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= cap).drop("_rank")


def lane_filter(candidates: DataFrame, lane: str | None) -> DataFrame:
    return candidates if lane is None else candidates.where(F.col("lane") == lane)


def well_formed(candidates: DataFrame) -> DataFrame:
    """The contract of a lane's output: five required fields and evidence."""
    required = F.lit(True)
    for c in ("lane", "url", "name", "kind", "evidence"):
        required &= F.col(c).isNotNull()
    return candidates.where(required & (F.size("evidence") >= 1))


def known_pairs(registry: DataFrame) -> DataFrame:
    """The (name, url) pairs that every lane is handed, so that it can pass over what is known."""
    return registry.select("name", "url").distinct()


def duplicates(candidates: DataFrame, registry: DataFrame) -> DataFrame:
    """Candidates whose canonical URL the registry has: what a vetter rejects as duplicates."""
    return _canonical(candidates).join(known_urls(registry), "url", "left_semi")


def _queued(queue: DataFrame) -> DataFrame:
    """The row of each canonical URL that the queue lists first."""
    order = Window.partitionBy("url").orderBy("_pos")
    rows = queue.withColumn("url", canonical_url(F.col("url"))).where("url is not null").withColumn("_rank", F.row_number().over(order))
    return rows.where("_rank = 1").select("url", "reason", "first_seen")


def recalled(candidates: DataFrame, queue: DataFrame) -> DataFrame:
    """Candidates that an earlier run has deferred, with the reason and the day: what a run judges again without searching for it."""
    return _canonical(candidates).join(_queued(queue), "url")


def not_queued(candidates: DataFrame, queue: DataFrame) -> DataFrame:
    """Candidates that no earlier run has deferred."""
    return _canonical(candidates).join(_queued(queue), "url", "left_anti")


def worth_a_visit(candidates: DataFrame, registry: DataFrame) -> DataFrame:
    """Candidates that a lane does not pass over. Facts, absent ones counting as false or none: is_gist, is_dotfiles, n_skill_files, mirror_of.
    Passed over are known URLs and names, gists and dotfile repositories without a skill file, and mirrors of known sources."""
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    empty = (flag("is_gist") | flag("is_dotfiles")) & (F.coalesce("n_skill_files", F.lit(0)) == 0)
    fresh = drop_known_names(drop_known_urls(candidates.where(~empty), registry), registry)
    mirrors = known_urls(registry).withColumnRenamed("url", "_known")
    return fresh.join(mirrors, canonical_url(F.col("mirror_of")) == F.col("_known"), "left_anti")


def as_json(survivors: DataFrame) -> DataFrame:
    """(_pos, value): the JSON text of each survivor, its URL canonical. Candidates with `_fields` (see payload) keep all their keys in order and
    their nulls; others have the columns that have a value."""
    if "_fields" in survivors.columns:
        whole = F.transform_values("_fields", lambda k, v: F.when(k == "url", F.col("url").cast("variant")).otherwise(v))
    else:
        whole = F.struct(*(c for c in survivors.columns if not c.startswith("_")))
    return survivors.select("_pos", F.to_json(whole).alias("value"))


def payload(candidates: DataFrame, registry: DataFrame) -> DataFrame:
    """One row (value): the JSON document {new_candidates, skipped}, survivors in source order.

    A document is one value, so its survivors meet in one task here; write `as_json(new_candidates(...))` itself where they are too many for
    one, as the command does."""
    listed = as_json(new_candidates(candidates, registry).select(*candidates.columns)).agg(F.array_sort(F.collect_list(F.struct("_pos", "value"))).alias("found"))
    rows = listed.crossJoin(candidates.agg(F.count("*").alias("total")))
    text = F.array_join(F.transform("found", lambda x: x["value"]), ",")
    return rows.select(F.concat(F.lit('{"new_candidates":['), text, F.lit('],"skipped":'), (F.col("total") - F.size("found")).cast("string"), F.lit("}")).alias("value"))
