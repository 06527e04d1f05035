"""Verdicts applied to the registry and the queue.

The sequential rules become keyed folds: order is in `_pos` alone. Guards run before anything is written.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import ENTRY_FIELDS, MERGE_REQUIRED, has, with_rest

#: Stands for the reason of a deferral that gives none.
NO_REASON = "deferred"
#: Columns of a queue.
QUEUE = ("_pos", "url", "name", "reason", "first_seen")


def with_keys(schema: T.StructType) -> T.StructType:
    """A schema whose rows tell the keys that they have."""
    return schema if "_keys" in schema.names else T.StructType([*schema.fields, T.StructField("_keys", T.ArrayType(T.StringType()))])


def assert_usable(rows: DataFrame, *keys: str) -> None:
    """Raises on the first row of a document that is no mapping or lacks a key that a merge goes by."""
    lacks = F.array_except(F.array(*map(F.lit, keys)), F.coalesce("_keys", F.array().cast("array<string>")))
    if bad := rows.where((F.col("_type") != "mapping") | (F.size(lacks) > 0)).agg(F.min(F.struct("_pos", "_type", lacks.alias("lacks"))).alias("v")).first()["v"]:
        raise ValueError(f"entry {bad._pos} is no mapping" if bad._type != "mapping" else f"entry {bad._pos} has no {bad.lacks[0]}")


def last_by(df: DataFrame, key: str) -> DataFrame:
    """Of rows with one key the last, at the first one's place; as an index does whose later values replace earlier ones."""
    by = Window.partitionBy(key)
    rank = F.row_number().over(by.orderBy(F.desc("_pos")))
    return df.withColumns({"_rank": rank, "_first": F.min("_pos").over(by)}).where("_rank = 1").withColumn("_pos", F.col("_first")).drop("_rank", "_first")


def approvals(verdicts: DataFrame, run_date: str) -> DataFrame:
    """Approvals dated with the run."""
    keys = F.array_union(F.coalesce("_keys", F.array().cast("array<string>")), F.array(F.lit("last_verified")))
    return verdicts.where("decision = 'approve'").withColumns({"last_verified": F.lit(run_date), "_keys": keys})


def inserts(verdicts: DataFrame, registry: DataFrame) -> DataFrame:
    """The first approval of each URL that the registry does not have."""
    order = Window.partitionBy("url").orderBy("_pos")
    new = verdicts.where("decision = 'approve'").join(registry.select("url").distinct(), "url", "left_anti")
    return new.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")


def guard(verdicts: DataFrame, registry: DataFrame) -> DataFrame:
    """(pos, rule_no, message) of verdicts that stop a merge: an unknown decision, a missing field, a name that another entry has."""
    missing = F.array_except(F.array(*map(F.lit, MERGE_REQUIRED)), F.coalesce("_keys", F.array().cast("array<string>")))
    unknown = verdicts.where(~F.coalesce(F.col("decision").isin("approve", "defer", "reject"), F.lit(False))).select(F.col("_pos").alias("pos"), F.lit(1).alias("rule_no"), F.concat(F.lit("unknown decision "), F.coalesce("decision", F.lit("null"))).alias("message"))
    lacking = verdicts.where((F.col("decision") == "approve") & (F.size(missing) > 0)).select(F.col("_pos").alias("pos"), F.lit(2).alias("rule_no"), F.concat(F.lit("missing "), F.element_at(F.concat(missing, F.array(F.lit(""))), 1)).alias("message"))
    order = Window.partitionBy("name").orderBy("_pos")
    new = inserts(verdicts, registry).withColumn("_again", F.row_number().over(order) > 1)
    taken = new.join(registry.select(F.col("name"), F.lit(True).alias("_known")).distinct(), "name", "left").where(F.col("name").isNotNull() & (F.coalesce("_known", F.lit(False)) | F.col("_again")))
    return unknown.unionByName(lacking).unionByName(taken.select(F.col("_pos").alias("pos"), F.lit(3).alias("rule_no"), F.concat(F.lit("name exists "), F.col("name")).alias("message")))


def first_guard(verdicts: DataFrame, registry: DataFrame) -> DataFrame:
    return guard(verdicts, registry).agg(F.min(F.struct("pos", "rule_no", "message")).alias("v")).where("v is not null").select("v.*")


def fold(approved: DataFrame) -> DataFrame:
    """Approvals of one URL as one patch: for each key the last approval that has it, an explicit null included; keys in the order in which
    they first came. Keys are grouped before URLs, so a URL's approvals never meet in one value, only its distinct keys do."""
    approved = with_rest(approved)
    fields = [F.max_by(F.struct(F.col(n).alias("x")), F.when(has(n), F.col("_pos"))).alias(n) for n in ENTRY_FIELDS if n != "url"]
    folded = approved.groupBy("url").agg(*fields, F.min("_pos").alias("_pos"), F.count("*").alias("n"))
    each = approved.select("url", "_pos", "_rest", F.posexplode("_keys").alias("_at", "_key"))
    last = F.max_by(F.struct(F.col("_rest")[F.col("_key")].alias("x")), "_pos").alias("_last")
    by_key = each.groupBy("url", "_key").agg(F.min(F.struct("_pos", "_at")).alias("_first"), last)
    keys = F.transform(F.array_sort(F.collect_list(F.struct("_first", "_key"))), lambda s: s["_key"]).alias("_keys")
    rest = F.map_from_entries(F.collect_list(F.when(F.col("_last.x").isNotNull(), F.struct("_key", F.col("_last.x"))))).alias("_rest")
    by_url = by_key.groupBy(F.col("url").alias("_url")).agg(keys, rest)
    both = folded.join(by_url, F.col("url").eqNullSafe(F.col("_url")), "left")
    return both.select("url", "_keys", "_pos", "n", *(F.col(n)["x"].alias(n) for n in ENTRY_FIELDS if n != "url"), "_rest")


def upsert(registry: DataFrame, verdicts: DataFrame, run_date: str) -> DataFrame:
    """The registry with all approvals, in name order (`_pos` renumbered by nothing: sort by name, then `_pos`).

    Matched by the URL as written. Of a URL that the registry has twice the last row is patched. No row is ever removed. Keys without a
    field are patched as those with one, in `_rest`.
    """
    registry = with_rest(registry)
    patch = fold(approvals(verdicts, run_date))
    patch = patch.select("url", F.col("_keys").alias("p_keys"), F.col("_pos").alias("p_pos"), F.col("_rest").alias("p_rest"), *(F.col(n).alias(f"p_{n}") for n in ENTRY_FIELDS if n != "url"))
    last = F.row_number().over(Window.partitionBy("url").orderBy(F.desc("_pos"))) == 1
    rows = registry.withColumn("_url", F.when(last, F.col("url"))).withColumn("_old", F.lit(True))
    both = rows.join(patch.withColumnRenamed("url", "p_url"), F.col("_url") == F.col("p_url"), "full_outer")
    pick = lambda n: F.when(has(n, "p_keys"), F.col(f"p_{n}")).otherwise(F.col(n)).alias(n)
    none = F.array().cast("array<string>")
    # New entries come after all old ones with the same name.
    pos = F.coalesce(F.col("_pos"), F.col("p_pos") + (1 << 40))
    keys = F.array_union(F.coalesce("_keys", none), F.coalesce("p_keys", none))
    empty = F.create_map().cast("map<string,string>")
    old = F.map_filter(F.coalesce("_rest", empty), lambda k, _: ~F.array_contains(F.coalesce("p_keys", none), k))
    rest = F.map_concat(old, F.coalesce("p_rest", empty))
    fields = (F.coalesce("url", "p_url").alias("url") if n == "url" else pick(n) for n in ENTRY_FIELDS)
    return both.select(pos.alias("_pos"), keys.alias("_keys"), *fields, F.when(F.size(rest) > 0, rest).alias("_rest"))


def _events(verdicts: DataFrame, queue: DataFrame) -> DataFrame:
    """Deferrals with a URL, each with the place of the last resolution of its URL before it, and whether the queue had the URL."""
    by_url = Window.partitionBy("c_url").orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    resolved = F.when(F.col("decision").isin("approve", "reject"), F.col("_pos"))
    rows = verdicts.withColumn("_resolved", F.max(resolved).over(by_url)).where("decision = 'defer' and coalesce(c_url, '') <> ''")
    return rows.join(queue.select(F.col("url").alias("c_url"), F.lit(True).alias("_queued")).distinct(), "c_url", "left")


def deferrals(verdicts: DataFrame, queue: DataFrame, run_date: str) -> DataFrame:
    """Queue rows that the deferrals add: those whose URL is not queued when they come."""
    added = _events(verdicts, queue).where(F.col("_queued").isNull() | F.col("_resolved").isNotNull())
    # A reason that is null is none that is absent, where verdicts tell them apart.
    given = F.col("has_reason") if "has_reason" in verdicts.columns else F.col("reason").isNotNull()
    reason = F.when(given, F.col("reason")).otherwise(NO_REASON)
    return added.select("_pos", F.col("c_url").alias("url"), F.col("c_name").alias("name"), reason.alias("reason"), F.lit(run_date).alias("first_seen"))


def _resolutions(verdicts: DataFrame) -> DataFrame:
    return verdicts.where(F.col("decision").isin("approve", "reject")).groupBy(F.col("c_url").alias("url")).agg(F.max("_pos").alias("_last"))


def _queue_columns(queue: DataFrame) -> list[str]:
    """Columns of a queue's rows; `_keys` and `_rest` where it has them."""
    return [*QUEUE, *(c for c in ("_keys", "_rest") if c in queue.columns)]


def _as_queued(added: DataFrame, queue: DataFrame) -> DataFrame:
    extra = {"_keys": F.array(*map(F.lit, QUEUE[1:])), "_rest": F.lit(None).cast("map<string,string>")}
    return added.withColumns({c: extra[c] for c in _queue_columns(queue) if c in extra} or {"reason": F.col("reason")})


def queue_strict(queue: DataFrame, verdicts: DataFrame, run_date: str) -> DataFrame:
    """One row for each open URL: resolved ones leave, a queued one keeps its row, a URL deferred after its resolution is new."""
    resolved, names = _resolutions(verdicts), _queue_columns(queue)
    old = last_by(queue, "url").join(resolved.select("url"), "url", "left_anti").select(*names, F.lit(0).alias("part"))
    order = Window.partitionBy("url").orderBy("_pos")
    new = _as_queued(deferrals(verdicts, queue, run_date), queue).join(resolved, "url", "left").where("_last is null or _pos > _last")
    new = new.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").select(*names, F.lit(1).alias("part"))
    return old.unionByName(new)


def queue_compat(queue: DataFrame, verdicts: DataFrame, run_date: str) -> DataFrame:
    """The queue as the sequential program leaves it: rows still indexed, then every listed row whose URL is not, resolved ones among them
    (part 0, 1 and, for added rows, 2; sort by part and `_pos`)."""
    resolved = _resolutions(verdicts).select("url")
    indexed = last_by(queue, "url").join(resolved, "url", "left_anti")
    tail = queue.join(resolved, "url", "left_semi").withColumn("part", F.lit(1))
    added = _as_queued(deferrals(verdicts, queue, run_date), queue).join(indexed.select("url"), "url", "left_anti").withColumn("part", F.lit(2))
    names = [*_queue_columns(queue), "part"]
    return indexed.withColumn("part", F.lit(0)).select(*names).unionByName(tail.select(*names)).unionByName(added.select(*names))


def counters(registry: DataFrame, queue: DataFrame, verdicts: DataFrame, run_date: str) -> DataFrame:
    """One row: added, refreshed, deferred, rejected."""
    added = inserts(verdicts, registry).agg(F.count("*").alias("added"))
    deferred = deferrals(verdicts, queue, run_date).agg(F.count("*").alias("deferred"))
    rest = verdicts.agg(F.count_if(F.col("decision") == "approve").alias("approved"), F.count_if(F.col("decision") == "reject").alias("rejected"))
    one = rest.crossJoin(added).crossJoin(deferred)
    return one.select("added", (F.col("approved") - F.col("added")).alias("refreshed"), "deferred", "rejected")


def changed(counts: DataFrame) -> DataFrame:
    """Whether a run has anything to commit."""
    return counts.select((F.col("added") + F.col("refreshed") + F.col("deferred") > 0).alias("changed"))


def merge(registry: DataFrame, queue: DataFrame, verdicts: DataFrame, run_date: str, mode: str = "strict") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(registry, queue, counters) after the verdicts; raises on the first bad verdict, before anything is computed further."""
    if bad := first_guard(verdicts, registry).first():
        raise ValueError(f"verdict {bad.pos}: {bad.message}")
    queued = {"strict": queue_strict, "compat": queue_compat}[mode](queue, verdicts, run_date)
    return upsert(registry, verdicts, run_date), queued, counters(registry, queue, verdicts, run_date)
