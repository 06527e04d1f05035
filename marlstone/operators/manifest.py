from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import ENTRY_FIELDS, GIT_KINDS, TARGET_FIELDS, has, with_rest


def to_manifest(registry: DataFrame) -> DataFrame:
    """Six fields of every entry, in registry order (`_pos`). Defaults replace what is absent; what is present stays, null too."""
    defaults = {
        "ref": F.when(F.col("kind").isin(*GIT_KINDS), F.lit("main")).otherwise(F.lit("")),
        "scan_paths": F.array().cast("array<string>"),
        "requires_crawler": F.lit(False),
    }
    fields = [F.when(has(n), F.col(n)).otherwise(defaults[n]).alias(n) if n in defaults else F.col(n) for n in TARGET_FIELDS]
    return registry.select("_pos", *fields)


def with_source_keys(registry: DataFrame) -> DataFrame:
    """The manifest with `_keys`, in the order of a target's keys: those that the entry has, then those that defaults fill; and with `_rest`, so
    that a value of another type than its field's stays as it is."""
    present = F.filter(F.array(*map(F.lit, TARGET_FIELDS)), lambda k: F.array_contains("_keys", k))
    # Defaults are filled in this order.
    filled = F.array_except(F.array(*map(F.lit, ("requires_crawler", "ref", "scan_paths"))), present)
    kept = with_rest(registry).select("_pos", F.concat(present, filled).alias("_keys"), F.map_filter("_rest", lambda k, _: k.isin(*TARGET_FIELDS)).alias("_rest"))
    return to_manifest(registry).join(kept, "_pos")


def borrowed(registry: DataFrame) -> DataFrame:
    """(_pos, strict, filled): whether the manifest's fields of an entry are a strict subset of the registry's, and those that defaults fill."""
    ours, theirs = F.array(*map(F.lit, TARGET_FIELDS)), F.array(*map(F.lit, ENTRY_FIELDS))
    strict = (F.size(F.array_intersect(ours, theirs)) == len(TARGET_FIELDS)) & (F.size(theirs) > len(TARGET_FIELDS))
    return registry.select("_pos", strict.alias("strict"), F.array_except(ours, F.coalesce(F.col("_keys"), F.array().cast("array<string>"))).alias("filled"))
