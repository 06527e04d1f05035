"""Rows of the catalogue. `_pos` is the place in source order; `_keys` lists the keys that a row really has, since null is not absent."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_string, _strings = T.StringType(), T.ArrayType(T.StringType())

#: Fields of an entry in their usual order, those of a manifest, the kinds, and what a merge and a valid registry require.
ENTRY_FIELDS = {
    "name": _string, "url": _string, "kind": _string, "ref": _string, "scan_paths": _strings, "requires_crawler": T.BooleanType(),
    "description": _string, "license": _string, "tags": _strings, "last_verified": _string, "notes": _string,
}
TARGET_FIELDS = ("name", "url", "ref", "kind", "scan_paths", "requires_crawler")
KINDS = ("collection", "individual", "marketplace", "awesome-list", "vendor-skills", "registry")
#: Kinds whose ref is `main` unless given.
GIT_KINDS = ("collection", "individual", "vendor-skills")
MERGE_REQUIRED = ("name", "url", "kind", "scan_paths")
VALID_REQUIRED = (*MERGE_REQUIRED, "last_verified")

ENTRY = T.StructType([T.StructField("_pos", T.LongType()), T.StructField("_keys", _strings), *(T.StructField(n, t) for n, t in ENTRY_FIELDS.items())])
DEFERRED = T.StructType([T.StructField("_pos", T.LongType()), *(T.StructField(n, _string) for n in ("url", "name", "reason", "first_seen"))])
CANDIDATE = T.StructType([
    T.StructField("lane", _string), T.StructField("url", _string), T.StructField("name", _string), T.StructField("kind", _string), T.StructField("description", _string),
    T.StructField("evidence", _strings), T.StructField("approx_skill_count", T.LongType()), T.StructField("license", _string), T.StructField("stars", T.LongType()),
    T.StructField("last_commit", _string), T.StructField("tags", _strings),
])


def has(key: str, keys: str = "_keys") -> Column:
    """Whether a row has the key at all."""
    return F.coalesce(F.array_contains(keys, key), F.lit(False))


def with_rest(rows: DataFrame) -> DataFrame:
    """rows with a `_rest`: values that no field holds, by their keys, as JSON texts."""
    return rows if "_rest" in rows.columns else rows.withColumn("_rest", F.lit(None).cast("map<string,string>"))
