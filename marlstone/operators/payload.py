"""JSON payloads of any accepted shape to rows, parsed in the JVM; one row is one payload.

Rows become maps of VARIANT, which keep the order of their keys, unknown keys, and JSON's null apart from an absent key.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schema import CANDIDATE, ENTRY_FIELDS
from ..sources.storage import Store
from ..sources.text import whole_texts

ROWS = "array<map<string,variant>>"
#: What a value's type may be for a field of this kind, as schema_of_variant says it, besides null.
FITS = {"string": r"STRING", "array<string>": r"ARRAY<(STRING|VOID)>", "boolean": r"BOOLEAN", "bigint": r"BIGINT"}


def read_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """(path, size, value): the payload files of a folder, each read whole. Readers pass over empty files, so these come from the listing."""
    full = spark.read.text(folder, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"), "value")
    empty = spark.createDataFrame([(path, 0, "") for path in Store(spark, folder).empty_files(folder)], full.schema)
    return full.unionByName(empty)


def typed(value: Column, kind: str) -> Column:
    return F.try_variant_get(value, "$", kind)


def fits(value: Column, kind: str) -> Column:
    """Whether a value of this kind is all of it; null fits everything."""
    return F.coalesce(F.schema_of_variant(value).rlike(f"^(VOID|{FITS[kind]})$"), F.lit(True))


def listed(doc: Column) -> Column:
    """A payload's items, each an object with `candidates` or a bare candidate: arrays of candidates. Null for any other shape."""
    whole = F.get_json_object(doc, "$.candidates").isNotNull()
    single = F.from_json(doc, f"struct<candidates {ROWS}>")["candidates"]
    items, nested = F.from_json(doc, ROWS), F.from_json(doc, f"array<struct<candidates {ROWS}>>")
    each = F.transform(items, lambda x, i: F.when(F.map_contains_key(x, "candidates"), F.get(nested, i)["candidates"]).otherwise(F.array(x)))
    # A list whose item has candidates that are no list is malformed as a whole.
    some = F.when(~F.exists(each, lambda x: x.isNull()), each)
    return F.when(whole & single.isNotNull(), F.array(single)).when(doc.rlike(r"^\s*\["), some)


def flatten_candidates(payloads: DataFrame, text_col: str = "value", strict: bool = True) -> DataFrame:
    """Candidates of payloads: an object with `candidates`, or a list of such objects and bare candidates, in order.

    strict: any other shape is an error. Otherwise a malformed payload is passed over (see gaps). Columns: payload columns, `_outer` and
    `_inner` (places of item and candidate), the candidate's fields, `_keys` and `_fields`, the whole candidate."""
    others = [c for c in payloads.columns if c != text_col]
    lists = listed(F.col(text_col))
    if strict:
        lists = F.coalesce(lists, F.raise_error(F.lit("a payload is neither an object with candidates nor a list of such objects and candidates")).cast(f"array<{ROWS}>"))
    items = payloads.select(*others, F.posexplode(lists).alias("_outer", "_item"))
    flat = items.select(*others, "_outer", F.posexplode("_item").alias("_inner", "_fields"))
    fields = [typed(F.col("_fields")[f.name], f.dataType.simpleString()).alias(f.name) for f in CANDIDATE]
    return flat.select(*others, "_outer", "_inner", *fields, F.map_keys("_fields").alias("_keys"), "_fields")


def gaps(payloads: DataFrame, text_col: str = "value") -> DataFrame:
    """Payloads that a run passes over, with the reason: what it reports as gaps. Other columns, such as path and size, stay."""
    doc = F.col(text_col)
    parsed = F.try_parse_json(doc)
    kind = F.schema_of_variant(parsed)
    reason = (
        F.when(doc.isNull() | (F.trim(doc) == ""), "empty").when(parsed.isNull(), "no JSON").when(kind.startswith("ARRAY"), "an item is no candidate")
        .when(~kind.startswith("OBJECT"), "neither an object nor a list").when(F.try_variant_get(parsed, "$.candidates", "variant").isNull(), "no candidates").otherwise("candidates are no list of objects")
    )
    return payloads.where(listed(doc).isNull()).withColumn("reason", reason).drop(text_col)


def malformed(payloads: DataFrame, text_col: str = "value") -> DataFrame:
    """Payloads that are no JSON or have no accepted shape."""
    return payloads.where(listed(F.col(text_col)).isNull())


def corpus_report(payloads: DataFrame, text_col: str = "value") -> DataFrame:
    """For every payload: its other columns, n_candidates, and the reason of a gap or null."""
    others = [c for c in payloads.columns if c != text_col]
    counted = payloads.select(*others, F.coalesce(F.aggregate(listed(F.col(text_col)), F.lit(0), lambda n, x: n + F.size(x)), F.lit(0)).cast("long").alias("n_candidates"))
    lost = gaps(payloads, text_col)
    return counted.join(lost.select(*others, "reason"), others, "left")


VERDICT = "struct<decision string, reason variant, candidate variant, suggested_entry map<string,variant>>"


def verdict_rows(text: Column) -> Column:
    """Verdicts of a list, or of an object with `verdicts`; null for any other document."""
    enveloped = F.from_json(text, f"struct<verdicts array<{VERDICT}>>")["verdicts"]
    bare = F.from_json(text, f"array<{VERDICT}>")
    return F.when(text.rlike(r"^\s*\["), bare).otherwise(enveloped)


def flatten_verdicts(payloads: DataFrame, text_col: str = "value", order_col: str | None = None) -> DataFrame:
    """Verdicts as rows: `_pos`, decision, reason, has_reason, c_url, c_name, the entry's fields, `_keys` and `_rest` (see yaml_catalog).

    Of several payloads, those of one that comes earlier by order_col (a number of at most 31 bits) come first. Any other shape is an error."""
    rows = F.coalesce(verdict_rows(F.col(text_col)), F.raise_error(F.lit("no verdicts")).cast(f"array<{VERDICT}>"))
    place = F.lit(0) if order_col is None else F.col(order_col)
    each = payloads.select(place.cast("long").alias("_payload"), F.posexplode(rows).alias("_at", "_v"))
    entry, candidate = F.col("_v.suggested_entry"), F.col("_v.candidate")
    fields = [typed(entry[n], t.simpleString()).alias(n) for n, t in ENTRY_FIELDS.items()]
    # What no field holds: unknown keys, and values of another type than their field's.
    rest = F.transform_values(F.map_filter(entry, lambda k, x: ~_held(k, x)), lambda k, x: F.to_json(x))
    return each.select(
        F.expr("_payload * 4294967296L + _at").alias("_pos"), F.col("_v.decision").alias("decision"), typed(F.col("_v.reason"), "string").alias("reason"), F.col("_v.reason").isNotNull().alias("has_reason"),
        F.try_variant_get(candidate, "$.url", "string").alias("c_url"), F.try_variant_get(candidate, "$.name", "string").alias("c_name"), F.map_keys(entry).alias("_keys"), *fields,
        F.when(F.size(rest) > 0, rest).alias("_rest"),
    )


def _held(key: Column, value: Column) -> Column:
    """Whether the field of this key holds the value whole."""
    test = F.lit(False)
    for n, t in ENTRY_FIELDS.items():
        test = F.when(key == n, fits(value, t.simpleString())).otherwise(test)
    return test


def in_order(files: DataFrame) -> DataFrame:
    """files (path and others) with `_file`, their rank by path; only paths meet in one task."""
    ranks = files.select("path").distinct().withColumn("_file", F.row_number().over(Window.orderBy("path")) - 1)
    return files.join(ranks, "path")


def union_lanes(*lanes: DataFrame) -> DataFrame:
    """Bag union of lanes whose columns may differ."""
    out = lanes[0]
    for lane in lanes[1:]:
        out = out.unionByName(lane, allowMissingColumns=True)
    return out


__all__ = ["corpus_report", "flatten_candidates", "flatten_verdicts", "gaps", "in_order", "malformed", "read_corpus", "union_lanes", "whole_texts"]
