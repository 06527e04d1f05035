"""Rules of a valid registry. Rows are judged in parallel; order matters only for which violation is the first."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.url import NAME_PATTERN, URL_PATTERN, is_iso_date
from ..schema import KINDS, VALID_REQUIRED, has

RULES = ("required", "name", "duplicate name", "url", "duplicate url", "kind", "scan_paths", "no paths", "date")
NO_MAPPING = "mapping"


def all_violations(registry: DataFrame) -> DataFrame:
    """(pos, rule_no, rule, message) of every rule that an entry breaks; rules 2 to 9 look at entries that have what they need, and an entry
    that is no mapping (`_type`, where rows have it) breaks rule 0 and no other."""
    repeat = lambda c: F.when(has(c) & F.col(c).isNotNull(), F.row_number().over(Window.partitionBy(c).orderBy("_pos")) > 1)
    rows = registry.withColumns({"_name_again": repeat("name"), "_url_again": repeat("url")})
    missing = F.array_except(F.array(*map(F.lit, VALID_REQUIRED)), F.coalesce(F.col("_keys"), F.array().cast("array<string>")))
    kind = F.coalesce("_type", F.lit("mapping")) if "_type" in registry.columns else F.lit("mapping")
    # A value of another type than its field's stands in `_rest`.
    odd = lambda c: F.coalesce(F.map_contains_key("_rest", c), F.lit(False)) if "_rest" in registry.columns else F.lit(False)
    crawler = F.coalesce(F.col("requires_crawler"), F.lit(False))
    broken = [
        (F.size(missing) > 0, F.concat(F.lit("missing "), F.element_at(F.concat(missing, F.array(F.lit(""))), 1))),
        (has("name") & (odd("name") | ~F.coalesce(F.col("name").rlike(NAME_PATTERN), F.lit(False))), F.concat(F.lit("bad name "), F.coalesce("name", F.lit("null")))),
        (F.coalesce("_name_again", F.lit(False)), F.concat(F.lit("name again "), F.coalesce("name", F.lit("")))),
        (has("url") & (odd("url") | ~F.coalesce(F.col("url").rlike(URL_PATTERN), F.lit(False))), F.concat(F.lit("bad url "), F.coalesce("url", F.lit("null")))),
        (F.coalesce("_url_again", F.lit(False)), F.concat(F.lit("url again "), F.coalesce("url", F.lit("")))),
        (has("kind") & ~F.coalesce(F.col("kind").isin(*KINDS), F.lit(False)), F.concat(F.lit("kind is not one of "), F.lit(", ".join(sorted(KINDS))))),
        (has("scan_paths") & F.col("scan_paths").isNull(), F.lit("scan_paths is no list")),
        (has("scan_paths") & ~crawler & (F.coalesce(F.size("scan_paths"), F.lit(0)) == 0), F.lit("no scan_paths and no crawler")),
        (has("last_verified") & ~is_iso_date(F.col("last_verified")), F.concat(F.lit("bad date "), F.coalesce("last_verified", F.lit("null")))),
    ]
    found = [F.when(kind != "mapping", F.struct(F.lit(0).alias("rule_no"), F.lit(NO_MAPPING).alias("rule"), F.concat(F.lit("an entry is no mapping but a "), kind).alias("message")))]
    found += [F.when((kind == "mapping") & test, F.struct(F.lit(i + 1).alias("rule_no"), F.lit(RULES[i]).alias("rule"), message.alias("message"))) for i, (test, message) in enumerate(broken)]
    return rows.select(F.col("_pos").alias("pos"), F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("v")).select("pos", "v.*")


def first_violation(registry: DataFrame) -> DataFrame:
    """The one violation that a sequential validator stops at; empty if there is none."""
    first = all_violations(registry).agg(F.min(F.struct("pos", "rule_no", "rule", "message")).alias("v"))
    return first.where("v is not null").select("v.*")


def envelope_violations(envelope: DataFrame, name: str = "entries") -> DataFrame:
    """The same for a document's envelope (see yaml_catalog.envelope), at place -1: it is a mapping, of this version, with a list."""
    version = F.col("values")["version"]
    kind = F.coalesce(F.col("types")[name], F.lit("null"))
    broken = [
        (F.col("type") != "mapping", "document", F.concat(F.lit("the document is no mapping but a "), F.col("type"))),
        (~F.coalesce(version.isin("1", "1.0", "true"), F.lit(False)), "version", F.concat(F.lit("version is "), F.coalesce(version, F.lit("absent")), F.lit(", not 1"))),
        (kind != "list", "list", F.concat(F.lit(f"{name} is no list but "), F.when(kind == "null", "absent").otherwise(F.concat(F.lit("a "), kind)))),
    ]
    found = [F.when(test, F.struct(F.lit(i - 3).alias("rule_no"), F.lit(rule).alias("rule"), message.alias("message"))) for i, (test, rule, message) in enumerate(broken)]
    return envelope.select(F.lit(-1).cast("long").alias("pos"), F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("v")).select("pos", "v.*")


def assert_document(envelope: DataFrame, registry: DataFrame, name: str = "entries") -> int:
    """Raises on the first violation of a whole document, the envelope's first; returns the number of entries."""
    first = envelope_violations(envelope, name).unionByName(all_violations(registry)).agg(F.min(F.struct("pos", "rule_no", "message")).alias("v")).first()["v"]
    if first:
        raise ValueError(first.message if first.pos < 0 else f"entry {first.pos}: {first.message}")
    return envelope.first()["n_rows"]


def assert_valid(registry: DataFrame, version: object = 1, is_list: bool = True) -> int:
    """Raises on the first violation, the envelope's rules first; returns the number of entries."""
    if version != 1:
        raise ValueError(f"version is {version!r}, not 1")
    if not is_list:
        raise ValueError("entries is no list")
    if bad := first_violation(registry).first():
        raise ValueError(f"entry {bad.pos}: {bad.message}")
    return registry.count()
