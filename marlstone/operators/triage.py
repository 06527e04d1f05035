"""Decisions by rule from facts that a network step has gathered. A heuristic for what a reader of sources judges by hand.

Facts, each null where it is not known: duplicate_of (an existing entry), archived, http_status, final_url (where a fetch ended), last_commit,
created, n_skill_files, n_links and n_listed (what an index lists), marked_stable (its own text says that it is finished), gated,
author_verified, stars, n_mirrors, failed_check (what could not be checked), unsafe_snippet (see safety.screened).
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.url import canonical_url
from . import aliases

#: Months that a source may rest, days that a post counts as recent, and days that a source counts as brand-new.
FRESH_MONTHS, RECENT_DAYS, NEW_DAYS = 18, 90, 90
#: What a kind must show: the fact's column and its least value.
NEEDS = {"awesome-list": ("n_links", 5), "collection": ("n_skill_files", 1), "individual": ("n_skill_files", 1), "vendor-skills": ("n_skill_files", 1), "marketplace": ("n_listed", 1), "registry": ("n_listed", 1)}
FACTS = {
    "duplicate_of": "string", "archived": "boolean", "http_status": "int", "final_url": "string", "last_commit": "string", "created": "string", "n_skill_files": "long", "n_links": "long", "n_listed": "long",
    "marked_stable": "boolean", "gated": "boolean", "author_verified": "boolean", "stars": "long", "n_mirrors": "long", "failed_check": "string", "unsafe_snippet": "string",
}


def fresh(last_commit: Column, run_date: str) -> Column:
    return F.try_to_date(last_commit, "yyyy-MM-dd") >= F.add_months(F.lit(run_date).cast("date"), -FRESH_MONTHS)


def recent(posted: Column, run_date: str, days: int = RECENT_DAYS) -> Column:
    return F.try_to_date(posted, "yyyy-MM-dd") >= F.date_sub(F.lit(run_date).cast("date"), days)


def complies(kind: Column) -> Column:
    test = F.lit(False)
    for name, (fact, least) in NEEDS.items():
        test = F.when(kind == name, F.coalesce(F.col(fact), F.lit(0)) >= least).otherwise(test)
    return test


def host(url: Column) -> Column:
    """The host of a canonical address, without `www.`."""
    return F.regexp_extract(canonical_url(url), r"^https?://(?:[^/@]*@)?(?:www\.)?([^/:?#]+)", 1)


def elsewhere(url: Column, final_url: Column) -> Column:
    """Whether a fetch ended on another host than the address names."""
    return F.coalesce(host(final_url) != host(url), F.lit(False))


def with_duplicates(facts: DataFrame, registry: DataFrame, *alias_columns: str) -> DataFrame:
    """facts (_pos, url, and what alias_columns name, mirror_of and redirects_to unless given) with duplicate_of, the name of the entry that the
    registry has for the address or for one that its aliases lead to."""
    found = aliases.existing(facts, registry, *alias_columns).select("_pos", F.col("existing_name").alias("duplicate_of"))
    return facts.drop("duplicate_of").join(found, "_pos", "left")


def triaged(facts: DataFrame, run_date: str) -> DataFrame:
    """facts (url, kind and any of FACTS) with decision, rule and evidence; the first rule that applies, rejections before deferrals.

    Reject: a duplicate; archived; unreachable, which a fetch that ends on another host is too; unsafe; stale, that is older than FRESH_MONTHS
    with no skill file and not marked as stable by its own text; nothing found, unless the source is brand-new. Defer: behind a login; brand-new
    with no skills yet; an unverified author with neither stars nor mirrors; a check that was impossible."""
    facts = facts.withColumns({c: F.lit(None).cast(t) for c, t in FACTS.items() if c not in facts.columns}) if set(FACTS) - set(facts.columns) else facts
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    number = lambda c: F.coalesce(F.col(c), F.lit(0))
    said = lambda prefix, c: F.concat(F.lit(prefix), F.col(c).cast("string"))
    status, found = number("http_status"), complies(F.col("kind"))
    old = ~F.coalesce(fresh(F.col("last_commit"), run_date), F.lit(True))
    new = F.coalesce(recent(F.col("created"), run_date, NEW_DAYS), F.lit(False))
    rules = [
        ("reject", "duplicate", F.col("duplicate_of").isNotNull(), said("existing entry: ", "duplicate_of")),
        ("reject", "archived", flag("archived"), F.lit("archived")),
        ("reject", "unreachable", status.isin(404, 410), said("HTTP ", "http_status")),
        ("reject", "redirected", elsewhere(F.col("url"), F.col("final_url")), said("ended at ", "final_url")),
        ("reject", "unsafe", F.col("unsafe_snippet").isNotNull(), F.col("unsafe_snippet")),
        ("reject", "stale", old & (number("n_skill_files") == 0) & ~flag("marked_stable"), said("last commit ", "last_commit")),
        ("defer", "gated", flag("gated") | status.isin(401, 402, 403), said("HTTP ", "http_status")),
        ("defer", "unverifiable", F.col("failed_check").isNotNull() | F.col("http_status").isNull() | status.isin(429), F.concat(F.lit("unverifiable: "), F.coalesce("failed_check", F.lit("reachability")))),
        ("defer", "no skills yet", ~found & new, said("created ", "created")),
        ("reject", "nothing found", ~found, F.concat(F.lit("no skills for kind "), F.coalesce("kind", F.lit("null")))),
        ("defer", "unverifiable", F.col("last_commit").isNull(), F.lit("unverifiable: last commit")),
        ("defer", "unverified author", ~F.coalesce("author_verified", F.lit(True)) & (number("stars") == 0) & (number("n_mirrors") == 0), F.lit("unverified author, no stars, no mirrors")),
    ]
    row = lambda d, r, e: F.struct(F.lit(d).alias("decision"), F.lit(r).alias("rule"), e.alias("evidence"))
    hit = F.coalesce(*(F.when(test, row(d, r, e)) for d, r, test, e in rules), row("approve", "complies", said("HTTP ", "http_status")))
    return facts.withColumn("_hit", hit).select("*", "_hit.decision", "_hit.rule", F.col("_hit.evidence").alias("decided_by")).drop("_hit")


def verdict_contract(verdicts: DataFrame) -> DataFrame:
    """Verdicts that break the contract: approvals without an entry, rejections or deferrals with one or without a reason."""
    entry = F.size(F.coalesce("_keys", F.array().cast("array<string>"))) > 0
    approve = F.col("decision") == "approve"
    return verdicts.where((approve & ~entry) | (~approve & (entry | F.col("reason").isNull())))
