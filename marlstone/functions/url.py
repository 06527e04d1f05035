"""Canonical form of a source's address, and the patterns that addresses, names and dates must match."""

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space at the ends that is stripped (fixed values), as a Java character class.
SPACE = r"\x09-\x0d\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SSH_PREFIX, WEB_PREFIX = "git@github.com:", "https://github.com/"

NAME_PATTERN = r"^[a-z0-9][a-z0-9-]*\n?\z"
URL_PATTERN = rf"^https://[^{SPACE}]+[^/]\n?\z"
DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}\z"
BASIC_DATE_PATTERN = r"^\d{8}\z"
WEEK_DATE_PATTERN = r"^\d{4}-?W\d{2}(-?[1-7])?\z"


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, rf"^[{SPACE}]+|[{SPACE}]+\z", "")


def canonical_url(url: Column) -> Column:
    """Strip, SSH remote to https, one `.git` off, http to https, slashes off the end, third `/`-piece (the host) in lower case."""
    u = stripped(url)
    u = F.when(u.startswith(SSH_PREFIX), F.concat(F.lit(WEB_PREFIX), F.substring(u, len(SSH_PREFIX) + 1, 1 << 30))).otherwise(u)
    u = F.regexp_replace(u, r"(?s)^(.*)\.git\z", "$1")
    u = F.regexp_replace(F.regexp_replace(u, r"^http://", "https://"), r"/+\z", "")
    pieces = F.split(u, "/", 4)
    return F.when(F.size(pieces) < 3, u).otherwise(F.array_join(F.transform(pieces, lambda p, i: F.when(i == 2, F.lower(p)).otherwise(p)), "/"))


def source_name(url: Column) -> Column:
    """A name for a source: owner-repo for code hosts, the host's stem otherwise; lower case, other signs to hyphens."""
    owner = F.regexp_extract(url, r"^https?://github\.com/([^/]+)/([^/?#]+)", 1)
    repo = F.regexp_extract(url, r"^https?://github\.com/([^/]+)/([^/?#]+)", 2)
    stem = F.regexp_extract(url, r"^https?://(?:www\.)?([^/.:]+)", 1)
    name = F.when(owner != "", F.concat_ws("-", owner, repo)).otherwise(stem)
    return F.regexp_replace(F.regexp_replace(F.lower(name), "[^a-z0-9]+", "-"), r"^-+|-+\z", "")


def is_iso_date(text: Column) -> Column:
    """Calendar dates as 2026-05-08 or 20260508, and ISO week dates; nothing with a time."""
    plain = F.when(text.rlike(DATE_PATTERN), F.try_to_date(text, "yyyy-MM-dd"))
    basic = F.when(text.rlike(BASIC_DATE_PATTERN), F.try_to_date(text, "yyyyMMdd"))
    year, week = F.substring(text, 1, 4), F.regexp_extract(text, r"W(\d{2})", 1)
    # The year's last week is that of 28 December.
    last = F.weekofyear(F.try_to_date(F.concat(year, F.lit("-12-28")), "yyyy-MM-dd"))
    weekly = text.rlike(WEEK_DATE_PATTERN) & (text.contains("-W") == text.rlike(r"(-W\d{2}|-W\d{2}-\d)\z")) & (week >= "01") & (F.when(week != "", week).cast("int") <= last)
    return F.coalesce(plain.isNotNull() | basic.isNotNull() | weekly, F.lit(False))
