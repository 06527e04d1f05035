"""Lane and mode of a run from positional words, and the vendors that a run still has to probe."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.url import canonical_url

#: The lanes and the modes, and vendors to look into that are no entries.
LANES = ("github-awesome", "marketplaces", "vendor-orgs", "recent-posts")
MODES = ("interactive", "headless")
VENDORS = ("Vercel", "Stripe", "Cloudflare", "Netlify", "Trail of Bits", "Sentry", "Expo", "Hugging Face", "Figma", "Google Labs", "Replicate")


def resolved(words: list[str]) -> tuple[tuple[str, ...], str]:
    """(lanes, mode) of at most two words. A last word that is a mode is the mode; a word before it, or alone, is the lane; without a lane
    all lanes run, without a mode the run is interactive. Any other word is an error."""
    words = list(words)
    mode = words.pop() if words and words[-1] in MODES else MODES[0]
    if len(words) > 1 or any(w not in LANES for w in words):
        raise ValueError(f"no lane or mode: {' '.join(words)}")
    return tuple(words) or LANES, mode


def vendor_backlog(spark: SparkSession, sources: DataFrame) -> DataFrame:
    """(_pos, name, n_sources): each vendor to look into, and how many sources (url) are of an organisation of its name; 0 is still to be probed.
    Names agree by letters and digits alone, in lower case."""
    plain = lambda c: F.regexp_replace(F.lower(c), "[^a-z0-9]", "")
    vendors = spark.createDataFrame([(i, v) for i, v in enumerate(VENDORS)], "_pos long, name string")
    orgs = sources.groupBy(plain(F.regexp_extract(canonical_url(F.col("url")), r"^https://github\.com/([^/?#]+)", 1)).alias("_org")).agg(F.count("*").alias("n"))
    return vendors.join(orgs, plain(F.col("name")) == F.col("_org"), "left").select("_pos", "name", F.coalesce("n", F.lit(0)).cast("long").alias("n_sources"))
