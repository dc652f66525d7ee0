"""URL filtering by pattern rules that are indexed by their rarest literal token."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlab.llm.rows import ascii_lower, narrowed, widened
from reviewlab.operators.lookup import lookup_join
from reviewlab.session import materialize

# Fixed values: (host, path, verdict) rules, of which the longest that fits wins.
HOST_RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block"),
]
# Patterns of hosts that carry advertising, gambling, drugs, adult content or link farms.
BLOCKED_PATTERNS = [
    "||casino-", "||free-bets.", "||cheap-pills.", "||ads-track.", "||spam-farm.", "||adult-",
    "||poker-", "||doubleclick.net^", "/affiliate/*/click^", "?gclid=",
]
RULES_SCHEMA = "pattern string, host string, path string, verdict string"


def default_rules(spark: SparkSession) -> DataFrame:
    """`(pattern, host, path, verdict)`; host and path are null for a plain pattern."""
    listed = [(f"||{host}{path}", host, path, verdict) for host, path, verdict in HOST_RULES]
    return spark.createDataFrame([*listed, *[(p, None, None, "block") for p in BLOCKED_PATTERNS]], RULES_SCHEMA)


def url_host(url: Column) -> Column:
    """Between the first `://` and the next `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _address(url: Column) -> Column:
    """Host, path and the rest of a url; empty without `://`."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*(.*)$", 1), F.lit(""))
    return F.concat(url_host(url), rest)


def pattern_regex(pattern: Column) -> Column:
    """The regular expression of a pattern over host, path and query.

    `||` starts at the host or one of its parent domains, `|` at either end is an anchor, `*` stands
    for anything, `^` for a separator or the end; all else is literal.
    """
    body = F.regexp_replace(F.regexp_replace(pattern, r"^\|\|?", ""), r"\|$", "")
    quoted = F.regexp_replace(body, r"([\x00-\x7F&&[^A-Za-z0-9*^]])", r"\\$1")
    regex = F.regexp_replace(F.regexp_replace(quoted, r"\*", ".*"), r"\^", r"(?:[^A-Za-z0-9._%-]|\$)")
    start = (
        F.when(F.startswith(pattern, F.lit("||")), r"^(?:[^/?#]*\.)?")
        .when(F.startswith(pattern, F.lit("|")), "^").otherwise("")
    )
    end = F.when(F.endswith(pattern, F.lit("|")) & (F.length(pattern) > 2), "$").otherwise("")
    return F.concat(F.lit("(?s)"), start, regex, end)


def _literal_tokens(pattern: Column) -> Column:
    """Runs of letters and digits that every matching url holds as whole tokens, A-Z lower-cased."""
    opened = F.when(F.startswith(pattern, F.lit("|")), pattern).otherwise(F.concat(F.lit("*"), pattern))
    closed = F.when(F.endswith(pattern, F.lit("|")), opened).otherwise(F.concat(opened, F.lit("*")))
    return F.regexp_extract_all(
        ascii_lower(closed), F.lit(r"(?<![a-z0-9*])([a-z0-9]+)(?![a-z0-9*])"), F.lit(1)
    )


def index_rules(rules: DataFrame, token_counts: DataFrame) -> DataFrame:
    """`(token, pattern, regex, rule, verdict)`: each rule under its rarest literal token.

    A rule without a whole literal token is kept under the empty token, which every url has.
    """
    numbered = rules.dropDuplicates().select(
        "pattern", "verdict", F.concat("host", "path").alias("rule"),
        F.explode_outer(F.array_distinct(_literal_tokens(F.col("pattern")))).alias("token"),
    )
    counted = numbered.join(token_counts, "token", "left")
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("token", F.lit("")).alias("token")))
    return (
        counted.groupBy("pattern", "verdict", "rule").agg(rarest.alias("r"))
        .select("r.token", "pattern", pattern_regex(F.col("pattern")).alias("regex"), "rule", "verdict")
    )


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Add `host`, `path`, `rule` and `verdict`; input columns of these names give way.

    A rule with a host fits that host and its subdomains if the path starts with the rule's path, and
    the longest one wins (of equal length the one that blocks). Where none fits, `rule` is null and
    any fitting pattern decides, blocking before allowing, else `default`. Host and path of a null url
    or one without `://` are empty; no rule fits it. Repeated urls are judged once, repeated rows all
    stay; a rule with a null pattern or verdict is ignored. Empty tables give no verdicts or no rows.

    Work is done per distinct url. Tokens are counted with partial sums, only tokens of the rule index
    fetch candidates, and only candidates run a regular expression. A token that most urls hold is
    salted when the index is too large to broadcast; a very frequent url is a join key with one row on
    the other side, which adaptive execution splits.
    """
    whole, pages = pages, narrowed(pages, url)
    urls = pages.where(F.col(url).isNotNull()).select(F.col(url).alias("_url")).distinct()
    urls = urls.withColumn("_address", _address(F.col("_url")))
    tokens = F.array_distinct(F.array_remove(F.split(ascii_lower(F.col("_address")), "[^a-z0-9]+"), ""))
    held = urls.select(
        "_url", "_address", F.explode(F.concat(F.array(F.lit("")), tokens)).alias("token")
    )
    valid = rules.where(F.col("pattern").isNotNull() & F.col("verdict").isNotNull())
    wanted = valid.select(F.explode(_literal_tokens(F.col("pattern"))).alias("token")).distinct()
    counts = lookup_join(
        held.select("_url", "token"), materialize(wanted, "rule-tokens"), ["token"], F.col("_url"), "left_semi"
    ).groupBy("token").agg(F.count("*").alias("n"))
    index = materialize(index_rules(valid, counts), "rule-index")
    fitting = lookup_join(held, index, ["token"], F.col("_url"), "inner").where(
        F.expr("_address rlike regex")
    )
    best = F.struct(
        F.col("rule").isNotNull().alias("listed"),
        F.when(F.col("rule").isNotNull(), F.length("rule")).otherwise(0).alias("length"),
        (F.col("verdict") == "block").alias("blocks"), "rule", "verdict",
    )
    verdicts = fitting.groupBy("_url").agg(F.max(best).alias("_best"))
    joined = pages.join(verdicts, F.col(url) == F.col("_url"), "left")
    judged = (
        joined.withColumn("host", url_host(F.col(url)))
        .withColumn("path", url_path(F.col(url)))
        .withColumn("rule", F.col("_best.rule"))
        .withColumn("verdict", F.coalesce("_best.verdict", F.lit(default)))
    )
    return widened(judged, whole, [url], ["host", "path", "rule", "verdict"])
