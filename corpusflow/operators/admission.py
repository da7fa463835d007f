"""URL admission: policy rules, https upgrade and robots rules.

All rules are column expressions on the seed rows (narrow, no shuffle).
Robots rules arrive as a table and are joined on host.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CrawlPolicy
from ..functions.urls import (has_excluded_extension, https_upgrade, is_allowed_domain,
                              is_excluded_domain, netloc)

def policy_rule(url, policy: CrawlPolicy):
    """First failing policy rule of a raw URL, or null when admitted."""
    return (F.when(is_excluded_domain(url, policy), F.lit("excluded"))
            .when(~is_allowed_domain(url, policy), F.lit("domain"))
            .when(has_excluded_extension(url, policy), F.lit("extension")))


def with_policy(df: DataFrame, policy: CrawlPolicy, url_col: str = "url") -> DataFrame:
    """Add ``rule`` (first failing rule or null) and ``fetch_url`` (the URL
    after the https upgrade, which happens after the rule checks)."""
    u = F.col(url_col)
    return df.withColumn("rule", policy_rule(u, policy)).withColumn("fetch_url", https_upgrade(u))


def unquoted(x):
    """Percent sequences decoded as UTF-8 (``+`` stays); a text with an
    invalid sequence stays as it is."""
    return F.coalesce(F.try_url_decode(F.replace(x, F.lit("+"), F.lit("%2B"))), x)


def quoted(x):
    """Percent-encoded but for letters, digits, ``_.-~`` and ``/``."""
    out = F.url_encode(x)      # form encoding: space is '+', '*' is kept, '~' and '/' are not
    for a, b in (("+", "%20"), ("*", "%2A"), ("%7E", "~"), ("%2F", "/")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def robots_table(rules: DataFrame, policy: CrawlPolicy) -> DataFrame:
    """One row per host: robots fetch status and the ordered rule lines of
    the entry that applies to our agent.

    ``rules(host, status, entry_no, agent, rule_no, allow, path_prefix)``
    holds one row per rule line of a host's robots file (one agent per
    entry; a host whose robots fetch failed has one row with null entry).
    The entry is the first one whose agent is a substring of our agent
    token, else the first ``*`` entry. Rule arrays are bounded by the size
    of one robots file, so the per-host table is small per key.
    """
    token = policy.agent_token
    r = rules.withColumn("_agent", F.lower("agent"))
    agent_hit = (F.col("_agent") != "*") & F.lit(token).contains(F.col("_agent"))
    entry = r.groupBy("host").agg(
        F.max("status").alias("robots_status"),
        F.coalesce(F.min(F.when(agent_hit, F.col("entry_no"))),
                   F.min(F.when(F.col("_agent") == "*", F.col("entry_no")))).alias("entry_no"))
    lines = (r.filter(F.col("rule_no").isNotNull()).groupBy("host", "entry_no")
             .agg(F.array_sort(F.collect_list(F.struct(
                 "rule_no",
                 # an empty Disallow line allows everything
                 (F.col("allow") | (F.col("path_prefix") == "")).alias("allow"),
                 quoted(unquoted(F.col("path_prefix"))).alias("path_prefix"))))
                  .alias("robots_rules")))
    return entry.join(lines, ["host", "entry_no"], "left")


def robots_allowed(df: DataFrame, rules: DataFrame | None, policy: CrawlPolicy,
                   url_col: str = "fetch_url") -> DataFrame:
    """Add ``robots_ok`` for each row, decided on the upgraded URL.

    Disabled or no robots row for the host -> allow; status 401/403 -> block;
    other 4xx -> allow; 5xx -> block; no applicable entry -> allow; else the
    first rule (in file order) whose path starts the URL's path+query
    decides, and no matching rule -> allow. Both are compared decoded and
    encoded again, so ``/a%7Eb`` and ``/a~b`` are one path. Each row is joined once against
    the per-host table (many-to-one equi join on host; a hot host is split
    by adaptive skew-join handling).
    """
    if not policy.respect_robots_txt or rules is None:
        return df.withColumn("robots_ok", F.lit(True))
    u = F.col(url_col)
    pq = F.regexp_extract(unquoted(u), r"(?s)^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*(.*)$", 1)
    # re-assembly drops an empty query and an empty fragment
    pq = F.regexp_replace(F.regexp_replace(pq, r"^([^#]*)#$", "$1"), r"^([^?#]*)[?](#|$)", "$1$2")
    keyed = (df.withColumn("_host", netloc(u))
             .withColumn("_pq", F.when(pq == "", F.lit("/")).otherwise(quoted(pq))))
    table = robots_table(rules, policy).withColumnRenamed("host", "_host")
    first = F.try_element_at(F.filter("robots_rules", lambda x: F.col("_pq").startswith(x["path_prefix"])), F.lit(1))
    st = F.col("robots_status")
    return (keyed.join(table, "_host", "left").withColumn("robots_ok", (
        F.when(st.isNull(), F.lit(True))
        .when(st.isin(401, 403), F.lit(False))
        .when((st >= 400) & (st < 500), F.lit(True))
        .when(st >= 500, F.lit(False))
        .when(F.col("entry_no").isNull(), F.lit(True))
        .otherwise(F.coalesce(first["allow"], F.lit(True)))))
        .drop("_host", "_pq", "robots_status", "entry_no", "robots_rules"))


def preflight(df: DataFrame, url_col: str = "url",
              markers: tuple[str, ...] = (".gc.ca", ".canada.ca")) -> DataFrame:
    from ..functions.urls import preflight_marker
    return df.withColumn("marker", preflight_marker(F.col(url_col), markers))
