"""URL filter: stated rules first, then an empirical-Bayes reputation of hosts (DataFrame functions only).

Labelled page outcomes (bad or not) are counted per host. A beta prior is passed down a tree
root -> public suffix -> registered domain -> host: every node's counts are shrunk towards its
parent's posterior mean with a strength estimated once per level by the method of moments from how
far children scatter around their parents. A host is blocked when the lower bound of its posterior,
mean - z * standard deviation, lies above `threshold`.

Defined results: a null url, or one without `://`, has an empty host and path, fits no rule and is
judged by the root's posterior (its host has the node ''). Pages without an outcome count nowhere;
hosts without any inherit their domain's. With no outcome at all the prior is Jeffreys' and nothing
is blocked. Repeated page ids are judged row by row; an id with several outcomes is bad if any is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statbank.session import materialized

#: (verdict, host, path), as the contract states them.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
Z = 1.645
THRESHOLD = 0.5
#: Bounds of the intra-class correlation, from which a level's prior strength is 1 / rho - 1.
RHO = (0.001, 0.5)

#: Second-level labels under which the registries of countries (two letters) register names (fixed values).
REGISTRIES = "ac ad asn co com ed edu firm gen go gob gouv gov govt gr gv id ind info lg ltd me mil ne net nhs nic nom or org plc police pro res sch web"
SECOND = rf"(^|[.])({REGISTRIES.replace(' ', '|')})[.][a-z][a-z]$"
ADDRESS = r"^[0-9]+([.][0-9]+){3}$|^\["
USER, PORT = "^.*@", ":[0-9]*$"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    return F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def matched_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule text, its verdict) of the longest rule that fits; nulls if none does. Ties: the smaller text."""
    text = verdict = None
    for kind, on, under in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == on) | host.endswith("." + on)) & path.startswith(under)
        text = F.when(fits, on + under) if text is None else text.when(fits, on + under)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    none = F.lit(None).cast("string")
    return (none, none) if text is None else (text, verdict)


def levels(host: Column) -> tuple[Column, Column]:
    """Registered domain and public suffix: the suffix is the last label, or the last two where a country's
    registry sells below a second one; the domain is one label more. User and port do not count; an
    address in numbers is its own domain and suffix."""
    bare = F.regexp_replace(F.regexp_replace(host, USER, ""), PORT, "")
    number, two = bare.rlike(ADDRESS), bare.rlike(SECOND)

    def last(n: int) -> Column:
        return F.when(number, bare).when(two, F.substring_index(bare, ".", -n - 1)).otherwise(F.substring_index(bare, ".", -n))

    return last(2), last(1)


def _shrunk(nodes: DataFrame, key: str, parents: DataFrame, parent: str) -> DataFrame:
    """Posterior (mean, deviation) of each node, given its parent's posterior mean."""
    # Written, so that neither the estimate below nor the next level plans this level again.
    joined = materialized(nodes.join(parents.select(F.col(parent), F.col("mean").alias("m")), parent), key)
    seen = F.col("n") > 0
    p = F.least(F.greatest(F.col("m"), F.lit(1e-6)), F.lit(1 - 1e-6))
    rate = F.col("bad") / F.col("n")
    # One row: how far labelled children scatter around their parents, against binomial noise alone.
    scatter = joined.agg(
        F.coalesce(F.sum(F.when(seen, F.col("n") * (rate - p) * (rate - p))), F.lit(0.0)).alias("s"),
        F.coalesce(F.sum(F.when(seen, p * (1 - p))), F.lit(0.0)).alias("noise"),
        F.coalesce(F.sum(F.when(seen, p * (1 - p) * (F.col("n") - 1))), F.lit(0.0)).alias("room"),
    )
    rho = F.when(F.col("room") > 0, (F.col("s") - F.col("noise")) / F.col("room")).otherwise(RHO[0])
    k = scatter.select((1 / F.least(F.greatest(rho, F.lit(RHO[0])), F.lit(RHO[1])) - 1).alias("k")).first()["k"]
    a = F.col("bad") + k * F.col("m")
    total = F.col("n") + k
    mean = a / total
    return joined.select(
        *[c for c in nodes.columns if c not in ("n", "bad")], "n", "bad", mean.alias("mean"), F.sqrt(mean * (1 - mean) / (total + 1)).alias("sd")
    )


def reputations(hosts: DataFrame) -> DataFrame:
    """hosts (host, n labelled, bad): one row per host -> host, mean, sd of the host's posterior."""
    domain, suffix = levels(F.col("host"))
    leaves = hosts.select("host", domain.alias("domain"), suffix.alias("suffix"), "n", "bad")
    domains = leaves.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).withColumn("root", F.lit(0))
    root = suffixes.groupBy("root").agg(((F.sum("bad") + 0.5) / (F.sum("n") + 1)).alias("mean"))
    by_suffix = _shrunk(suffixes, "suffix", root, "root")
    by_domain = _shrunk(domains, "domain", by_suffix, "suffix")
    return _shrunk(leaves, "host", by_domain, "domain").select("host", "mean", "sd")


def url_filter(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    z: float = Z,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """pages (page_id, url), outcomes (page_id, bad 0 or 1) -> page_id, url, host, path, rule, verdict, mean, sd."""
    host, path = host_and_path(F.col("url"))
    judged = pages.select("page_id", "url", F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"))
    known = outcomes.where(F.col("page_id").isNotNull() & F.col("bad").isNotNull()).groupBy("page_id").agg(F.max("bad").alias("bad"))
    labelled = judged.join(known, "page_id", "left")
    # Aggregated before any join by host: a host of a third of all pages is one row per task here.
    hosts = labelled.groupBy("host").agg(F.count("bad").cast("double").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("double").alias("bad"))
    hosts = materialized(hosts, "hosts")  # every level reads it
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    by_method = F.when(F.col("mean") - z * F.col("sd") > threshold, "block").otherwise("allow")
    return judged.join(reputations(hosts), "host", "left").select(
        "page_id", "url", "host", "path", rule.alias("rule"), F.coalesce(verdict, by_method).alias("verdict"), "mean", "sd"
    )


def page_outcomes(labels: DataFrame) -> DataFrame:
    """labels (doc_id, quality, toxic) as outcomes of the pages with the same id: bad if of low quality or toxic."""
    bad = F.when(F.col("quality").isNull() & F.col("toxic").isNull(), None).otherwise(
        (F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))).cast("int")
    )
    return labels.select(F.col("doc_id").alias("page_id"), bad.alias("bad"))


def op7_host_reputation(spark: SparkSession, folder: str) -> DataFrame:
    """Every page's url judged by the contract's rules, then by its host's reputation."""
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return url_filter(pages, page_outcomes(labels)).select("page_id", "host", "path", "rule", "verdict")


_FITS = "((host = '{on}' OR host LIKE '%.{on}') AND starts_with(path, '{under}'))"
_ORDERED = sorted(RULES, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
_RULE = "CASE " + " ".join(f"WHEN {_FITS.format(on=h, under=p)} THEN '{h}{p}'" for _, h, p in _ORDERED) + " END"
_VERDICT = "CASE " + " ".join(f"WHEN {_FITS.format(on=h, under=p)} THEN '{v}'" for v, h, p in _ORDERED) + " END"


def _level(name: str, nodes: str, parents: str, parent: str) -> str:
    """CTEs of one level of the tree."""
    return f"""
{name}_m AS (SELECT c.*, p.mean AS m, least(greatest(p.mean, 1e-6), 1 - 1e-6) AS q FROM {nodes} c JOIN {parents} p ON c.{parent} = p.{parent}),
{name}_s AS (SELECT coalesce(sum(n * (bad / n - q) * (bad / n - q)) FILTER (WHERE n > 0), 0) AS s,
    coalesce(sum(q * (1 - q)) FILTER (WHERE n > 0), 0) AS noise, coalesce(sum(q * (1 - q) * (n - 1)) FILTER (WHERE n > 0), 0) AS room FROM {name}_m),
{name}_k AS (SELECT 1 / least(greatest(CASE WHEN room > 0 THEN (s - noise) / room ELSE {RHO[0]} END, {RHO[0]}), {RHO[1]}) - 1 AS k FROM {name}_s),
{name} AS (SELECT x.*, (bad + k * m) / (n + k) AS mean, sqrt((bad + k * m) / (n + k) * (1 - (bad + k * m) / (n + k)) / (n + k + 1)) AS sd FROM {name}_m x, {name}_k)"""


ORACLE = f"""
WITH cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
judged AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
known AS (SELECT doc_id AS page_id, max(CASE WHEN coalesce(quality = 0, false) OR coalesce(toxic = 1, false) THEN 1 ELSE 0 END) AS bad
    FROM labels WHERE quality IS NOT NULL OR toxic IS NOT NULL GROUP BY 1),
seen AS (SELECT host, regexp_replace(regexp_replace(host, '{USER}', ''), '{PORT}', '') AS bare,
    count(bad)::DOUBLE AS n, coalesce(sum(bad), 0)::DOUBLE AS bad FROM judged LEFT JOIN known USING (page_id) GROUP BY host),
sized AS (SELECT *, CASE WHEN regexp_matches(bare, '{ADDRESS}') THEN 9 WHEN regexp_matches(bare, '{SECOND}') THEN 2 ELSE 1 END AS k FROM seen),
hosts AS (SELECT host, n, bad, CASE k WHEN 9 THEN bare ELSE array_to_string(list_slice(string_split(bare, '.'), -k - 1, -1), '.') END AS domain,
    CASE k WHEN 9 THEN bare ELSE array_to_string(list_slice(string_split(bare, '.'), -k, -1), '.') END AS suffix FROM sized),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY ALL),
suffixes AS (SELECT suffix, 0 AS root, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY ALL),
r0 AS (SELECT 0 AS root, (sum(bad) + 0.5) / (sum(n) + 1) AS mean FROM suffixes),
{_level("r1", "suffixes", "r0", "root")},
{_level("r2", "domains", "r1", "suffix")},
{_level("r3", "hosts", "r2", "domain")}
SELECT page_id, host, path, {_RULE} AS rule,
    coalesce({_VERDICT}, CASE WHEN mean - {Z} * sd > {THRESHOLD} THEN 'block' ELSE 'allow' END) AS verdict
FROM judged JOIN r3 USING (host)
"""
