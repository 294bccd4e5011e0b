"""URL rules with redirect equivalence.

A rule (host, path) fits its host, all subdomains, and every url whose path starts with the
rule's; the longest fitting rule decides. A page that no rule fits is judged by its aliases:
pages and targets tied by canonical links and redirects form connected components, and a
component with a blocked url blocks its other pages, unless it also holds an explicitly allowed
one. An explicit rule of the page itself always stands.

Everything runs as DataFrame operations. Hosts are matched once per distinct host, so neither a
hot host nor the number of pages multiplies the rules; links are compared as urls without
scheme and fragment.

Defined cases: a url that is null or has no ``://`` has an empty host and path, no rule and no
alias, and is allowed; without rules every page is allowed; rules of equal length and the same
host and path prefer allow; repeated pages are judged alike; links without a usable target tie
nothing; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tagloom.llm.components import connected_components
from tagloom.operators.staging import stage

_AFTER = r"^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ATTRIBUTE = r"""\s*=\s*["']?([^"'\s>]+)"""
_CANONICAL = r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*\bhref""" + _ATTRIBUTE
_REFRESH = r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*\bcontent\s*=\s*["']?\s*[\d.]*\s*;\s*url\s*=\s*["']?([^"'\s>]+)"""


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, "(?s)" + _AFTER, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "(?s)" + _AFTER, 2), F.lit(""))


def _address(url: Column) -> Column:
    """The url without scheme and fragment, with a lower-case host; null when it has none."""
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    return F.when(host_of(url) != "", F.concat(host_of(url), rest))


def _resolved(link: Column, url: Column) -> Column:
    """A link target as a full url, seen from the page's url."""
    scheme = F.regexp_extract(url, r"(?s)^(.*?)://", 1)
    host = F.concat(scheme, F.lit("://"), host_of(url))
    folder = F.regexp_extract(path_of(url), r"(?s)^(.*/)", 1)
    folder = F.when(folder == "", "/").otherwise(folder)
    return (F.when(link.contains("://"), link).when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
            .when(link.startswith("/"), F.concat(host, link)).when(link.rlike(r"^[?#]"), F.concat(host, path_of(url), link))
            .otherwise(F.concat(host, folder, link)))


def _with_rule(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """Adds ``rule`` and ``own``, its verdict, to rows with a host and a path.

    Rules are joined to the distinct hosts and kept per host, longest first.
    """
    hosts = rows.select("host").where("host <> ''").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels))))
    tails = hosts.select("host", F.explode(suffixes).alias("rule_host"))
    named = rules.select(F.lower("host").alias("rule_host"), F.col("path").alias("rule_path"), "verdict")
    fitting = tails.join(named, "rule_host").groupBy("host", "rule_host", "rule_path").agg(F.min("verdict").alias("verdict"))
    length = F.length("rule_host") + F.length("rule_path")
    each = F.struct((-length).alias("order"), F.col("rule_path").alias("path"), F.concat("rule_host", "rule_path").alias("rule"), "verdict")
    by_host = stage(fitting.groupBy(F.col("host").alias("__host")).agg(F.array_sort(F.collect_list(each)).alias("__rules")), "host-rules")
    best = F.get(F.filter("__rules", lambda r: F.startswith(F.col("path"), r.path)), F.lit(0))
    matched = rows.join(by_host, F.col("host") == F.col("__host"), "left").withColumn("__best", best)
    return matched.withColumns({"rule": F.col("__best.rule"), "own": F.col("__best.verdict")}).drop("__host", "__rules", "__best")


def judge(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages`` (page_id, url, html).

    ``rules`` has (host, path, verdict: allow or block); ``redirects``, if given, has (src, dst)
    urls known from elsewhere, such as a crawler's log.
    """
    url = F.col("url")
    links = [F.nullif(F.regexp_extract("html", pattern, 1), F.lit("")) for pattern in (_CANONICAL, _REFRESH)]
    targets = F.transform(F.array_compact(F.array(*links)), lambda link: _address(_resolved(link, url)))
    read = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), _address(url).alias("address"), targets.alias("targets"))
    seen = stage(read, "addresses")

    ruled = stage(_with_rule(seen.drop("targets"), rules), "ruled")

    edges = seen.select(F.col("address").alias("src"), F.explode("targets").alias("dst"))
    if redirects is not None:
        edges = edges.unionByName(redirects.select(_address(F.col("src")).alias("src"), _address(F.col("dst")).alias("dst")))
    aliases = stage(connected_components(edges), "aliases")
    # targets that are no pages are asked too: a page that leads to a blocked url is blocked
    places = aliases.select("component", F.regexp_extract("node", r"(?s)^([^/?]*)", 1).alias("host"), F.regexp_extract("node", r"(?s)^[^/?]*([^?]*)", 1).alias("path"))
    decided = _with_rule(places, rules).groupBy("component").agg(F.bool_or(F.col("own") == "block").alias("blocked"), F.bool_or(F.col("own") == "allow").alias("allowed"))
    spread = stage(aliases.join(decided.where("blocked AND NOT allowed"), "component").select("node").distinct(), "spread")

    verdict = F.coalesce("own", F.when(F.col("node").isNotNull(), "block").otherwise("allow"))
    return ruled.join(spread, F.col("address") == F.col("node"), "left").select("page_id", "host", "path", "rule", verdict.alias("verdict"))
