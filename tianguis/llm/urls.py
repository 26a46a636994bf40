"""Url filters with redirect equivalence, in Spark expressions alone.

Pages that redirect to each other or name each other as canonical are aliases.  Components
of that graph carry block decisions: a url without a rule of its own is blocked if a rule
blocks any alias of it.  A url's own rule always stands, so an explicit allow takes
precedence over what its aliases suffer; allows are not handed on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, free_name
from .components import connected_components

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def alias_key(url: Column) -> Column:
    """The url without scheme and fragment, its host lower-cased: the node of the alias graph."""
    query = F.regexp_extract(_rest(url), r"^[^?#]*(\?[^#]*)", 1)
    return F.concat(host_of(url), path_of(url), F.coalesce(query, F.lit("")))


def _targets(url: Column, html: Column) -> Column:
    """Absolute urls that the page redirects to or names as canonical."""
    tags = F.concat(
        F.regexp_extract_all(html, F.lit(r"(?i)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"), F.lit(0)),
        F.regexp_extract_all(html, F.lit(r"(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"), F.lit(0)),
    )
    plain = F.transform(
        tags,
        lambda t: F.trim(F.replace(F.coalesce(F.nullif(F.regexp_extract(t, r"(?i)\bhref\s*=\s*[\"']?([^\"'\s>]+)", 1), F.lit("")), F.regexp_extract(t, r"(?i)\burl\s*=\s*[\"']?([^\"'\s>;]+)", 1)), F.lit("&amp;"), F.lit("&"))),
    )
    scheme = F.regexp_extract(url, "^[^:/?#]+", 0)
    site = F.concat(scheme, F.lit("://"), host_of(url))
    folder = F.regexp_extract(path_of(url), "^(.*/)?", 0)
    absolute = F.transform(
        plain,
        lambda h: F.when(h.contains("://"), h)
        .when(h.startswith("//"), F.concat(scheme, F.lit(":"), h))
        .when(h.startswith("/"), F.concat(site, h))
        .when(h != "", F.concat(site, F.when(folder == "", F.lit("/")).otherwise(folder), h)),
    )
    return F.coalesce(F.filter(absolute, lambda h: h.isNotNull()), F.array().cast("array<string>"))


def match_rules(nodes: DataFrame, rules: DataFrame) -> DataFrame:
    """``nodes`` (key, host, path; keys distinct) that a rule fits, with the longest such rule: key, rule, verdict.

    ``rules`` has host, path and verdict.  A rule fits its host and all subdomains if the
    path starts with the rule's.  Of rules of equal length an allow wins, then the lesser
    string.  Hosts are looked up by suffix and paths by prefix, each an equi-join, so the
    work per url follows its own length and not the number of rules.
    """
    rules = rules.select(F.col("host").alias("r_host"), F.col("path").alias("r_path"), F.col("verdict").alias("r_verdict"))
    sizes = rules.groupBy("r_host").agg(F.collect_set(F.length("r_path")).alias("sizes"))
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    by_host = nodes.where("host <> ''").select("key", "path", F.explode(suffixes).alias("r_host")).join(sizes, "r_host")
    by_path = by_host.select("key", "path", "r_host", F.explode("sizes").alias("n")).where(F.col("n") <= F.length("path"))
    fits = by_path.withColumn("r_path", F.substr("path", F.lit(1), F.col("n"))).join(rules, ["r_host", "r_path"])
    rule = F.concat("r_host", "r_path")
    best = F.min(F.struct((-F.length(rule)).alias("n"), F.col("r_verdict").alias("verdict"), rule.alias("rule")))
    return fits.groupBy("key").agg(best.alias("b")).select("key", "b.rule", "b.verdict")


def judge(pages: DataFrame, rules: DataFrame, url_col: str = "url", html_col: str = "html", redirects: DataFrame | None = None) -> DataFrame:
    """``pages`` without the html, with ``host``, ``path``, ``rule`` and ``verdict`` (allow or block).

    ``rule`` is the longest fitting rule's host and path, else null.  The verdict is the
    rule's; without one it is block if an alias is blocked by a rule, else allow.
    ``redirects`` may give further pairs of urls (source, target).

    Null urls and urls without ``://`` have empty host and path, fit no rule, have no
    aliases and are allowed.  Null html has no links.  Repeated rows get equal verdicts;
    empty tables give empty results; clashing names: new columns get underscores in front.
    """
    names = {n: free_name(pages, n) for n in ("host", "path", "rule", "verdict")}
    kept = [c for c in pages.columns if c != html_col]
    url = F.col(url_col)
    has_host = host_of(url) != ""
    key, targets = free_name(pages, "__key"), free_name(pages, "__targets")
    parsed = cut(pages.select(*kept, F.when(has_host, alias_key(url)).alias(key), F.when(has_host, F.transform(_targets(url, F.col(html_col)), lambda t: F.struct(alias_key(t).alias("key"), host_of(t).alias("host"), path_of(t).alias("path")))).alias(targets)))
    links = parsed.where(F.col(key).isNotNull()).select(F.col(key).alias("a"), F.explode(targets).alias("t")).where("t.host <> ''").select("a", F.col("t.key").alias("b"), "t.host", "t.path")
    nodes = parsed.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), host_of(url).alias("host"), path_of(url).alias("path"))
    nodes = nodes.unionByName(links.select(F.col("b").alias("key"), "host", "path"))
    pairs = links.select("a", "b")
    if redirects is not None:
        ends = redirects.select(F.col(redirects.columns[0]).alias("s"), F.col(redirects.columns[1]).alias("t")).where((host_of(F.col("s")) != "") & (host_of(F.col("t")) != ""))
        pairs = pairs.unionByName(ends.select(alias_key(F.col("s")).alias("a"), alias_key(F.col("t")).alias("b")))
        for end in ("s", "t"):
            nodes = nodes.unionByName(ends.select(alias_key(F.col(end)).alias("key"), host_of(F.col(end)).alias("host"), path_of(F.col(end)).alias("path")))
    # host and path follow from the key
    nodes = nodes.groupBy("key").agg(F.min("host").alias("host"), F.min("path").alias("path"))
    ruled = cut(match_rules(nodes, rules))
    member = connected_components(pairs, split_hubs=True)
    member = cut(member.unionByName(member.select(F.col("component").alias("node"), "component").distinct()))
    blocked = ruled.where("verdict = 'block'").join(member, F.col("key") == F.col("node")).select("component").distinct()
    aliases = member.join(blocked, "component", "left_semi").select(F.col("node").alias("key"), F.lit(True).alias("blocked"))
    known = ruled.join(aliases, "key", "full_outer").select(F.col("key").alias("__node"), F.col("rule").alias("__rule"), F.coalesce("verdict", F.when(F.col("blocked"), F.lit("block"))).alias("__verdict"))
    out = parsed.join(known, parsed[key] == known["__node"], "left")
    return out.select(*[parsed[c] for c in kept], host_of(parsed[url_col]).alias(names["host"]), path_of(parsed[url_col]).alias(names["path"]), F.col("__rule").alias(names["rule"]), F.coalesce("__verdict", F.lit("allow")).alias(names["verdict"]))
