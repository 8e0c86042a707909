"""URL filters: rules by host and path, and redirect equivalence (DataFrame functions only).

A rule names a host and a path prefix; it fits that host and its subdomains,
where the path starts with the prefix, and the longest fitting rule decides.
A page that no rule names may still be an alias of a blocked address: redirect
and canonical links make addresses equivalent, connected components over those
links give the classes of aliases, and one blocked member blocks every member
that no rule names.  An explicit allow rule takes precedence over a block that
arrives through aliases.

Links are read from whole pages: ``<link rel=canonical href>``,
``<meta property=og:url content>`` and ``<meta http-equiv=refresh>``.  Two
spellings of an address are one node when they differ in the scheme, the case
of the host, a default port, a fragment or a slash at the end.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerlens.llm.common import components, cut, spread_join

RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]

TAG_PATTERNS = {
    # a whole tag, then the attribute that holds the address
    r"""(?is)<link\b[^>]*\brel\s*=\s*["']?canonical\b[^>]*>""": r"""(?is)\bhref\s*=\s*["']?\s*([^\s"'>]+)""",
    r"""(?is)<meta\b[^>]*\bproperty\s*=\s*["']?og:url\b[^>]*>""": r"""(?is)\bcontent\s*=\s*["']?\s*([^\s"'>]+)""",
    r"""(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>""": r"""(?is)\burl\s*=\s*["']?\s*([^\s"'>]+)""",
}


def lower_ascii(column: Column) -> Column:
    return F.translate(column, string.ascii_uppercase, string.ascii_lowercase)


def _rest(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def address(url: Column) -> Column:
    """The node of a URL: host, path and query in one spelling; null without ``://``."""
    host = F.regexp_replace(host_of(url), r":(80|443)$", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    query = F.regexp_extract(_rest(url), r"^[^?#]*(\?[^#]*)?", 1)
    return F.when(F.instr(url, "://") > 0, F.concat(host, path, query))


def _attributes(html: Column, tag: str, at: str) -> Column:
    found = F.transform(F.regexp_extract_all(html, F.lit(tag), F.lit(0)), lambda t: F.regexp_extract(t, at, 1))
    return F.coalesce(found, F.array().cast("array<string>"))


def link_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(src, dst)`` URLs: each page and what its canonical and redirect tags
    name.  Relative targets are taken against the page's host or folder."""
    html, url = F.col(html_col), F.col(url_col)
    found = F.concat(*(_attributes(html, tag, at) for tag, at in TAG_PATTERNS.items()))
    links = pages.where(F.instr(url, "://") > 0).select(url.alias("src"), F.explode(F.array_distinct(found)).alias("link")).where("link <> ''")
    parts = links.select(
        "src",
        F.regexp_replace("link", "&amp;", "&").alias("link"),
        F.regexp_extract("src", r"^(.*?)://", 1).alias("scheme"),
        host_of(F.col("src")).alias("host"),
        path_of(F.col("src")).alias("path"),
    ).withColumn("folder", F.coalesce(F.nullif(F.regexp_extract("path", r"^(.*/)", 1), F.lit("")), F.lit("/")))
    link, site = F.col("link"), F.concat("scheme", F.lit("://"), "host")
    target = (
        F.when(F.instr(link, "://") > 0, link)
        .when(F.startswith(link, F.lit("//")), F.concat("scheme", F.lit(":"), link))
        .when(F.startswith(link, F.lit("/")), F.concat(site, link))
        .when(F.startswith(link, F.lit("?")), F.concat(site, "path", link))
        .when(F.startswith(link, F.lit("#")), F.col("src"))
        .otherwise(F.concat(site, "folder", link))
    )
    return parts.select("src", target.alias("dst"))


def judge(urls: DataFrame, rules: DataFrame, url_col: str) -> DataFrame:
    """``urls`` with host, path, rule and ruling (the longest rule that fits).

    Rules meet distinct hosts, not rows, so a host that holds a third of all
    rows reaches the rules once; its rows, dealt over several tasks, meet its
    own short list of rules.
    """
    rows = urls.withColumn("host", host_of(F.col(url_col))).withColumn("path", path_of(F.col(url_col)))
    parts = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    by_host = (
        rows.select("host").where("host <> ''").distinct()
        .select("host", F.explode(suffixes).alias("suffix"))
        .join(rules.select(F.col("host").alias("suffix"), F.col("path").alias("prefix"), "ruling"), "suffix")
        .withColumn("rule", F.concat("suffix", "prefix"))
        .groupBy("host")
        .agg(F.reverse(F.array_sort(F.collect_list(F.struct(F.length("rule").alias("n"), "rule", "prefix", "ruling")))).alias("fits"))
    )
    fit = F.try_element_at(F.filter("fits", lambda r: F.startswith(F.col("path"), r["prefix"])), F.lit(1))
    kept = [c for c in urls.columns if c not in ("host", "path")]
    return spread_join(rows, by_host, ["host"], urls.columns, "left").select(*kept, "host", "path", fit["rule"].alias("rule"), fit["ruling"].alias("ruling"))


def rules_frame(spark: SparkSession, rules=RULES) -> DataFrame:
    rows = [F.struct(F.lit(v).alias("ruling"), F.lit(h).alias("host"), F.lit(p).alias("path")) for v, h, p in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def url_verdicts(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page_id, host, path, rule, verdict, alias_of)``, a row for each row of ``pages``.

    ``alias_of`` is the least address of the page's class, null where it has
    no links.  A null URL, or one without ``://``, has empty host and path,
    no rule and no aliases: allowed.  Null pages have no links.  Rows that
    repeat keep a row each; pages with one URL share their links.  Other
    columns are not read, so their names can't clash.  No pages: no rows.
    """
    given = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    links = cut(link_edges(pages.select(F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))))
    edges = links.select(address(F.col("src")).alias("src"), address(F.col("dst")).alias("dst"), F.col("src").alias("u"), F.col("dst").alias("v"))
    classes = components(edges.select("src", "dst"))
    # Every spelling counts: a class is blocked if a rule blocks one of its URLs.
    linked = edges.select(F.explode(F.array("u", "v")).alias("url")).union(given.select("url")).where("url is not null").distinct()
    named = judge(linked, rules, "url").where("ruling = 'block'").select(address(F.col("url")).alias("node"))
    bad = classes.join(named, "node", "left_semi").select("component").distinct().withColumn("bad", F.lit(True))
    aliases = classes.join(bad, "component", "left").withColumnRenamed("component", "alias_of")
    judged = judge(given, rules, "url").withColumn("node", address(F.col("url")))
    passed_on = F.when(F.col("bad"), "block").otherwise("allow")
    return judged.join(aliases, "node", "left").select("page_id", "host", "path", "rule", F.coalesce("ruling", passed_on).alias("verdict"), "alias_of")
