"""URL filters with redirect equivalence, in DataFrame operations only.

A rule is a host and a path prefix; it fits the URLs of its host and of all subdomains whose path
begins with its path, and the longest fitting rule of a URL decides. URLs that lead to one another
by a redirect or a canonical link are aliases of one page: connected components over those edges
carry a block to every alias. An explicit rule comes first: a URL with a rule of its own keeps that
verdict, and a component with an explicitly allowed URL passes no block on.

Rules are joined to the distinct hosts, so a host of very many pages costs one row there. Blocked
components are joined to the pages by page key, of which each component has few.

Defined cases: a null URL or one without "://" has an empty host and path, fits no rule, has no
alias and is allowed; null or empty html has no links; repeated rows are judged alike; empty
tables give no rows; of rules of equal length an allowing one wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderloom.llm.graph import components

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"^(?s:.*?)://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def page_key(url: Column) -> Column:
    """What tells pages apart: host without default port, path without a final slash, and the query
    without tracking parameters. Null without a host."""
    host = F.regexp_replace(host_of(url), r":(80|443)$", "")
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    kept = F.filter(F.split(query, "&"), lambda q: ~q.rlike(r"^(?:utm_[a-z]+|gclid|fbclid)=|^$"))
    return F.when(F.length(host) > 0, F.concat(
        host, F.regexp_replace(path_of(url), r"/+$", ""),
        F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")))


def _attribute(tag: Column, name: str) -> Column:
    quoted = F.regexp_extract(tag, rf"(?is)\b{name}\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", 0)
    return F.trim(F.regexp_replace(F.regexp_replace(quoted, rf"(?is)^{name}\s*=\s*", ""), "^[\"']|[\"']$", ""))


def _resolved(target: Column, url: Column) -> Column:
    """A link's absolute URL: full, without scheme, from the host's root, or beside the page."""
    scheme = F.regexp_extract(url, r"^(?s:(.*?))://", 1)
    root = F.concat(scheme, F.lit("://"), host_of(url))
    return F.when(target == "", F.lit(None)).when(target.contains("://"), target) \
        .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target)) \
        .when(target.startswith("/"), F.concat(root, target)) \
        .otherwise(F.concat(root, F.regexp_replace(path_of(url), r"[^/]*$", ""), target))


def page_links(pages: DataFrame, *, url: str = "url", html: str = "html") -> DataFrame:
    """(source, target): the canonical link and the redirect that a page's html names, as URLs."""
    canonical = F.regexp_extract(html, r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>", 0)
    refresh = F.regexp_extract(html, r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>", 0)
    content = F.regexp_extract(F.regexp_replace(_attribute(refresh, "content"), "&amp;", "&"), r"(?is)url\s*=\s*[\"']?([^\"']*)", 1)
    links = pages.select(F.col(url).alias("source"), F.explode(F.array(
        F.regexp_replace(_attribute(canonical, "href"), "&amp;", "&"), content)).alias("link")).where("link != ''")
    return links.select("source", _resolved(F.col("link"), F.col("source")).alias("target")).where(host_of(F.col("target")) != "")


def _with_rule(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Adds ``rule`` (its text, or null) and ``ruled`` (its verdict) to rows with host and path."""
    listed = rules.select(F.translate(F.lower("host"), " ", "").alias("suffix"), F.col("path").alias("p"), "verdict").distinct()
    hosts = urls.select("host").where("host != ''").distinct()
    labels = F.split("host", r"\.")
    suffixes = hosts.select("host", F.explode(F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))).alias("suffix"))
    fitting = suffixes.join(listed, "suffix").groupBy("host").agg(F.collect_list(F.struct(
        F.length(F.concat("suffix", "p")).alias("size"), F.expr("int(verdict = 'allow')").alias("allow"),
        F.concat("suffix", "p").alias("rule"), "p", "verdict")).alias("fits"))
    best = F.array_max(F.filter("fits", lambda f: F.col("path").startswith(f["p"])))
    return urls.join(fitting, "host", "left").withColumn("best", best) \
        .withColumns({"rule": F.col("best.rule"), "ruled": F.col("best.verdict")}).drop("fits", "best")


def judge_urls(pages: DataFrame, rules: DataFrame, edges: DataFrame, *, url: str = "url") -> DataFrame:
    """The pages with host, path, rule and verdict. ``rules``: host, path, verdict (allow or block);
    ``edges``: source and target URLs of redirects and canonical links."""
    named = {"host": host_of(F.col(url)), "path": path_of(F.col(url)), "_page": page_key(F.col(url))}
    rest = [c for c in pages.columns if c.lower() not in ("host", "path", "_page", "rule", "ruled", "verdict", "component")]
    own = pages.select(*[pages[f"`{c}`"] for c in rest], *[c.alias(n) for n, c in named.items()])
    judged = _with_rule(own, rules)
    # an edge's ends may be no pages of the table; their own rules count too
    ends = edges.select("source").unionByName(edges.select(F.col("target").alias("source"))).distinct()
    others = _with_rule(ends.select(host_of(F.col("source")).alias("host"), path_of(F.col("source")).alias("path"),
                                    page_key(F.col("source")).alias("_page")), rules)
    aliases = components(edges.select(page_key(F.col("source")).alias("a"), page_key(F.col("target")).alias("b")), "a", "b") \
        .withColumnRenamed("node", "_page")
    explicit = judged.select("_page", "ruled").unionByName(others.select("_page", "ruled")) \
        .where("_page IS NOT NULL AND ruled IS NOT NULL").groupBy("_page").agg(
            F.max(F.expr("int(ruled = 'allow')")).alias("allowed"), F.max(F.expr("int(ruled = 'block')")).alias("blocked"))
    blocked = explicit.join(aliases, "_page", "left").groupBy(F.coalesce("component", "_page").alias("component")).agg(
        F.max("allowed").alias("allowed"), F.max("blocked").alias("blocked")).where("blocked = 1 AND allowed = 0").select("component")
    members = aliases.join(blocked, "component", "left_semi").select("_page").unionByName(
        blocked.select(F.col("component").alias("_page"))).distinct().withColumn("alias_blocked", F.lit(True))
    return judged.join(members, "_page", "left").withColumn(
        "verdict", F.coalesce("ruled", F.when(F.col("alias_blocked"), "block").otherwise("allow"))) \
        .drop("_page", "ruled", "alias_blocked")
