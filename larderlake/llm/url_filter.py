"""URL filters that see through redirects: block decisions reach every alias of a page.

Rules decide what they fit. Redirects, canonical links and equal normal forms make URLs equivalent;
connected components over these edges carry a block to URLs that no rule fits, unless an explicit
allow is among the equivalent ones. DataFrame functions only.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larderlake.llm.tables import connected_components, empty_or_null, keep


class Rule(NamedTuple):
    """``verdict`` (allow or block) for a host with its subdomains, where the path begins with ``path``."""

    verdict: str
    host: str
    path: str


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Query parameters that carry the URL a redirector goes to, and those that only track visitors.
REDIRECT_PARAMETERS = r"(?i)[?&](?:url|u|target|dest|destination|redirect|redirect_url|next|to)=(https?(?:%3A|:)(?:%2F|/){2}[^&#]+)"
TRACKING_PARAMETERS = r"(?i)(?<=[?&])(?:utm_[a-z]+|gclid|fbclid|mc_[a-z]+)=[^&#]*&?"
#: What a page does not show: comments and scripts.
UNSEEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>"
#: The value of a link, in quotes with the blanks in it.
HREF = r"""(?i)\bhref\s*=\s*["']?((?<=["'])[^"'>]+|[^"'\s>]+)"""


def parts(url: Column) -> tuple[Column, Column]:
    """Host, A-Z in lower case, and path of a URL; both empty without ``://``."""
    rest = F.when(F.contains(url, F.lit("://")), F.substr(url, F.instr(url, "://") + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def normal_form(url: Column) -> Column:
    """What equivalent spellings of a URL share: no scheme, fragment, www, default port, tracking
    parameter or slash at the end. A string without ``://`` stands for itself."""
    host, path = parts(url)
    host = F.regexp_replace(F.regexp_replace(host, r":(?:80|443)$", ""), r"^www\.", "")
    query = F.regexp_extract(F.regexp_replace(url, TRACKING_PARAMETERS, ""), r"^[^?#]*(\?[^#]*)", 1)
    query = F.regexp_replace(query, r"[?&]+$", "")
    return F.when(F.contains(url, F.lit("://")), F.concat(host, F.regexp_replace(path, "/+$", ""), query)).otherwise(url)


def _without_dots(path: Column) -> Column:
    """A path that begins with a slash, its ``.`` and ``..`` segments resolved."""
    none = F.array().cast("array<string>")

    def add(out: Column, part: Column) -> Column:
        up = F.slice(out, F.lit(1), F.greatest(F.size(out) - 1, F.lit(0)))
        return F.when(part == "..", up).when(part == ".", out).otherwise(F.concat(out, F.array(part)))

    kept = F.aggregate(F.split(F.substr(path, F.lit(2)), "/"), none, add)
    # A dot segment at the end leaves its folder.
    end = F.when(path.rlike(r"/\.\.?$") & (F.size(kept) > 0), "/").otherwise("")
    return F.when(F.contains(path, F.lit("/.")), F.concat(F.lit("/"), F.array_join(kept, "/"), end)).otherwise(path)


def _absolute(target: Column, base: Column) -> Column:
    """A link target as it reads from a base URL; null if it is empty or no page's (``mailto:``).

    Relative targets need a base with ``://``.
    """
    host, path = parts(base)
    site = F.concat(F.substring_index(base, "://", 1), F.lit("://"), host)
    path = F.when(path == "", "/").otherwise(path)
    joined = (
        F.when((target == "") | target.isNull(), None)
        .when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*:") | ~F.contains(base, F.lit("://")), None)
        .when(target.startswith("//"), F.concat(F.substring_index(base, "://", 1), F.lit(":"), target))
        .when(target.startswith("/"), F.concat(site, target))
        .when(target.startswith("?"), F.concat(site, path, target))
        .when(target.startswith("#"), F.concat(F.substring_index(base, "#", 1), target))
        .otherwise(F.concat(site, F.regexp_extract(path, "(?s)^(.*/)", 1), target))
    )
    pieces = r"(?s)^([^:]*://[^/?#]*)([^?#]*)(.*)$"
    site, path, rest = (F.regexp_extract(joined, pieces, i) for i in (1, 2, 3))
    return F.when(F.contains(joined, F.lit("/.")), F.concat(site, _without_dots(path), rest)).otherwise(joined)


def _tags(html: Column, name: str, having: str, value: str) -> Column:
    tags = F.filter(F.regexp_extract_all(html, F.lit(rf"(?i)(<{name}\b[^>]*>)")), lambda t: t.rlike(having))
    found = F.transform(tags, lambda t: F.replace(F.trim(F.regexp_extract(t, value, 1)), F.lit("&amp;"), F.lit("&")))
    return F.transform(found, lambda t: F.replace(t, F.lit(" "), F.lit("%20")))


def links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(url, target): redirects and canonical links of pages, once each; ``<base href>`` is their base.

    Tags in comments and scripts are none.
    """
    rows = pages.select(pages[f"`{url}`"].alias("url"), empty_or_null(pages[f"`{html}`"]).alias("html"))
    has = F.col("html").rlike(r"(?i)canonical|refresh")
    rows = rows.withColumn("html", F.when(has, F.regexp_replace("html", UNSEEN, " ")).otherwise(""))
    source = F.col("html")
    canonical = _tags(source, "link", r"""(?i)\brel\s*=\s*["']?canonical\b""", HREF)
    refresh = _tags(source, "meta", r"""(?i)\bhttp-equiv\s*=\s*["']?refresh\b""", r"""(?i)\burl\s*=\s*["']?([^"'\s>]+)""")
    none = F.array().cast("array<string>")
    declared = F.when(source != "", F.concat(canonical, refresh)).otherwise(none)
    based = _tags(source, "base", r"(?i)\bhref\s*=", HREF)
    based = F.when(source.rlike("(?i)<base"), F.get(based, F.lit(0)))
    redirector = F.try_url_decode(F.regexp_extract("url", REDIRECT_PARAMETERS, 1))
    rows = rows.where("url is not null").select("url", F.concat(declared, F.array(redirector)).alias("targets"), based.alias("base"))
    rows = rows.select("url", F.coalesce(_absolute(F.col("base"), F.col("url")), "url").alias("base"), "targets")
    found = rows.select("url", "base", F.explode("targets").alias("target"))
    found = found.select("url", _absolute(F.col("target"), F.col("base")).alias("target"))
    return found.where("target is not null and target <> url").distinct()


def rule_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    """(verdict, host, path) of a list of rules."""
    rows = F.array(*(F.struct(*map(F.lit, r)) for r in rules))
    return spark.range(1).select(F.inline(rows.cast("array<struct<verdict:string,host:string,path:string>>")))


def _ruled(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, rule, own) of distinct urls: the longest rule that fits, and its verdict."""
    host, path = parts(F.col("url"))
    # Only endings of as many labels as some rule's host has can fit; a host may have very many.
    counts = sorted(r[0] for r in rules.select(F.size(F.split("host", r"\."))).distinct().collect())
    endings = [F.when(F.size(F.split("host", r"\.")) >= n, F.substring_index("host", ".", -n)) for n in counts]
    suffixes = F.explode(F.array_compact(F.array(*endings)).cast("array<string>")).alias("suffix")
    rows = urls.select("url", host.alias("host"), path.alias("path")).where("host <> ''").select("url", "path", suffixes)
    rules = rules.select("verdict", F.col("host").alias("suffix"), F.col("path").alias("start"))
    fits = rows.join(rules, "suffix").where(F.startswith("path", "start"))
    text = F.concat("suffix", "start")
    # Of rules equal in length the one with the longer host, then allow.
    best = F.max(F.struct(F.length(text), F.length("suffix"), F.col("verdict") == "allow", text.alias("rule"), "verdict"))
    return fits.groupBy("url").agg(best.alias("best")).select("url", "best.rule", F.col("best.verdict").alias("own"))


def judge(pages: DataFrame, rules: DataFrame, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(id, host, path, rule, verdict) for every row of pages.

    ``rules`` has verdict (allow or block), host, path. A rule's verdict holds for what it fits. The
    others are blocked if an equivalent URL is blocked by a rule and none is allowed by one;
    link targets count, whether there is a page of theirs or not. A null URL or one without ``://``
    has an empty host and path and no rule; null and empty pages have no links. Repeated rows are
    judged alike, each in its row. Other columns are not read.
    """
    edges = keep(links(pages, url, html), "edges")
    urls = pages.select(pages[f"`{url}`"].alias("url")).where("url is not null")
    urls = urls.unionByName(edges.select(F.col("target").alias("url"))).distinct()
    ruled = urls.join(_ruled(urls, rules), "url", "left")
    ruled = keep(ruled.select("url", "rule", "own", normal_form(F.col("url")).alias("node")), "urls")
    aliases = connected_components(
        edges.select(normal_form(F.col("url")).alias("a"), normal_form(F.col("target")).alias("b"))
    )
    named = ruled.join(aliases, "node", "left").withColumn("component", F.coalesce("component", "node"))
    decided = named.where("own is not null").groupBy("component")
    decided = decided.agg(F.bool_or(F.col("own") == "allow").alias("allowed"))
    judged = named.join(decided, "component", "left")
    by_alias = F.when(F.col("allowed") == F.lit(False), "block").otherwise("allow")
    judged = judged.select("url", "rule", F.coalesce("own", by_alias).alias("verdict"))
    host, path = parts(F.col("url"))
    rows = pages.select(pages[f"`{id}`"].alias(id), pages[f"`{url}`"].alias("url")).join(judged, "url", "left")
    return rows.select(
        F.col(f"`{id}`"),
        host.alias("host"),
        path.alias("path"),
        "rule",
        F.coalesce("verdict", F.lit("allow")).alias("verdict"),
    )
