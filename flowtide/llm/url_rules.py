"""URL filters that know aliases, in DataFrame functions only.

Rules name a host and the start of a path; the longest rule that fits a URL decides.
URLs that redirect to one another, or name one another as their canonical address,
are one thing under several names: they form the components of a graph. A block
decision for one name holds for all names of its component, unless a rule explicitly
allows the name itself.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtide.llm.common import column
from flowtide.llm.components import connected_components
from flowtide.session import materialize

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Verdict, host, start of the path
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

ADDRESS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LINK = r"(?is)<link\b[^>]*>"
CANONICAL = r"(?is)\brel\s*=\s*[\x22']?canonical\b"
HREF = r"(?is)\bhref\s*=\s*[\x22']?([^\x22'\s>]+)"
META = r"(?is)<meta\b[^>]*>"
REFRESH = r"(?is)\bhttp-equiv\s*=\s*[\x22']?refresh\b"
TARGET = r"(?is)\burl\s*=\s*[\x22']?([^\x22'\s>]+)"
MIRROR = r"^(?:www|m|amp)\."
TRACKING = r"(?:^|&)(?:utm_[^&=]*|ref|fbclid|gclid)=[^&]*"


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), ADDRESS, 1)
    return F.translate(host, LETTERS, LETTERS.lower())


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), ADDRESS, 2)


def address(url: Column) -> Column:
    """What names a page: host, path and query. Null without a host."""
    query = F.regexp_extract(url, r"(?s)^[^?#]*(\?[^#]*)", 1)
    host = host_of(url)
    return F.when(host != "", F.concat(host, path_of(url), query))


def plain_address(known: Column) -> Column:
    """The address that mirrors and tracking links of a page redirect to."""
    query = F.regexp_replace(F.regexp_extract(known, r"(?s)\?(.*)$", 1), TRACKING, "")
    query = F.regexp_replace(query, "^&", "")
    place = F.regexp_replace(F.regexp_extract(known, r"(?s)^[^?]*", 0), MIRROR, "")
    place = F.regexp_replace(place, r"/(?:index\.html?)?$", "")
    return F.when(query != "", F.concat(place, F.lit("?"), query)).otherwise(place)


def _decided(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest rule that fits, as a struct of rule and verdict; null if none does."""
    decided = None
    for verdict, rule_host, start in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(start)
        chosen = F.struct(F.lit(rule_host + start).alias("rule"), F.lit(verdict).alias("verdict"))
        decided = F.when(fits, chosen) if decided is None else decided.when(fits, chosen)
    return decided


def _absolute(target: Column, url: Column) -> Column:
    """A link's URL; links without a scheme are relative to their page."""
    target = F.replace(target, F.lit("&amp;"), F.lit("&"))
    scheme, host = F.regexp_extract(url, r"(?s)^(.*?)://", 1), host_of(url)
    root = F.concat(scheme, F.lit("://"), host)
    folder = F.regexp_extract(path_of(url), r"(?s)^(.*/)", 1)
    return (
        F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
        .when(target.startswith("/"), F.concat(root, target))
        .when(target.startswith("#") | (target == ""), url)
        .otherwise(F.concat(root, F.when(folder == "", F.lit("/")).otherwise(folder), target))
    )


def links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``a, b``: addresses that are names of one page.

    Canonical links and refresh redirects of the HTML, and the redirects that mirrors
    and tracking links are known to make. Pages without a host have none.
    """
    url, html = column(url_col), F.coalesce(column(html_col), F.lit(""))
    canonical = F.transform(
        F.filter(F.regexp_extract_all(html, F.lit(LINK), F.lit(0)), lambda tag: tag.rlike(CANONICAL)),
        lambda tag: F.regexp_extract(tag, HREF, 1),
    )
    refreshed = F.transform(
        F.filter(F.regexp_extract_all(html, F.lit(META), F.lit(0)), lambda tag: tag.rlike(REFRESH)),
        lambda tag: F.regexp_extract(tag, TARGET, 1),
    )
    named = F.filter(F.array_union(canonical, refreshed), lambda target: target != "")
    rows = pages.select(url.alias("url"), named.alias("targets"))
    a = address(F.col("url"))
    own = rows.select(a.alias("a"), plain_address(a).alias("b"))
    given = rows.select("url", F.explode("targets").alias("target")).select(
        address(F.col("url")).alias("a"), address(_absolute(F.col("target"), F.col("url"))).alias("b")
    )
    return own.unionByName(given).where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))).distinct()


def _blocked(edges: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """The addresses of all components in which a rule blocks one."""
    nodes = connected_components(edges, "a", "b")
    host = F.regexp_extract("node", r"(?s)^[^/?]*", 0)
    path = F.regexp_extract("node", r"(?s)^[^/?]*([^?]*)", 1)
    verdict = _decided(host, path, rules)["verdict"]
    judged = materialize(nodes.withColumn("hit", F.coalesce(verdict == "block", F.lit(False))), "judged")
    bad = judged.groupBy("component").agg(F.max("hit").alias("hit")).where("hit")
    return judged.join(bad.select("component"), "component", "left_semi").select(F.col("node").alias("address"))


def judge(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """``id_col, host, path, rule, verdict`` for every row of ``pages``.

    The verdict is that of the longest rule that fits the URL. Where none fits, the
    page is blocked if a rule blocks another name of it, and allowed otherwise. A null
    URL, or one without ``://``, has an empty host and path and is allowed. Null HTML
    has no links. Repeated rows keep all their rows. Rules of equal length go by
    verdict, allow first.
    """
    host, path = host_of(column(url_col)), path_of(column(url_col))
    rows = pages.select(
        column(id_col).alias("id"), host.alias("host"), path.alias("path"), address(column(url_col)).alias("address")
    )
    rows = rows.withColumn("decided", _decided(F.col("host"), F.col("path"), rules))
    found = _blocked(links(pages, url_col, html_col), rules).withColumn("aliased", F.lit(True))
    method = F.when(F.col("aliased"), F.lit("block")).otherwise(F.lit("allow"))
    return rows.join(found, "address", "left").select(
        F.col("id").alias(id_col),
        "host",
        "path",
        F.col("decided.rule").alias("rule"),
        F.coalesce(F.col("decided.verdict"), method).alias("verdict"),
    )
