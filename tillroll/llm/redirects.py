"""URL filters with redirect equivalence.

Addresses that redirect to each other or name each other as canonical are one
resource.  Rules on (host, path) decide the addresses they fit, the longest
rule first.  An address without a rule takes the decision of its component of
redirect and canonical links: ``block`` if the component holds a blocked
address and no allowed one, else ``allow`` (an explicit allow goes first).

Links and components stay distributed (see :func:`.common.components`); no
list of links or of nodes reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, lower_ascii, stored

LINK = r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*\bhref\s*=\s*["']?\s*([^"'\s>]+)"""
REFRESH = r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*\bcontent\s*=\s*["']?[^"'>]*?\burl\s*=\s*["']?\s*([^"'\s>]+)"""

#: (verdict, host, path); a rule fits its host and all subdomains.
Rule = tuple[str, str, str]


def host_of(url: str) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(lower_ascii(F.regexp_extract(F.col(url), r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: str) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(F.col(url), r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def without_dots(path: Column) -> Column:
    """A path that starts with ``/`` without its ``.`` and ``..`` segments."""
    parts = F.split(path, "/")
    last = F.when(F.element_at(parts, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    kept = F.aggregate(F.slice(parts, 2, F.size(parts)), F.array().cast("array<string>"), lambda done, part: (
        F.when(part == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
        .when(part == ".", done).otherwise(F.concat(done, F.array(part)))))
    return F.when(path.rlike(r"/\.\.?(/|$)"), F.concat(F.lit("/"), F.array_join(F.concat(kept, last), "/"))).otherwise(path)


def node_of(url: Column) -> Column:
    """The address without fragment and dot segments, scheme and host lower-cased."""
    bare = F.regexp_replace(url, r"(?s)#.*$", "")
    head = F.regexp_extract(bare, r"(?s)^(.*?://[^/?#]*)", 1)
    path = F.regexp_extract(bare, r"(?s)^.*?://[^/?#]*(/[^?]*)", 1)
    return F.concat(lower_ascii(head), without_dots(path), F.substr(bare, F.length(head) + F.length(path) + 1))


def resolved(target: Column, base: str) -> Column:
    """The whole address of a link's target on the page at ``base``, as in RFC
    3986; null if there is none (no web address, or ``base`` has no scheme)."""
    page = F.col(base)
    scheme = F.regexp_extract(page, r"(?s)^([A-Za-z][A-Za-z0-9+.\-]*)://", 1)
    site = F.regexp_extract(page, r"(?s)^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    folder = F.regexp_extract(path_of(base), r"(?s)^(.*/)", 1)
    return (F.when(target.rlike(r"(?s)^[A-Za-z][A-Za-z0-9+.\-]*://"), target)
            .when(target.rlike(r"(?s)^[A-Za-z][A-Za-z0-9+.\-]*:") | (scheme == ""), F.lit(None).cast("string"))
            .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
            .when(target.startswith("/"), F.concat(site, target))
            .when(target.startswith("?"), F.concat(site, path_of(base), target))
            .when(target.startswith("#"), page)
            .otherwise(F.concat(site, F.when(folder == "", "/").otherwise(folder), target)))


def judged(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``rule`` and ``rule_verdict`` (null if none fits) from ``host, path``."""
    longest = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))

    def fits(host: str, path: str) -> Column:
        inside = (F.col("host") == host) | F.col("host").endswith("." + host)
        return inside & F.col("path").startswith(path)

    rule = verdict = F.lit(None).cast("string")
    for said, host, path in reversed(longest):
        rule = F.when(fits(host, path), F.lit(host + path)).otherwise(rule)
        verdict = F.when(fits(host, path), F.lit(said)).otherwise(verdict)
    return df.withColumn("rule", rule).withColumn("rule_verdict", verdict)


def page_links(pages: DataFrame) -> DataFrame:
    """Redirect and canonical edges ``(url, target)`` of ``pages(url, html)``,
    all of a page's links."""
    def every(pattern: str) -> Column:
        return F.regexp_extract_all("html", F.lit(pattern), F.lit(1))

    found = F.concat(*[F.coalesce(c, F.array().cast("array<string>")) for c in (
        F.when(F.col("html").contains("anonical") | F.lower("html").contains("canonical"), every(LINK)),
        F.when(F.lower("html").contains("refresh"), every(REFRESH)))])
    return (pages.select("url", F.explode(found).alias("target")).where("url is not null and target <> ''")
            .select("url", F.regexp_replace("target", "&amp;", "&").alias("target")))


def filter_urls(pages: DataFrame, rules: Sequence[Rule], links: DataFrame | None = None) -> DataFrame:
    """One row for each row of ``pages(page_id, url, html)``: ``page_id, host,
    path, rule, verdict, alias_of`` (the component's smallest address; null if
    the address stands alone).  ``links(url, target)`` adds edges from
    elsewhere, such as a crawl's redirect log.  Targets are completed from the
    page's address; those that name no web address (``mailto:``) are no links.

    A null url, or one without ``://``, has empty host and path, fits no rule
    and is allowed.  Repeated rows get a row each; an empty table gives none;
    other columns are not read."""
    edges = page_links(pages)
    if links is not None:
        edges = edges.unionByName(links.where("url is not null and target is not null").select("url", "target"))
    edges = (edges.select("url", resolved(F.col("target"), "url").alias("target")).where("target is not null")
             .select(node_of(F.col("url")).alias("a"), node_of(F.col("target")).alias("b"))
             .where("a <> '' and b <> ''"))
    member = stored(components(edges, "alias-edges"), "aliases")
    known = judged(member.select("node", "root", host_of("node").alias("host"), path_of("node").alias("path")), rules)
    of_root = (known.groupBy("root").agg(F.max((F.col("rule_verdict") == "block").cast("int")).alias("any_block"),
                                         F.max((F.col("rule_verdict") == "allow").cast("int")).alias("any_allow"))
               .select(F.col("root").alias("r"),
                       F.when((F.coalesce("any_block", F.lit(0)) == 1) & (F.coalesce("any_allow", F.lit(0)) == 0), "block")
                       .otherwise("allow").alias("shared")))
    of_node = member.join(of_root, F.col("root") == F.col("r")).select("node", "root", "shared")
    own = judged(pages.select("page_id", host_of("url").alias("host"), path_of("url").alias("path"),
                              node_of(F.col("url")).alias("own_node")), rules)
    return (own.join(of_node, F.col("own_node") == F.col("node"), "left")
            .select("page_id", "host", "path", "rule",
                    F.coalesce("rule_verdict", "shared", F.lit("allow")).alias("verdict"),
                    F.col("root").alias("alias_of")))
