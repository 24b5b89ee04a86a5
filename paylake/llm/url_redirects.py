"""URL verdicts by redirect equivalence.

Method.  URLs that redirect or point by a canonical link to one another form
connected components.  A page's own longest rule decides first; a page without
a rule takes the verdict of its component: allowed if any alias is explicitly
allowed, else blocked if any alias is blocked, else allowed.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import materialize, pick, slices
from .components import connected_components

#: Fixed rules of the query: (host, path, verdict).
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]

_TAG = re.compile(r"<(link|meta|base)\b([^>]*)>", re.I)
_ATTRIBUTE = re.compile(r"""(?<![^\s"'/])([^\s"'<>/=]++)\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s"']\S*))""")
_REFRESH = re.compile(r"(?is)\s*[\d.]+\s*[;,\s]\s*(?:url\s*=\s*)?(.*)")
_REFRESH_URL = re.compile(r"(?is)\burl\s*=\s*(.*)")
_SCHEME = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*:")


def rules_table(spark: SparkSession, rules=None) -> DataFrame:
    return spark.createDataFrame(RULES if rules is None else rules, "host string, path string, verdict string")


def host_of(url):
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url):
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_node(url):
    """What two URLs share that name one resource: host and the rest, without scheme and fragment."""
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    rest = F.when(rest == "", "/").when(rest.startswith("?"), F.concat(F.lit("/"), rest)).otherwise(rest)
    return F.when(F.instr(url, "://") > 0, F.concat(host_of(url), rest))


def resolve(url: str, target: str) -> str | None:
    """The URL that a target on the page names (RFC 3986); none for the page itself and for other kinds of link."""
    target = re.sub(r"[\t\r\n]", "", target).strip()
    scheme = _SCHEME.match(target)
    if scheme:
        return target if target.startswith("//", scheme.end()) else None
    if target.startswith("//"):
        return "http:" + target
    if not target or target.startswith("#"):
        return None
    top, path = re.match(r"(?s)(.*?://[^/?#]*)([^?#]*)", url).groups()
    if target.startswith("?"):
        return top + (path or "/") + target
    asked, rest = re.match(r"(?s)([^?#]*)(.*)", target).groups()
    parts = (asked if asked.startswith("/") else (path[:path.rfind("/") + 1] or "/") + asked).split("/")
    out = []
    for i, part in enumerate(parts[1:], 2):
        if part == "..":
            del out[-1:]
        elif part != ".":
            out.append(part)
            continue
        if i == len(parts):
            out.append("")
    return top + "/" + "/".join(out) + rest


def page_targets(url: str, page: str) -> list[str]:
    """All canonical links and refresh targets of a page, resolved."""
    found, base = [], None
    for tag in _TAG.finditer(page):
        have = {}
        for name, *values in _ATTRIBUTE.findall(tag[2]):
            have.setdefault(name.lower(), entities.unescape("".join(values)))
        kind = tag[1].lower()
        if kind == "base" and base is None:
            base = have.get("href")
        elif kind == "link" and "canonical" in [x.strip("/") for x in have.get("rel", "").lower().split()]:
            found.append(have.get("href", ""))
        elif kind == "meta" and have.get("http-equiv", "").strip(" \t\r\n/").lower() == "refresh":
            content = have.get("content", "")
            asked = _REFRESH.match(content) or _REFRESH_URL.search(content)
            if asked:
                to = asked[1].strip()
                found.append(to[1:].split(to[0])[0] if to[:1] in ("'", '"') else to)
    if base is not None:
        url = resolve(url, base) or url
    return [x for x in (resolve(url, to) for to in found) if x]


def _target_pass(batches):
    for whole in batches:
        for batch in slices(whole, "html"):
            urls, pages = (batch.column(c).cast(pa.binary()).to_pylist() for c in ("url", "html"))
            rows = [(url, to) for url, page in zip(urls, pages)
                    for to in page_targets(url.decode("utf-8", "replace"), page.decode("utf-8", "replace"))]
            yield pa.RecordBatch.from_arrays([pa.array([u for u, _ in rows], pa.binary()).cast(pa.string()),
                                              pa.array([t for _, t in rows], pa.string())], ["url", "to"])


def page_edges(pages: DataFrame) -> DataFrame:
    """(a, b) nodes: from a page to all its canonical links and refresh targets.

    Targets are absolute or relative to the scheme, the host, the page's path or
    the page's base element; attributes come in any order.
    """
    low = F.lower(F.col("html"))
    some = pages.where(F.col("url").contains("://") & (low.contains("canonical") | low.contains("refresh")))
    some = some.select("url", "html").mapInArrow(_target_pass, "url string, to string")
    return (some.select(url_node(F.col("url")).alias("a"), url_node(F.col("to")).alias("b"))
            .where("a is not null and b is not null and a <> b"))


def match_rules(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Adds rule and verdict of the longest fitting rule (by host, then by path).

    The hosts of a rule are looked up by equality with each suffix of a page's
    host, so rules may be many; a page makes a row per label of its host at most.
    """
    urls = pages.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    suffix = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    asked = urls.where("host <> ''").select("host", "path", F.explode(suffix).alias("rule_host"))
    ruled = rules.select(F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), F.col("verdict").alias("ruled"))
    fits = asked.join(ruled, "rule_host").where(F.startswith("path", "rule_path"))
    best = fits.groupBy("host", "path").agg(F.max(F.struct(
        (F.length("rule_host") + F.length("rule_path")).alias("size"), F.length("rule_host").alias("h"),
        (F.col("ruled") == "allow").alias("allow"),
        F.concat("rule_host", "rule_path").alias("rule"), "ruled")).alias("m"))
    return pages.join(best.select("host", "path", "m.rule", "m.ruled"), ["host", "path"], "left")


def redirect_verdicts(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None, page_id: str = "page_id",
                      url: str = "url", html: str = "html") -> DataFrame:
    """One row per input row: page_id, host, path, rule, verdict, url.

    ``redirects`` (from_url, to_url) adds known redirects.  Null urls and urls
    without :// have empty host and path, fit no rule and have no aliases: they
    are allowed.  Of equally long rules the one with the longer host wins, then
    allow.  Extra columns are ignored; an empty table gives no rows.
    """
    mine = pick(pages, page_id=page_id, url=url, html=html).withColumn("page_id", F.col("page_id").cast("bigint"))
    edges = page_edges(mine)
    if redirects is not None:
        edges = edges.union(redirects.select(url_node(F.col("from_url")).alias("a"), url_node(F.col("to_url")).alias("b"))
                            .where("a is not null and b is not null and a <> b"))
    edges = materialize(edges.distinct(), "url-edges")
    named = mine.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
                        url_node(F.col("url")).alias("node"))
    ruled = match_rules(named, rules)
    if edges.isEmpty():
        of_node = None
    else:
        names = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
        numbered = materialize(names.withColumn("id", F.monotonically_increasing_id()), "url-nodes")
        links = (edges.join(numbered.select(F.col("node").alias("a"), F.col("id").alias("u")), "a")
                 .join(numbered.select(F.col("node").alias("b"), F.col("id").alias("v")), "b").select("u", "v"))
        comps = connected_components(links)
        of_node = numbered.join(comps.withColumnRenamed("node", "id"), "id").select("node", "comp")
    if of_node is None:  # every node is its own component
        comp = ruled.withColumn("comp", F.lit(None).cast("bigint"))
        spread = None
    else:
        # rules also hold for aliases that are no pages themselves
        alias = of_node.select("comp", F.regexp_extract("node", r"(?s)^([^/?#]*)", 1).alias("host"),
                               F.regexp_extract("node", r"(?s)^[^/?#]*([^?#]*)", 1).alias("path"))
        spread = match_rules(alias, rules).where("ruled is not null").groupBy("comp").agg(
            F.max(F.col("ruled") == "allow").alias("some_allow"))
        comp = ruled.join(of_node, "node", "left").join(spread, "comp", "left")
    method = F.lit("allow") if spread is None else F.when(F.col("some_allow") | F.col("some_allow").isNull(), "allow").otherwise("block")
    return comp.select("page_id", "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"), "url")
