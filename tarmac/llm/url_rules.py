"""URL filters with redirect equivalence, with DataFrame operations only.

Rules judge the urls they fit. Redirects and canonical links in the pages are edges between urls; connected components over
these edges join aliases, and a url without a rule takes the decision of its aliases: allow if a rule explicitly allows one of
them, else block if a rule blocks one, else allow.

Pages are judged where they are read. Only edges, and the decisions of urls that have an edge, are shuffled. A rule list of any
length is a table: hosts' suffixes and the path beginnings of the lengths that rules of such a host have meet it in equi-joins.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.components import connected_components
from tarmac.llm.joins import sized
from tarmac.plans.storage import materialize

#: (host, path, verdict) of the contract.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
#: Rules up to which they are part of the plan; more are joined as a table, with the same result.
INLINE_RULES = 200

_NO_MARKUP = r"(?is)<!--.*?(?:-->|\z)|<(script|style|template|textarea|title|xmp|iframe|noembed|noframes|noscript)\b[^>]*>.*?(?:</\1\s*>|\z)"
_TAG = r"(?is)<(?:link|meta)\b[^>]*>"
_BASE = r"(?is)<base\b[^>]*>"
# Pieces of an attribute value: references and what stands between them.
_PIECE = r"(?s)&(?:#[xX][0-9a-fA-F]+|#[0-9]+|[a-zA-Z][a-zA-Z0-9]*);|&|[^&]+"
_NAMED = json.dumps({f"&{k}": v for k, v in html5.items() if k.endswith(";")})
_ATTRIBUTE = r"""(?is)\b{}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?`` or ``#``, with A-Z in lower case; empty without ``://``."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _longest_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The fitting rule as struct(rule, verdict); longest text first, then in order of text."""
    by_length = sorted({(h.lower(), p, v) for h, p, v in rules}, key=lambda r: (-len(r[0] + r[1]), r))
    choices = []
    for rule_host, rule_path, verdict in by_length:
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        choices.append(F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.coalesce(*choices) if choices else F.lit(None).cast("struct<rule:string,verdict:string>")


def _rule_table(spark: SparkSession, rules: list[tuple[str, str, str]] | DataFrame) -> DataFrame:
    """(host, path, verdict), each once, hosts in lower case."""
    table = rules if isinstance(rules, DataFrame) else spark.createDataFrame(rules, "host string, path string, verdict string")
    table = materialize(table.select(F.lower("host").alias("host"), "path", "verdict").distinct(), "rules")
    if not table.where("verdict is null or verdict not in ('allow', 'block')").isEmpty():
        raise ValueError("a rule allows or blocks")
    return table


def _joined_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls`` (host, path, each pair once) with their rule as ``_r``, null where none fits; longest text first, then in order
    of host, path and verdict."""
    # a host has a few suffixes; a suffix with rules has a few lengths of their paths, so each url makes few rows
    labels = F.split("host", r"\.")
    suffix = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    lengths = materialize(rules.groupBy(F.col("host").alias("_s")).agg(F.collect_set(F.length("path")).alias("_lengths")), "rule-hosts")
    known = urls.select("host", "path", F.explode(suffix).alias("_s")).join(sized(lengths, 128), "_s")
    long_enough = F.filter("_lengths", lambda n: n <= F.length("path"))
    asked = known.select("host", "path", "_s", F.explode(long_enough).alias("_n")).withColumn("_p", F.expr("substring(path, 1, _n)"))
    fits = asked.join(sized(rules.select(F.col("host").alias("_s"), F.col("path").alias("_p"), "verdict"), 128), ["_s", "_p"])
    rank = F.struct((-F.length(F.concat("_s", "_p"))).alias("n"), F.col("_s").alias("s"), F.col("_p").alias("p"), F.col("verdict").alias("v"))
    best = fits.groupBy("host", "path").agg(F.min(rank).alias("_b"))
    found = F.struct(F.concat("_b.s", "_b.p").alias("rule"), F.col("_b.v").alias("verdict"))
    return urls.join(best, ["host", "path"], "left").select("host", "path", F.when(F.col("_b").isNotNull(), found).alias("_r"))


def _with_rules(rows: DataFrame, rules: list[tuple[str, str, str]] | DataFrame) -> DataFrame:
    """``rows`` (with host and path) with their rule as ``_r``."""
    if not isinstance(rules, DataFrame) and any(verdict not in ("allow", "block") for _, _, verdict in rules):
        raise ValueError("a rule allows or blocks")
    if not isinstance(rules, DataFrame) and len(rules) <= INLINE_RULES:
        return rows.withColumn("_r", _longest_rule(F.col("host"), F.col("path"), rules))
    pairs = _joined_rules(rows.select("host", "path").distinct(), _rule_table(rows.sparkSession, rules))
    return rows.join(materialize(pairs, "ruled"), ["host", "path"], "left")


def _attribute(tag: Column, name: str) -> Column:
    """Value of an attribute, empty if it is missing."""
    pattern = _ATTRIBUTE.format(name)
    return F.concat(*[F.regexp_extract(tag, pattern, i) for i in (1, 2, 3)])


def _code_point(digits: Column, base: int) -> Column:
    digits = F.regexp_replace(digits, "^0+", "")
    code = F.when(F.length(digits).between(1, 7), F.conv(digits, base, 10).cast("long"))
    known = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    return F.when(known, F.decode(F.unhex(F.lpad(F.hex(F.when(known, code)), 8, "0")), "UTF-32")).otherwise("\ufffd")


def _unescaped(value: Column) -> Column:
    """Attribute value with its character references decoded; those without a semicolon stay."""

    def decoded(piece: Column) -> Column:
        named = F.try_element_at(F.from_json(F.lit(_NAMED), "map<string,string>"), piece)
        return (
            F.when(piece.rlike("^&#[xX]"), _code_point(F.regexp_extract(piece, "^&#[xX]([0-9a-fA-F]+);$", 1), 16))
            .when(piece.startswith("&#"), _code_point(F.regexp_extract(piece, "^&#([0-9]+);$", 1), 10))
            .when(piece.startswith("&"), F.coalesce(named, piece))
            .otherwise(piece)
        )

    pieces = F.regexp_extract_all(value, F.lit(_PIECE), F.lit(0))
    return F.when(value.contains("&"), F.array_join(F.transform(pieces, decoded), "")).otherwise(value)


def _absolute(target: Column, url: Column) -> Column:
    """Decoded link target as an absolute url without fragment, dot segments left in; null if it names no page."""
    target = F.trim(F.regexp_replace(F.regexp_replace(target, r"[\t\n\r]", ""), r"(?s)#.*$", ""))
    scheme = F.regexp_extract(url, r"(?s)^(.*?)://", 1)
    site = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    document = F.regexp_extract(url, r"(?s)^(.*?://[^?#]*)", 1)
    folder = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*(?:/[^?#]*/|/)?)", 1)
    return (
        F.when(target == "", None)
        .when(target.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*://"), target)
        .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
        .when(target.startswith("/"), F.concat(site, target))
        .when(target.startswith("?"), F.concat(document, target))
        .when(target.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), None)
        .otherwise(F.concat(folder, F.when(folder.endswith("/"), "").otherwise("/"), target))
    )


def _without_dots(path: Column) -> Column:
    """Path with its ``.`` and ``..`` segments resolved."""
    segments = F.transform(F.split(F.substr(path, F.lit(2)), "/"), lambda s: F.when(s.rlike(r"(?i)^(?:\.|%2e){1,2}$"), F.regexp_replace(s, "(?i)%2e", ".")).otherwise(s))
    kept = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda seen, s: F.when(s == ".", seen).when(s == "..", F.slice(seen, F.lit(1), F.greatest(F.size(seen) - 1, F.lit(0)))).otherwise(F.concat(seen, F.array(s))),
    )
    kept = F.when(F.element_at(segments, -1).isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    return F.when(path.rlike(r"(?i)/(?:\.|%2e){1,2}(?:/|$)"), F.concat(F.lit("/"), F.array_join(kept, "/"))).otherwise(path)


def node_name(url: Column) -> Column:
    """Urls that differ in nothing but the fragment, dot segments, the default file mark of an empty path, or capitals of the host are one."""
    scheme = F.lower(F.regexp_extract(url, r"(?s)^(.*?)://", 1))
    query = F.regexp_extract(url, r"(?s)^[^?#]*(\?[^#]*)", 1)
    path = url_path(url)
    named = F.concat(scheme, F.lit("://"), url_host(url), F.when(path == "", "/").otherwise(_without_dots(path)), query)
    return F.when(url.contains("://"), named)


def alias_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(src, dst) for each canonical link and each immediate redirect of a page, by node name."""
    url, mentions = F.col(url_col).cast("string"), F.col(html_col).cast("string").rlike("(?i)canonical|http-equiv")
    # what stands in comments, scripts and other raw text is no markup
    html = F.regexp_replace(F.when(mentions, F.col(html_col).cast("string")), _NO_MARKUP, " ")
    bases = F.filter(F.transform(F.regexp_extract_all(html, F.lit(_BASE), F.lit(0)), lambda t: _attribute(t, "href")), lambda h: h != "")
    tags = F.regexp_extract_all(html, F.lit(_TAG), F.lit(0))
    linked = pages.where(mentions).select(url.alias("_url"), F.get(bases, 0).alias("_base"), F.explode(tags).alias("_tag"))
    canonical = F.when(F.array_contains(F.split(F.lower(_attribute(F.col("_tag"), "rel")), r"\s+"), "canonical"), _attribute(F.col("_tag"), "href"))
    refresh = F.when(F.lower(_attribute(F.col("_tag"), "http-equiv")) == "refresh", F.regexp_extract(_attribute(F.col("_tag"), "content"), r"""(?is)^\s*0*(?:\.[\d.]*)?\s*[;,]\s*url\s*=\s*['"]?([^'"]*)""", 1))
    found = linked.select("_url", "_base", F.coalesce(canonical, refresh).alias("_link")).where("_link <> ''")
    # each step is written, so that its long expressions do not meet the next ones in a single generated method
    found = materialize(found, "links")
    found = materialize(found.select("_url", _unescaped(F.col("_base")).alias("_base"), _unescaped(F.col("_link")).alias("_link")), "links")
    found = materialize(found.select("_url", F.coalesce(_absolute(F.col("_base"), F.col("_url")), F.col("_url")).alias("_base"), "_link"), "links")
    found = materialize(found.select("_url", _absolute(F.col("_link"), F.col("_base")).alias("_target")), "links")
    return materialize(found.select(node_name(F.col("_url")).alias("src"), node_name(F.col("_target")).alias("dst")), "links")


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]] | DataFrame = RULES, redirects: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id_col``, host, path, rule and verdict of every row. ``redirects`` (src, dst urls) may add edges from a crawl log;
    ``rules`` is a list or a table of (host, path, verdict) of any length.

    A null url, or one without ``://``, has empty host and path, no rule, no alias and is allowed; null html has no links;
    repeated rows and repeated urls each get the same verdict; other columns are not read; an empty table gives an empty result.
    """
    url = F.col(url_col).cast("string")
    host, path = url_host(url), url_path(url)
    judged = pages.select(F.col(id_col).alias("_id"), host.alias("host"), path.alias("path"), node_name(url).alias("_node"))
    judged = _with_rules(judged, rules)
    edges = alias_edges(pages, url_col, html_col)
    if redirects is not None:
        edges = edges.union(redirects.select(node_name(F.col("src")), node_name(F.col("dst"))))
    groups = materialize(connected_components(edges), "aliases")
    # every node of a component is judged by name, whether or not it is a page of the table
    named = groups.select("component", url_host(F.col("node")).alias("host"), url_path(F.col("node")).alias("path"))
    named = _with_rules(named, rules).select("component", F.col("_r.verdict").alias("_v"))
    decided = named.groupBy("component").agg(F.max(F.when(F.col("_v") == "allow", 2).when(F.col("_v") == "block", 1).otherwise(0)).alias("_d"))
    blocked = materialize(groups.join(decided.where("_d = 1"), "component").select(F.col("node").alias("_blocked")).distinct(), "blocked")
    out = judged.join(sized(blocked, 200), F.col("_node") == F.col("_blocked"), "left")
    verdict = F.coalesce(F.col("_r.verdict"), F.when(F.col("_blocked").isNotNull(), "block"), F.lit("allow"))
    return out.select(F.col("_id").alias(id_col), "host", "path", F.col("_r.rule").alias("rule"), verdict.alias("verdict"))
