"""URL filters: block and allow rules, carried to aliases through redirects and canonical links."""

from __future__ import annotations

import html
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, stored
from .graph import connected_components

#: Rules become part of the query plan, so their number is bounded.
MAX_RULES = 1000


@dataclass(frozen=True)
class Rule:
    """`pattern` is a host and a path, such as example.com/de/; `verdict` is allow or block."""

    verdict: str
    pattern: str

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.pattern.partition("/")[2]


def host_of(url: Column) -> Column:
    """Lower-cased (A-Z) from the first :// up to /, ?, # or the end; empty if there is none."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host, up to ?, # or the end; empty without a host."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _without_dots(path: Column) -> Column:
    """The path with its . and .. segments resolved."""
    single, double = r"(?i)^(\.|%2e)$", r"(?i)^(\.|%2e){2}$"
    parts = F.split(path, "/")
    walked = F.aggregate(
        F.slice(parts, 2, F.size(parts)),
        F.array().cast("array<string>"),
        lambda seen, p: F.when(p.rlike(double), F.slice(seen, 1, F.greatest(F.size(seen) - 1, F.lit(0))))
        .when(p.rlike(single), seen)
        .otherwise(F.concat(seen, F.array(p))),
    )
    last = F.element_at(parts, -1)
    walked = F.when(last.rlike(single) | last.rlike(double), F.concat(walked, F.array(F.lit("")))).otherwise(walked)
    resolved = F.concat(F.lit("/"), F.array_join(walked, "/"))
    return F.when(path.rlike(r"(?i)/(\.|%2e){1,2}(/|\z)"), resolved).otherwise(path)


def query_of(url: Column) -> Column:
    """The ? and what follows it, up to # or the end; empty without one."""
    return F.regexp_extract(url, r"(?s)^.*?://[^?#]*(\?[^#]*)?", 1)


def node_of(url: Column) -> Column:
    """The address an alias is known by: lower-cased host and the rest without the fragment.

    http and https are one address, and . and .. segments are resolved. Null for a URL without ://.
    """
    return F.when(url.contains("://"), F.concat(host_of(url), _without_dots(path_of(url)), query_of(url)))


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits, as struct (rule, verdict); null if none does.

    Of rules of one length the first listed wins.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MAX_RULES}")
    kind = "struct<rule:string,verdict:string>"
    found = F.lit(None).cast(kind)
    for rule in sorted(reversed(rules), key=lambda r: len(r.pattern)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.pattern).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


#: Numeric references and the named ones of HTML's own signs; without a semicolon as in attributes.
REFERENCE = r"&(?:#[xX][0-9A-Fa-f]+;?|#[0-9]+;?|(?:amp|lt|gt|quot)(?:;|(?![=A-Za-z0-9;]))|apos;)"
NAMED = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'"}
#: What HTML reads the references 128 to 159 as.
WINDOWS = [html.unescape(f"&#{i};") for i in range(128, 160)]


def _decoded(text: Column) -> Column:
    """Character references decoded, in one pass: what a reference gives is not read again."""

    def sign(token: Column) -> Column:
        sixteen = F.regexp_extract(token, r"^&#[xX]0*([0-9A-Fa-f]+);?$", 1)
        ten = F.regexp_extract(token, r"^&#0*([0-9]+);?$", 1)
        code = F.when(sixteen.rlike("^.{1,6}$"), F.conv(sixteen, 16, 10).cast("int")).when(ten.rlike("^.{1,7}$"), ten.cast("int"))
        known = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        out = F.when(code.between(128, 159), F.element_at(F.array(*map(F.lit, WINDOWS)), code - 127))
        out = out.when(known, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise(F.lit("\ufffd"))
        found = F.when(token.startswith("&#"), out)
        for name, value in NAMED.items():
            found = found.when(token.startswith("&" + name), F.lit(value))
        return found.otherwise(token)

    tokens = F.regexp_extract_all(text, F.lit(f"(?s){REFERENCE}|[^&]+|&"), F.lit(0))
    return F.when(text.contains("&"), F.array_join(F.transform(tokens, sign), "")).otherwise(text)


def _target(base: Column, href: Column) -> Column:
    """`href` as an absolute URL, taken relative to `base`; `node_of` resolves its dot segments."""
    scheme = F.regexp_extract(base, r"^(.*?)://", 1)
    root = F.concat(scheme, F.lit("://"), host_of(base))
    folder = F.regexp_extract(path_of(base), r"(?s)^(.*/)", 1)
    folder = F.when(folder == "", "/").otherwise(folder)
    return (
        F.when(href.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), href)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href.startswith("/"), F.concat(root, href))
        .when(href.startswith("?"), F.concat(root, path_of(base), href))
        .when(href.startswith("#"), F.concat(root, path_of(base), query_of(base), href))
        .when(href != "", F.concat(root, folder, href))
    )


#: Fixed patterns of the two tags that name another address of a page.
LINK_TAG = r"(?is)<link\b[^>]*>"
META_TAG = r"(?is)<meta\b[^>]*>"
CANONICAL = r"(?is)\brel\s*=\s*[\"']?\s*canonical\b"
HREF = r"(?is)\bhref\s*=\s*[\"']?\s*([^\"'\s>]+)"
REFRESH = r"(?is)\bhttp-equiv\s*=\s*[\"']?\s*refresh\b"
REFRESH_URL = r"(?is)\burl\s*=\s*[\"']?\s*([^\"'\s>]+)"
HINT = r"(?is)canonical|refresh"


def alias_edges(pages: DataFrame) -> DataFrame:
    """(a, b): addresses joined by a canonical link or a refresh redirect in `html`."""
    hinted = pages.filter(F.col("html").rlike(HINT)).select("url", "html")
    tags = lambda tag, kind: F.filter(F.regexp_extract_all("html", F.lit(tag), F.lit(0)), lambda t: t.rlike(kind))
    found = F.concat(
        F.transform(tags(LINK_TAG, CANONICAL), lambda t: F.regexp_extract(t, HREF, 1)),
        F.transform(tags(META_TAG, REFRESH), lambda t: F.regexp_extract(t, REFRESH_URL, 1)),
    )
    each = hinted.select("url", F.explode(found).alias("href")).select("url", _decoded(F.col("href")).alias("href"))
    return each.select(node_of(F.col("url")).alias("a"), node_of(_target(F.col("url"), F.col("href"))).alias("b"))


def judge_urls(pages: DataFrame, rules: list[Rule], edges: DataFrame | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of `pages` (page_id, url and html).

    A rule fits its host and all subdomains if the path starts with the rule's path; the
    longest rule wins and decides. A URL without a rule takes the decisions of its aliases,
    the addresses connected to it by `edges` (a, b as from `alias_edges`, by default those
    found in html): allow if any of them has an allow rule, else block if any has a block
    rule. A URL with neither is allowed.

    A null URL or one without :// has empty host and path, no rule and no alias. Null html has
    no links. Repeated rows are judged alike; an empty table gives an empty table; other
    columns are not read. Components are written to the scratch folder as they are found.
    """
    edges = alias_edges(pages) if edges is None else edges
    placed = connected_components(edges, "a", "b")
    address = F.concat(F.lit("://"), F.col("id"))
    member = placed.select("id", "component", rule_of(host_of(address), path_of(address), rules)["verdict"].alias("v"))
    groups = member.groupBy("component").agg(F.bool_or(F.col("v") == "allow").alias("any_allow"), F.bool_or(F.col("v") == "block").alias("any_block"))
    decided = placed.join(groups, "component").select(
        F.col("id").alias("node"), F.when(F.col("any_allow"), "allow").when(F.col("any_block"), "block").alias("carried")
    )
    decided = stored(decided.filter(F.col("carried").isNotNull()), "alias-verdicts")
    url = F.col("url")
    judged = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), node_of(url).alias("node"))
    judged = judged.withColumn("found", rule_of(F.col("host"), F.col("path"), rules))
    # rows without an address match nothing; a place of their own keeps them from one task
    judged = judged.withColumns({"known": F.col("node").isNotNull(), "node": F.coalesce("node", F.monotonically_increasing_id().cast("string"))})
    return judged.join(decided.withColumn("known", F.lit(True)), ["node", "known"], "left").select(
        "page_id",
        "host",
        "path",
        F.col("found.rule").alias("rule"),
        F.coalesce("found.verdict", "carried", F.lit("allow")).alias("verdict"),
    )


def oracle(rules: list[Rule], pages: str = "pages") -> str:
    """The same rows in SQL for pages whose links hold no dot segment and no reference but those of the given tables.

    `test_url_aliases` covers what `_decoded` and `_target` do beyond that.
    """
    host = lambda u: f"translate(coalesce(regexp_extract({u}, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    path = lambda u: f"coalesce(regexp_extract({u}, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '')"
    node = lambda u: f"CASE WHEN contains({u}, '://') THEN {host(u)} || regexp_extract({u}, '(?s)^.*?://[^/?#]*([^#]*)', 1) END"
    sql = lambda p: p.replace("'", "''")
    by_length = sorted(rules, key=lambda r: -len(r.pattern))
    pick = lambda what, h, p: "CASE " + " ".join(
        f"WHEN ({h} = '{r.host}' OR ends_with({h}, '.{r.host}')) AND starts_with({p}, '{r.path}') THEN '{getattr(r, what)}'"
        for r in by_length
    ) + " END"
    tags = lambda tag, kind, get: (
        f"SELECT url, regexp_extract(t, '{sql(get)}', 1) AS href FROM (SELECT url, unnest(regexp_extract_all(html, '{sql(tag)}')) AS t"
        f" FROM {pages}) x WHERE regexp_matches(t, '{sql(kind)}')"
    )
    root = f"regexp_extract(url, '^(.*?)://', 1) || '://' || {host('url')}"
    folder = f"regexp_extract({path('url')}, '(?s)^(.*/)', 1)"
    target = (
        "CASE WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN href "
        "WHEN starts_with(href, '//') THEN regexp_extract(url, '^(.*?)://', 1) || ':' || href "
        f"WHEN starts_with(href, '/') THEN {root} || href "
        f"WHEN href <> '' THEN {root} || CASE WHEN {folder} = '' THEN '/' ELSE {folder} END || href END"
    )
    return f"""
    WITH RECURSIVE links AS (
      SELECT url, {target} AS other FROM ({tags(LINK_TAG, CANONICAL, HREF)} UNION ALL {tags(META_TAG, REFRESH, REFRESH_URL)}) l),
    edges AS (SELECT {node('url')} AS a, {node('other')} AS b FROM links),
    ends AS (SELECT a, b FROM edges WHERE a IS NOT NULL AND b IS NOT NULL UNION SELECT b, a FROM edges
             WHERE a IS NOT NULL AND b IS NOT NULL),
    reach(id, other) AS (SELECT a, a FROM ends UNION SELECT r.id, e.b FROM reach r JOIN ends e ON r.other = e.a),
    carried AS (
      SELECT id, CASE WHEN bool_or(v = 'allow') THEN 'allow' WHEN bool_or(v = 'block') THEN 'block' END AS verdict
      FROM (SELECT id, {pick('verdict', "split_part(split_part(other, '?', 1), '/', 1)", "regexp_extract(other, '^[^/?]*([^?]*)', 1)")} AS v FROM reach) m
      GROUP BY id)
    SELECT page_id, host, path, rule, coalesce(own, c.verdict, 'allow') AS verdict
    FROM (SELECT page_id, host, path, node, {pick('pattern', 'host', 'path')} AS rule, {pick('verdict', 'host', 'path')} AS own
          FROM (SELECT page_id, {host('url')} AS host, {path('url')} AS path, {node('url')} AS node FROM {pages}) p) q
    LEFT JOIN carried c ON c.id = q.node"""
