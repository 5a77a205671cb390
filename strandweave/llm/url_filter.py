"""URL rules that follow redirects and canonical links.

URLs joined by redirect or canonical-link edges are aliases of one thing; a block of one of them holds for all
aliases that no rule of their own decides, unless one of them is explicitly allowed. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table
from .components import connected_components

#: (verdict, host, path) as the contract of the query fixes them.
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]

_META_TAG = r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\x22']?refresh\b[^>]*>"
_META_URL = r"(?is)\burl\s*=\s*[\x22']?([^\x22'\s>]+)"
_ATTRIBUTE = r"(?is)[\s\x22'/]{}\s*=\s*(?:\x22([^\x22]*)\x22|'([^']*)'|([^\s\x22'>]+))"
_URL = r"(?s)^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?"
_ENTITIES = {"amp;": "&", "lt;": "<", "gt;": ">", "quot;": '"', "apos;": "'"}
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for null."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://`` or for null."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _without_dots(path: Column) -> Column:
    """``.`` and ``..`` segments of a path that begins with ``/`` resolved, as the URL standard does."""
    names = F.split(path, "/")
    dot = lambda x: F.regexp_replace(x, "(?i)%2e", ".")
    kept = F.aggregate(F.slice(names, 2, F.size(names)), F.array().cast("array<string>"), lambda acc, x: (
        F.when(dot(x) == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .when(dot(x) == ".", acc).otherwise(F.concat(acc, F.array(x)))))
    last = F.when(dot(F.element_at(names, -1)).isin(".", ".."), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    return F.when(path.rlike(r"(?i)/(\.|%2e){1,2}(/|$)"), F.concat(F.lit("/"), F.array_join(F.concat(kept, last), "/"))).otherwise(path)


def node_of(url: Column) -> Column:
    """The URL as a node of the graph: without its fragment, in the form the URL standard gives it.

    Scheme and host are lower-cased, an empty path is ``/``, dot segments are resolved and the port of the scheme is
    left out. What has no ``scheme://`` only loses its fragment.
    """
    part = lambda i: F.regexp_extract(url, _URL, i)
    scheme = F.translate(part(1), _UPPER, _LOWER)
    user, host = F.regexp_extract(part(2), "(?s)^(.*@)?", 1), F.translate(F.regexp_extract(part(2), "(?s)([^@]*)$", 1), _UPPER, _LOWER)
    host = (F.when(scheme == "http", F.regexp_replace(host, ":(80)?$", ""))
            .when(scheme == "https", F.regexp_replace(host, ":(443)?$", "")).otherwise(host))
    path = F.when(part(3) == "", F.lit("/")).otherwise(_without_dots(part(3)))
    return F.when(url.rlike(_URL), F.concat(scheme, F.lit("://"), user, host, path, part(4))).otherwise(
        F.regexp_extract(url, r"(?s)^([^#]*)", 1))


def rule_columns(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls. A rule fits its host and all subdomains."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, at, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(start)
        rule, verdict = F.when(fits, F.lit(at + start)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def _decoded(text: Column) -> Column:
    """Character references of HTML decoded: by number, and the five named ones of markup."""
    def one(part):
        out = F.concat(F.lit("&"), part)
        for name, letter in _ENTITIES.items():
            rest = F.substring(part, F.lit(len(name) + 1), F.length(part))
            out = F.when(part.startswith(name), F.concat(F.lit(letter), rest)).otherwise(out)
        hexed, tens = (F.regexp_extract(part, r"(?is)^#(?:x0*([0-9a-f]{1,6})|0*([0-9]{1,7}));", i) for i in (1, 2))
        code = F.when(hexed != "", F.conv(hexed, 16, 10)).when(tens != "", tens).cast("long")
        letter = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        return F.when(valid, F.concat(letter, F.regexp_extract(part, "(?s)^[^;]*;(.*)$", 1))).otherwise(out)
    parts = F.split(text, "&")
    return F.when(text.contains("&"), F.concat(F.get(parts, F.lit(0)), F.array_join(
        F.transform(F.slice(parts, 2, F.size(parts)), one), ""))).otherwise(text)


def _absolute(base: Column, link: Column) -> Column:
    """``link`` on the page ``base`` (a node) by the URL standard; null for links that lead to no host (``mailto:``)."""
    part = lambda i: F.regexp_extract(base, _URL, i)
    root = F.concat(part(1), F.lit("://"), part(2))
    return (F.when(link.rlike(_URL), link)
            .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None).cast("string"))
            .when(link.startswith("//"), F.concat(part(1), F.lit(":"), link))
            .when(link.startswith("/"), F.concat(root, link))
            .when(link.startswith("?"), F.concat(root, part(3), link))
            .when(link.startswith("#"), base)
            .otherwise(F.concat(root, F.regexp_extract(part(3), "(?s)^(.*/)", 1), link)))


def alias_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(src, dst) URLs: a page and where its canonical links and refresh redirects lead."""
    text = F.col(html)
    tags = lambda of: F.regexp_extract_all(text, F.lit(of), F.lit(0))
    value = lambda tag, name: F.concat(*[F.regexp_extract(tag, _ATTRIBUTE.format(name), i) for i in (1, 2, 3)])
    canonical = F.filter(tags(r"(?is)<link\b[^>]*>"), lambda t: value(t, "rel").rlike(r"(?i)(^|\s)canonical(\s|/?$)"))
    quotes = r"(?s)^[\s\x22']+|[\s\x22']+$"
    found = F.concat(F.transform(canonical, lambda t: value(t, "href")),
                     F.transform(tags(_META_TAG), lambda t: F.regexp_extract(t, _META_URL, 1)))
    links = pages.filter(text.rlike("(?i)canonical|refresh") & F.col(url).contains("://")).select(
        node_of(F.col(url)).alias("src"), F.explode(found).alias("link"))
    links = links.select("src", F.regexp_replace(_decoded(F.col("link")), quotes, "").alias("link"))
    return (links.filter("link <> ''").select("src", _absolute(F.col("src"), F.col("link")).alias("dst"))
            .filter("dst is not null").select("src", node_of(F.col("dst")).alias("dst")).distinct())


def judge(urls: DataFrame, edges: DataFrame, rules: list[tuple[str, str, str]], url: str = "url",
          default: str = "allow") -> DataFrame:
    """Adds host, path, rule and verdict to every row of ``urls``; columns of these names are replaced.

    A null or unparsable URL has an empty host and path, meets no rule and gets ``default``. Repeated rows are
    each judged. ``edges`` (src, dst) may name URLs that are not among the rows.
    """
    members = connected_components(edges)
    rule, verdict = rule_columns(host_of(F.col("node")), path_of(F.col("node")), rules)
    members = stored(members, "aliases")
    decided = stored(members.withColumn("_v", verdict).groupBy("component").agg(
        F.max(F.col("_v") == "allow").alias("_allow"), F.max(F.col("_v") == "block").alias("_block")), "decided")
    spread = (members.join(decided, "component").select(
        F.col("node").alias("_node"),
        F.when(F.col("_allow"), "allow").when(F.col("_block"), "block").alias("_shared")))
    rows = urls.drop("host", "path", "rule", "verdict") if url not in ("host", "path") else urls
    rows = rows.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url)), "_node": node_of(F.col(url))})
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "_own": verdict}).join(spread, "_node", "left")
    return (rows.withColumn("verdict", F.coalesce("_own", "_shared", F.lit(default)))
            .drop("_node", "_own", "_shared"))


def op5_redirect_equivalence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL under the fixed rules."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return (judge(pages.select("page_id", "url"), alias_edges(pages), RULES)
            .select("page_id", "host", "path", "rule", "verdict"))


def _q(pattern: str) -> str:
    """A pattern as SQL text; octal and hexadecimal escapes read alike in both engines."""
    return "'" + pattern.replace("'", "''") + "'"


def _url_sql(url: str) -> str:
    """``node_of`` in SQL."""
    part = lambda i: f"regexp_extract({url}, {_q(_URL)}, {i})"
    scheme, low = f"translate({part(1)}, '{_UPPER}', '{_LOWER}')", f"'{_UPPER}', '{_LOWER}'"
    user, host = f"regexp_extract({part(2)}, '(?s)^(.*@)?', 1)", f"translate(regexp_extract({part(2)}, '(?s)([^@]*)$', 1), {low})"
    host = (f"CASE {scheme} WHEN 'http' THEN regexp_replace({host}, ':(80)?$', '') WHEN 'https' THEN regexp_replace({host}, ':(443)?$', '') ELSE {host} END")
    return (f"CASE WHEN regexp_matches({url}, {_q(_URL)}) THEN {scheme} || '://' || {user} || {host} || "
            f"CASE WHEN {part(3)} = '' THEN '/' ELSE dots({part(3)}) END || {part(4)} ELSE regexp_extract({url}, '(?s)^([^#]*)', 1) END")


_DOT = "regexp_replace(x, '(?i)%2e', '.', 'g')"
#: Functions of one link, as the steps of ``_without_dots``, ``_decoded`` and ``_absolute`` fix them.
_MACROS = {
    # segments are letters of the stack; a segment of two dots takes the last one off
    "dots(path)": r"""CASE WHEN regexp_matches(path, '(?i)/(\.|%2e){1,2}(/|$)') THEN '/' || array_to_string(list_concat(
        coalesce(list_reduce(list_concat([CAST([] AS VARCHAR[])], list_transform(string_split(path, '/')[2:], lambda x: [x])),
          lambda acc, x: CASE regexp_replace(x[1], '(?i)%2e', '.', 'g') WHEN '..' THEN acc[:greatest(len(acc) - 1, 0)] WHEN '.' THEN acc ELSE list_concat(acc, x) END), []),
        CASE WHEN regexp_replace(string_split(path, '/')[-1], '(?i)%2e', '.', 'g') IN ('.', '..') THEN [''] ELSE [] END), '/') ELSE path END""",
    "letter(code)": "CASE WHEN code BETWEEN 1 AND 55295 OR code BETWEEN 57344 AND 1114111 THEN chr(CAST(code AS INTEGER)) END",
    "part_of(x)": r"""coalesce(letter(CASE WHEN regexp_matches(x, '(?is)^#x0*[0-9a-f]{1,6};') THEN CAST('0x' || regexp_extract(x, '(?is)^#x0*([0-9a-f]{1,6});', 1) AS BIGINT)
          WHEN regexp_matches(x, '(?is)^#0*[0-9]{1,7};') THEN CAST(regexp_extract(x, '(?is)^#0*([0-9]{1,7});', 1) AS BIGINT) END) || regexp_extract(x, '(?s)^[^;]*;(.*)$', 1),
        """ + "CASE " + " ".join(f"WHEN starts_with(x, '{n}') THEN {_q(c)} || substr(x, {len(n) + 1})" for n, c in _ENTITIES.items()) + " ELSE '&' || x END)",
    "decoded(t)": """CASE WHEN contains(t, '&') THEN string_split(t, '&')[1] || array_to_string(list_transform(string_split(t, '&')[2:], lambda x: part_of(x)), '') ELSE t END""",
    "attribute(tag, name)": "regexp_extract(tag, {0}, 1) || regexp_extract(tag, {0}, 2) || regexp_extract(tag, {0}, 3)".format(
        _q(_ATTRIBUTE.split("{}")[0]) + " || name || " + _q(_ATTRIBUTE.split("{}")[1])),
}


def _expanded(sql: str) -> str:
    """The text with every use of the functions above written out, as views have no place for macros."""
    import re
    names = {m.partition("(")[0]: (re.findall(r"\w+", m)[1:], body) for m, body in _MACROS.items()}
    while found := re.search(rf"\b({'|'.join(names)})\(", sql):
        depth, at, given = 1, found.end(), [found.end()]
        while depth:
            if sql[at] == "'":
                at = sql.index("'", at + 1)
            depth += {"(": 1, "[": 1, ")": -1, "]": -1}.get(sql[at], 0)
            if sql[at] == "," and depth == 1:
                given.append(at + 1)
            at += 1
        ends = [*[g - 1 for g in given[1:]], at - 1]
        values = dict(zip(names[found[1]][0], (f"({sql[a:b].strip()})" for a, b in zip(given, ends))))
        body = re.sub(r"'(?:[^']|'')*'|\b(?:" + "|".join(values) + r")\b", lambda m: values.get(m[0], m[0]), names[found[1]][1])
        sql = f"{sql[:found.start()]}({body}){sql[at:]}"
    return sql


_RULE_ROWS = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)
OP5_SQL = _expanded(rf"""
WITH RECURSIVE rules(what, host, path) AS (VALUES {_RULE_ROWS}),
tags AS (
  SELECT url, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\b[^>]*>')) AS tag FROM pages
  WHERE regexp_matches(html, '(?i)canonical|refresh') AND contains(url, '://')),
hrefs AS (
  SELECT url, CASE WHEN regexp_matches(tag, '(?i)^<link\b') THEN
      CASE WHEN regexp_matches(attribute(tag, 'rel'), '(?i)(^|\s)canonical(\s|/?$)') THEN attribute(tag, 'href') ELSE '' END
    WHEN regexp_matches(tag, {_q(_META_TAG)}) THEN regexp_extract(tag, {_q(_META_URL)}, 1) ELSE '' END AS href FROM tags),
raw AS (
  SELECT {_url_sql('url')} AS src, regexp_replace(decoded(href), '(?s)^[\s\x22\x27]+|[\s\x22\x27]+$', '', 'g') AS link FROM hrefs),
bases AS (
  SELECT src, link, regexp_extract(src, {_q(_URL)}, 1) AS scheme, regexp_extract(src, {_q(_URL)}, 3) AS path,
    regexp_extract(src, {_q(_URL)}, 1) || '://' || regexp_extract(src, {_q(_URL)}, 2) AS root FROM raw WHERE link <> ''),
led AS (
  SELECT src, CASE WHEN regexp_matches(link, {_q(_URL)}) THEN link
    WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL
    WHEN starts_with(link, '//') THEN scheme || ':' || link
    WHEN starts_with(link, '/') THEN root || link
    WHEN starts_with(link, '?') THEN root || path || link
    WHEN starts_with(link, '#') THEN src
    ELSE root || regexp_extract(path, '(?s)^(.*/)', 1) || link END AS dst FROM bases),
edges AS (SELECT DISTINCT src, {_url_sql('dst')} AS dst FROM led WHERE dst IS NOT NULL),
both_ways AS (SELECT src, dst FROM edges UNION SELECT dst, src FROM edges),
reach(node, other) AS (
  SELECT src, src FROM both_ways
  UNION SELECT r.node, b.dst FROM reach r JOIN both_ways b ON r.other = b.src),
urls AS (SELECT url AS u FROM pages UNION SELECT other FROM reach),
parts AS (
  SELECT u, translate(coalesce(regexp_extract(u, '(?s)^.*?://([^/?#]*)', 1), ''), '{_UPPER}', '{_LOWER}') AS host,
    coalesce(regexp_extract(u, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM urls),
own AS (
  SELECT p.u, p.host, p.path, r.host || r.path AS rule, r.what FROM parts p LEFT JOIN rules r
    ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  QUALIFY row_number() OVER (PARTITION BY p.u ORDER BY length(r.host || r.path) DESC NULLS LAST) = 1),
shared AS (
  SELECT node, CASE WHEN bool_or(what = 'allow') THEN 'allow' WHEN bool_or(what = 'block') THEN 'block' END AS what
  FROM reach JOIN own ON other = u GROUP BY node)
SELECT page_id, own.host, own.path, own.rule, coalesce(own.what, shared.what, 'allow') AS verdict
FROM pages JOIN own ON own.u IS NOT DISTINCT FROM pages.url
LEFT JOIN shared ON shared.node = {_url_sql('pages.url')}
""")
