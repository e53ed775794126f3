"""URL rules by hashed host-suffix and path-prefix expressions; DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions.sql import derive
from vigil.session import written_table

SHORT = 8  # hex digits of a digest that rows and rules are joined on
BROADCAST_RULES = 200_000  # a rule takes some 150 bytes; more rules are shuffled

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_urls(pages: DataFrame, url: str = "url") -> DataFrame:
    """Adds host (after the first ://, A-Z lower-cased) and path (up to ? or #); both are empty without ://."""
    cut = derive(pages, {"_rest": f"CASE WHEN locate('://', `{url}`) > 0 "
                                  f"THEN substring(`{url}`, locate('://', `{url}`) + 3) ELSE '' END"})
    named = derive(cut, {"_host": "regexp_extract(coalesce(_rest, ''), '^[^/?#]*', 0)"})
    return derive(named, {
        "host": f"translate(_host, '{UPPER}', '{LOWER}')",
        "path": "regexp_extract(substring(coalesce(_rest, ''), length(_host) + 1), '^[^?#]*', 0)"}).drop("_rest", "_host")


def url_verdicts(pages: DataFrame, rules: DataFrame, page_id: str = "page_id", url: str = "url",
                 otherwise: str = "allow") -> DataFrame:
    """Verdict on every URL: page_id, host, path, rule (null if none fits), verdict; one row per input row.

    ``rules`` has host, path and verdict (allow or block). A rule fits its host
    and all subdomains if the path of the URL starts with the rule's; the longest
    host and path wins, block wins a tie of equal rules. Without a rule the
    verdict is ``otherwise``. A null URL, or one without ``://``, has an empty host
    and path. Null parts of a rule count as empty; no rules or no pages are fine;
    repeated rows are rows of their own; other columns are not looked at.

    A URL is expanded to one expression per form (labels of the host, length of
    the path) that some rule has, so a longer URL is never cut short: an expression
    of another form equals no rule. Expressions meet the rules on a short prefix of
    their digest; the full digest then confirms.
    """
    spark = pages.sparkSession
    rows = written_table(spark, split_urls(pages.select(
        F.monotonically_increasing_id().alias("row"), F.col(page_id).alias("page_id"),
        F.col(url).cast("string").alias("url")), "url").drop("url"), "urls")
    known = rules.selectExpr("coalesce(host, '') AS host", "coalesce(path, '') AS path", "verdict").selectExpr(
        "concat(host, path) AS rule", "verdict", "length(host) - length(replace(host, '.', '')) + 1 AS labels",
        "length(path) AS length").distinct()
    forms = [f"struct({r['labels']} AS labels, {r['length']} AS length)"
             for r in known.select("labels", "length").distinct().sort("labels", "length").toLocalIterator()]
    keyed = known.selectExpr("rule", "verdict", "labels", "length", "sha2(rule, 256) AS digest").selectExpr(
        f"substring(digest, 1, {SHORT}) AS short", "digest AS rule_digest", "labels AS l", "length AS k", "rule", "verdict")
    if forms and known.count() <= BROADCAST_RULES:
        keyed = F.broadcast(keyed)
    labels = "length(host) - length(replace(host, '.', '')) + 1"
    expanded = rows.select("row", F.explode(F.expr(
        f"transform(filter(array({', '.join(forms)}), f -> f.labels <= {labels} AND f.length <= length(path)), "
        "f -> named_struct('l', f.labels, 'k', f.length, 'digest', sha2(concat("
        "substring_index(host, '.', -f.labels), substring(path, 1, f.length)), 256)))"
        if forms else "CAST(array() AS array<struct<l: int, k: int, digest: string>>)")).alias("x")).selectExpr(
        "row", "x.l", "x.k", "x.digest", f"substring(x.digest, 1, {SHORT}) AS short")
    fitting = expanded.join(keyed, ["short", "l", "k"]).where("digest = rule_digest")
    best = fitting.groupBy("row").agg(F.expr(
        "max(struct(length(rule) AS size, CASE WHEN verdict = 'block' THEN 1 ELSE 0 END AS blocks, rule, verdict))"
    ).alias("best"))
    return rows.join(best, "row", "left").selectExpr(
        "page_id", "host", "path", "best.rule AS rule", f"coalesce(best.verdict, '{otherwise}') AS verdict")


# The rules of the query.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)

ORACLE = rf"""
WITH rules(h, p, v) AS (VALUES {', '.join(str(r) for r in RULES)}),
cut AS (SELECT row_number() OVER () AS row, page_id,
               CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS (SELECT row, page_id, regexp_extract(coalesce(rest, ''), '^[^/?#]*') AS raw,
             translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
             regexp_extract(substr(coalesce(rest, ''), length(regexp_extract(coalesce(rest, ''), '^[^/?#]*')) + 1),
                            '^[^?#]*') AS path FROM cut),
f AS (SELECT row, h || p AS rule, v, row_number() OVER (PARTITION BY row ORDER BY length(h || p) DESC, v DESC) AS place
      FROM u JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM u LEFT JOIN f ON u.row = f.row AND place = 1
"""
