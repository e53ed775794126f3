"""Not-modified revisits of a web archive resolved to the full response they stand for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions.sql import derive
from vigil.session import written_table

SLICE = 3600  # seconds; the window of one URL and slice has at most twice as many rows

# The header fields that a not-modified answer may update.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
# The beginnings of query parameters that name no other page.
TRACKING = ("utm_", "sessionid", "phpsessid", "jsessionid")

RECORD = "record_id string, kind string, url string, time long, headers map<string,string>, digest string, length long"


def canonical(url: str) -> str:
    """SQL for the canonical form of a URL column.

    Scheme, user, www prefix, default port and fragment go, the host is in lower
    case, an empty path is /, parameters are sorted and those of tracking go. Null stays null.
    """
    rest = f"regexp_replace(regexp_replace(trim({url}), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '')"
    host = f"regexp_replace(regexp_replace(lower(regexp_extract({rest}, '^[^/?]*', 0)), '^.*@|:(80|443)?$', ''), '^www[.]', '')"
    path = f"regexp_extract({rest}, '^[^/?]*([^?]*)', 1)"
    query = f"regexp_extract({rest}, '[?](.*)$', 1)"
    kept = (f"array_sort(filter(split({query}, '&'), p -> p <> '' AND NOT lower(p) RLIKE "
            f"'^({'|'.join(TRACKING)})'))")
    return (f"concat({host}, CASE WHEN {path} = '' THEN '/' ELSE {path} END, "
            f"CASE WHEN size({kept}) > 0 THEN concat('?', array_join({kept}, '&')) ELSE '' END)")


def resolved(records: DataFrame, slice_seconds: int = SLICE) -> DataFrame:
    """One row per revisit: record_id, canonical_url, time, outcome, refers_to, digest, length, headers.

    ``records`` has the columns of RECORD; kind is response or revisit, others are
    not looked at. A revisit refers to the latest response of its canonical URL with
    an earlier time (of equal times the largest record_id). Its validators are then checked, the
    first that both have: entity tag (weak comparison), last-modified, payload digest. outcome is resolved,
    mismatch, unverified (no common validator) or orphan (no earlier response; refers_to is null). A
    resolved revisit has the digest and length of the response and its headers with the
    permitted fields of the revisit laid over; names in lower case.

    Null headers are none, null URLs and times make orphans; responses of one
    record_id count once; repeated revisits are rows of their own; other columns
    are not looked at; empty tables give no rows.

    The as-of join works on distinct (URL, second) pairs, cut into slices of time:
    inside a slice a window looks back, over slices the last response of each is
    carried on. So a URL with a third of all records is spread over its slices.
    """
    spark = records.sparkSession
    lowered = ("map_from_entries(array_sort(map_entries(map_from_arrays(array_distinct(transform(map_keys(headers), "
               "k -> lower(k))), transform(array_distinct(transform(map_keys(headers), k -> lower(k))), "
               "n -> element_at(map_values(map_filter(headers, (k, v) -> lower(k) = n)), 1))))))")
    named = derive(records.select("record_id", "kind", "url", "time", "headers", "digest", "length"), {
        "key": canonical("url"), "headers": f"coalesce({lowered}, map())"}).drop("url")
    named = written_table(spark, named.where("kind IN ('response', 'revisit')"), "records")
    full = named.where("kind = 'response' AND key IS NOT NULL AND time IS NOT NULL AND record_id IS NOT NULL")
    asked = named.where("kind = 'revisit'")
    offered = full.groupBy("key", "time").agg(F.max("record_id").alias("ref"))
    wanted = asked.where("key IS NOT NULL AND time IS NOT NULL").select("key", "time").distinct()
    moments = offered.selectExpr("key", "time", "ref", "1 AS later").unionByName(
        wanted.selectExpr("key", "time", "CAST(NULL AS STRING) AS ref", "0 AS later")).selectExpr(
        "*", f"floor(time / {slice_seconds}) AS slice")
    moments = written_table(spark, moments, "moments")
    near = moments.withColumn("near", F.expr(
        "last(ref, true) OVER (PARTITION BY key, slice ORDER BY time, later ROWS UNBOUNDED PRECEDING)")).where("later = 0")
    carried = moments.groupBy("key", "slice").agg(F.expr("max_by(ref, CASE WHEN ref IS NOT NULL THEN time END)").alias(
        "last_ref")).selectExpr(
        "key", "slice", "last(last_ref, true) OVER (PARTITION BY key ORDER BY slice "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before")
    answers = near.join(carried, ["key", "slice"], "left").selectExpr("key", "time", "coalesce(near, before) AS ref").where(
        "ref IS NOT NULL")
    stored = full.selectExpr("record_id AS ref", "struct(digest, length, headers) AS r").groupBy("ref").agg(
        F.expr("min_by(r, struct(r.digest, r.length))").alias("stored"))
    answered = answers.join(stored, "ref")
    met = asked.join(answered, ["key", "time"], "left")

    def field(of, name):
        return f"element_at({of}, '{name}')"

    def tag(of):
        return f"regexp_replace({field(of, 'etag')}, '^W/', '')"

    same = (f"CASE WHEN {tag('headers')} IS NOT NULL AND {tag('stored.headers')} IS NOT NULL "
            f"THEN {tag('headers')} = {tag('stored.headers')} "
            f"WHEN {field('headers', 'last-modified')} IS NOT NULL AND {field('stored.headers', 'last-modified')} IS NOT NULL "
            f"THEN {field('headers', 'last-modified')} = {field('stored.headers', 'last-modified')} "
            "ELSE digest = stored.digest END")
    judged = met.withColumn("outcome", F.expr(
        f"CASE WHEN ref IS NULL THEN 'orphan' WHEN ({same}) IS NULL THEN 'unverified' WHEN {same} THEN 'resolved' "
        "ELSE 'mismatch' END"))
    allowed = "map_filter(headers, (k, v) -> k IN ({}))".format(", ".join(f"'{p}'" for p in PERMITTED))
    return judged.selectExpr(
        "record_id", "key AS canonical_url", "time", "outcome", "ref AS refers_to",
        "CASE WHEN outcome = 'resolved' THEN stored.digest END AS digest",
        "CASE WHEN outcome = 'resolved' THEN stored.length END AS length",
        f"CASE WHEN outcome = 'resolved' THEN map_concat(map_filter(stored.headers, (k, v) -> NOT coalesce("
        f"map_contains_key({allowed}, k), false)), {allowed}) END AS headers")


def records_of(pages: DataFrame) -> DataFrame:
    """Archive records made from pages (page_id, url, html): a response each, and revisits of several kinds.

    A page is answered in full at second 97 * page_id. Fifty seconds later it is
    asked for under another spelling of its URL, a day later once more, then for some pages with
    another entity tag, without one or without any validator; some are asked for before they were answered.
    """
    seen = pages.selectExpr(
        "page_id", "url", "1700000000 + 97 * page_id AS at", "sha1(coalesce(html, '')) AS payload",
        "CAST(length(coalesce(html, '')) AS BIGINT) AS size")
    tag, modified = "concat('\"', substring(payload, 1, 16), '\"')", "concat('day ', CAST(page_id % 1000 AS STRING))"
    none = "CAST(NULL AS STRING)"

    def record(name, kind, url, time, headers, digest="payload"):
        return (f"struct(concat('{name}-', CAST(page_id AS STRING)) AS record_id, '{kind}' AS kind, {url} AS url, {time} AS time, "
                f"map_filter({headers}, (k, v) -> v IS NOT NULL) AS headers, {digest} AS digest, size AS length)")

    answers = ", ".join([
        record("full", "response", "url", "at", f"map('ETag', {tag}, 'Last-Modified', {modified}, 'Content-Type', "
               "'text/html', 'Cache-Control', 'max-age=60', 'Date', concat('at ', CAST(at AS STRING)))"),
        record("soon", "revisit", "concat(regexp_replace(url, '^http:', 'HTTPS:'), '#again')", "at + 50",
               f"map('etag', concat('W/', {tag}), 'Date', concat('at ', CAST(at + 50 AS STRING)), 'Set-Cookie', 'c=1')"),
        record("later", "revisit", "url", "at + 86400",
               f"map('ETag', CASE WHEN page_id % 5 = 0 THEN '\"changed\"' WHEN page_id % 5 < 3 THEN {none} ELSE {tag} END, "
               f"'Last-Modified', CASE WHEN page_id % 5 = 1 THEN {modified} END, 'Cache-Control', 'max-age=600', "
               "'Content-Length', '0')", f"CASE WHEN page_id % 7 = 2 THEN {none} ELSE payload END"),
        record("early", "revisit", "url", "at - 10", f"map('ETag', {tag}, 'Date', CAST(NULL AS STRING))"),
    ])
    return seen.select(F.explode(F.expr(f"array({answers})")).alias("r")).select("r.*")


def shown(found: DataFrame) -> DataFrame:
    """The result with headers as text: sorted name=value lines."""
    return found.withColumn("headers", F.expr(
        "array_join(array_sort(transform(map_entries(headers), e -> concat(e.key, '=', e.value))), '\n')"))


ORACLE = r"""
WITH p AS (SELECT page_id, url, 1700000000 + 97 * page_id AS seen, sha1(coalesce(html, '')) AS payload,
                  length(coalesce(html, ''))::BIGINT AS size FROM pages),
cut AS (SELECT *, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS rest FROM p),
bits AS (SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(rest, '^[^/?]*')), '^.*@|:(80|443)?$', '', 'g'), '^www[.]', '') AS host,
                regexp_extract(rest, '^[^/?]*([^?]*)', 1) AS path,
                list_sort(list_filter(string_split(regexp_extract(rest, '[?](.*)$', 1), '&'),
                    lambda x: x <> '' AND NOT regexp_matches(lower(x), '^(utm_|sessionid|phpsessid|jsessionid)'))) AS q FROM cut),
k AS (SELECT *, host || CASE WHEN path = '' THEN '/' ELSE path END
                || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END AS key,
             '"' || substr(payload, 1, 16) || '"' AS tag, 'day ' || (page_id % 1000) AS modified FROM bits),
f AS (SELECT key, seen AS rtime, max('full-' || page_id) AS ref FROM k GROUP BY key, seen),
full_rows AS (SELECT 'full-' || page_id AS ref, payload AS rdigest, size AS rlength, tag AS rtag, modified AS rmod, seen AS rat FROM k),
v AS (SELECT 'soon-' || page_id AS record_id, key, seen + 50 AS time, tag AS etag, 'W/' || tag AS shown_tag, NULL AS mod, payload AS digest,
             'at ' || (seen + 50) AS date, NULL AS cache FROM k
      UNION ALL SELECT 'later-' || page_id, key, seen + 86400,
             CASE WHEN page_id % 5 = 0 THEN '"changed"' WHEN page_id % 5 < 3 THEN NULL ELSE tag END,
             CASE WHEN page_id % 5 = 0 THEN '"changed"' WHEN page_id % 5 < 3 THEN NULL ELSE tag END,
             CASE WHEN page_id % 5 = 1 THEN modified END, CASE WHEN page_id % 7 = 2 THEN NULL ELSE payload END, NULL, 'max-age=600' FROM k
      UNION ALL SELECT 'early-' || page_id, key, seen - 10, tag, tag, NULL, payload, NULL, NULL FROM k),
j AS (SELECT v.*, f.ref FROM v ASOF LEFT JOIN f ON v.key = f.key AND v.time > f.rtime),
o AS (SELECT j.*, rdigest, rlength, rtag, rmod, rat,
             CASE WHEN j.ref IS NULL THEN 'orphan'
                  WHEN (CASE WHEN etag IS NOT NULL THEN etag = rtag WHEN mod IS NOT NULL THEN mod = rmod ELSE digest = rdigest END) IS NULL
                      THEN 'unverified'
                  WHEN (CASE WHEN etag IS NOT NULL THEN etag = rtag WHEN mod IS NOT NULL THEN mod = rmod ELSE digest = rdigest END)
                      THEN 'resolved' ELSE 'mismatch' END AS outcome
      FROM j LEFT JOIN full_rows USING (ref))
SELECT record_id, key AS canonical_url, time, outcome, ref AS refers_to,
       CASE WHEN outcome = 'resolved' THEN rdigest END AS digest, CASE WHEN outcome = 'resolved' THEN rlength END AS length,
       CASE WHEN outcome = 'resolved' THEN 'cache-control=' || coalesce(cache, 'max-age=60') || chr(10) || 'content-type=text/html'
            || chr(10) || 'date=' || coalesce(date, 'at ' || rat) || chr(10) || 'etag=' || coalesce(shown_tag, rtag)
            || chr(10) || 'last-modified=' || rmod END AS headers
FROM o
"""
