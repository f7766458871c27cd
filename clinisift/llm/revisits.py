"""Web archive records: revisits that say "not modified", resolved to the response they stand for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fields of a 304 response that replace those of the stored response; all others stay as stored.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
#: Query parameters that only track visitors.
TRACKING = "^(utm_[a-z]+|fbclid|gclid|ref|sessionid|sid)="
#: Length of the slices of time into which the captures of one URL are cut.
SLICE_SECONDS = 3600


def canonical_url(url: Column) -> Column:
    """Host and path of ``url`` in lower case without scheme, www, default port, fragment, last
    slash and tracking parameters; the other parameters are sorted. Null for null."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), "(?i)^[a-z][a-z0-9+.-]*://", "")
    whole = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(bare, "^([^?]*)", 1)), "^www[0-9]*\\.", ""), "^([^/:]*):(80|443)(/|$)", "$1$3")
    query = F.regexp_extract(bare, "^[^?]*\\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.lower(p).rlike(TRACKING)))
    path = F.regexp_replace(whole, "/+$", "")
    return F.when(F.size(kept) > 0, F.concat(path, F.lit("?"), F.array_join(kept, "&"))).otherwise(path)


def lower_names(headers: Column) -> Column:
    """Header map with names in lower case; of names that differ in case only, the last one counts."""
    entries = F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>")))
    return F.aggregate(
        entries, F.create_map().cast("map<string,string>"),
        lambda m, e: F.map_concat(F.map_filter(m, lambda k, _: k != F.lower(e["key"])), F.create_map(F.lower(e["key"]), e["value"])))


def same_tag(a: Column, b: Column) -> Column:
    """Weak comparison of entity tags."""
    bare = lambda c: F.regexp_replace(F.trim(c), "^W/", "")
    return bare(a) == bare(b)


def resolve_revisits(records: DataFrame, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """One row per revisit of ``records`` (record_id, kind, url, date, status, headers, digest):
    record_id, canonical_url, date, resolved_id, outcome, headers, digest.

    An as-of join finds the latest earlier full response (kind "response", status 200) with
    the same canonical URL. Validators decide: entity tags if both have one (compared weakly),
    else last-modified dates if both have one. outcome is "resolved" if they agree, "mismatch"
    if not, "unverified" if there is nothing to compare, "no response" if there is no earlier
    one. A resolved revisit has the headers of the response with the permitted ones of its own
    put over them, and the digest of the response's payload; others keep their own.

    Captures of a URL are cut into slices of time. Each slice hands its last response on through
    a table of one row per URL and slice; then every slice is joined by itself, so a URL with
    a third of all captures is worked on by as many tasks as it has slices.

    Defined cases: a revisit without URL or date has no response; responses of the same moment
    are not earlier; of several at one moment the largest record_id counts; null headers are
    empty; header names ignore case; repeated rows stay; an empty table gives no rows; further
    columns are ignored.
    """
    rows = records.select(
        "record_id", "kind", F.col("date").cast("timestamp").alias("date"), "status", lower_names(F.col("headers")).alias("headers"), "digest",
        canonical_url(F.col("url")).alias("canonical_url"))
    rows = rows.filter("kind = 'revisit' OR (kind = 'response' AND status = 200)").withColumn("at", F.unix_micros("date"))
    known = rows.filter("canonical_url IS NOT NULL AND at IS NOT NULL").withColumn("slice", F.floor(F.col("at") / (slice_seconds * 1_000_000)))
    response = F.struct("record_id", "headers", "digest")
    mine = F.when(F.col("kind") == "response", response)
    order = F.when(F.col("kind") == "response", F.struct("at", "record_id"))

    by_slice = known.filter("kind = 'response'").groupBy("canonical_url", "slice").agg(F.max_by(response, F.struct("at", "record_id")).alias("last"))
    needed = known.select("canonical_url", "slice").distinct()
    before = Window.partitionBy("canonical_url").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = needed.join(by_slice, ["canonical_url", "slice"], "left").select(
        "canonical_url", "slice", F.last("last", ignorenulls=True).over(before).alias("carried"))

    earlier = Window.partitionBy("canonical_url", "slice").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    inside = known.withColumn("inside", F.max_by(mine, order).over(earlier)).filter("kind = 'revisit'")
    found = inside.join(carried, ["canonical_url", "slice"]).withColumn("found", F.coalesce("inside", "carried"))
    lost = rows.filter("kind = 'revisit' AND (canonical_url IS NULL OR at IS NULL)").withColumn("found", F.lit(None).cast(found.schema["found"].dataType))
    cols = ["record_id", "canonical_url", "date", "headers", "digest", "found"]
    both = found.select(*cols).unionByName(lost.select(*cols))

    own, theirs = (lambda k: F.col("headers")[k]), (lambda k: F.col("found.headers")[k])
    tags = own("etag").isNotNull() & theirs("etag").isNotNull()
    times = own("last-modified").isNotNull() & theirs("last-modified").isNotNull()
    outcome = (
        F.when(F.col("found").isNull(), "no response")
        .when(tags, F.when(same_tag(own("etag"), theirs("etag")), "resolved").otherwise("mismatch"))
        .when(times, F.when(F.trim(own("last-modified")) == F.trim(theirs("last-modified")), "resolved").otherwise("mismatch"))
        .otherwise("unverified"))
    both = both.withColumn("outcome", outcome).withColumn("fresh", F.map_filter("headers", lambda k, _: k.isin(*PERMITTED)))
    merged = F.map_concat(F.map_filter("found.headers", lambda k, _: ~F.map_contains_key("fresh", k)), "fresh")
    good = F.col("outcome") == "resolved"
    return both.select(
        "record_id", "canonical_url", "date", F.when(good, F.col("found.record_id")).alias("resolved_id"), "outcome",
        F.when(good, merged).otherwise(F.col("headers")).alias("headers"), F.when(good, F.col("found.digest")).otherwise(F.col("digest")).alias("digest"))


def captures_of_pages(pages: DataFrame, rounds: int = 6) -> DataFrame:
    """Archive records as a crawler that asks for every page ``rounds`` times would leave them.

    Visit k of a page is a full response if k = 0 (but for every 17th page) or if the page
    has changed since, else a revisit with the entity tag or the date it was sent. Some
    revisits carry a weak tag, some a foreign one, some none; schemes and fragments vary.
    """
    p, k = F.col("page_id"), F.col("k")
    version = F.when(k >= (p % 5) + 1, 1).otherwise(0)
    full = ((k == 0) & (p % 17 != 3)) | (k == (p % 5) + 1)
    tag = F.concat(F.lit('"'), F.substring(F.md5(F.coalesce("html", F.lit("")).cast("binary")), 1, 12), F.lit("-"), version, F.lit('"'))
    odd = (p + 3 * k) % 13
    shown = F.when(~full & (odd == 4), F.lit('"other"')).when(~full & (odd == 6), F.concat(F.lit("W/"), tag)).otherwise(tag)
    day = F.date_format(F.timestamp_seconds(F.lit(1_700_000_000) + version * 864_000), "yyyy-MM-dd")
    shown = F.when(~full & (odd.isin(8, 9)), F.lit(None)).otherwise(shown)
    since = F.when(~full & (odd == 9), F.lit(None)).otherwise(day)
    url = F.regexp_replace("url", "^https?://", F.when(k % 2 == 0, "https://www.").otherwise("http://"))
    rows = pages.select("page_id", "url", "html").withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))))
    date = F.timestamp_seconds(F.lit(1_704_067_200) + k * 259_200 + (p % 7200))
    headers = F.map_from_entries(F.filter(F.array(
        F.struct(F.lit("ETag"), shown), F.struct(F.lit("Last-Modified"), since),
        F.struct(F.lit("Date"), F.date_format(date, "yyyy-MM-dd HH:mm:ss")),
        F.struct(F.lit("Cache-Control"), F.concat(F.lit("max-age="), (k * 60).cast("string"))),
        F.struct(F.lit("Content-Type"), F.when(full, "text/html").otherwise("text/plain")),
        F.struct(F.lit("Content-Length"), F.when(full, F.length(F.coalesce("html", F.lit(""))).cast("string")).otherwise("0"))),
        lambda e: e["col2"].isNotNull()))
    return rows.select(
        (p * rounds + k).alias("record_id"), F.when(full, "response").otherwise("revisit").alias("kind"), url.alias("url"), date.alias("date"),
        F.when(full, 200).otherwise(304).alias("status"), headers.alias("headers"), F.when(full, F.md5(F.concat(F.coalesce("html", F.lit("")), version.cast("string")).cast("binary"))).alias("digest"))


SQL = r"""
WITH c AS (
  SELECT p.page_id, k, html, url, CASE WHEN k >= page_id % 5 + 1 THEN 1 ELSE 0 END AS version,
         (k = 0 AND page_id % 17 <> 3) OR k = page_id % 5 + 1 AS is_full, (page_id + 3 * k) % 13 AS odd
  FROM pages p, range(0, 6) r(k)
), r AS (
  SELECT CAST(page_id * 6 + k AS BIGINT) AS record_id, is_full, TIMESTAMP '2024-01-01' + to_seconds(k * 259200 + page_id % 7200) AS date,
         regexp_replace(url, '^https?://', CASE WHEN k % 2 = 0 THEN 'https://www.' ELSE 'http://' END) AS url,
         CASE WHEN NOT is_full AND odd IN (8, 9) THEN NULL WHEN NOT is_full AND odd = 4 THEN '"other"'
              ELSE CASE WHEN NOT is_full AND odd = 6 THEN 'W/' ELSE '' END || '"' || substr(md5(coalesce(html, '')), 1, 12) || '-' || version || '"' END AS etag,
         CASE WHEN NOT is_full AND odd = 9 THEN NULL ELSE strftime(TIMESTAMP '2023-11-14 22:13:20' + to_seconds(version * 864000), '%Y-%m-%d') END AS modified,
         'max-age=' || (k * 60) AS cache, CASE WHEN is_full THEN length(coalesce(html, '')) ELSE 0 END AS size,
         CASE WHEN is_full THEN 'text/html' ELSE 'text/plain' END AS type, CASE WHEN is_full THEN md5(coalesce(html, '') || version) END AS digest
  FROM c
), b AS (
  SELECT *, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[a-zA-Z][a-zA-Z0-9+.-]*://', '') AS bare FROM r
), u AS (
  SELECT *, regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(bare, '^([^?]*)', 1)), '^www[0-9]*\.', ''),
                           '^([^/:]*):(80|443)(/|$)', '\1\3'), '/+$', '') AS path,
         list_sort(list_filter(string_split(regexp_extract(bare, '^[^?]*\?(.*)$', 1), '&'),
                   lambda q: q <> '' AND NOT regexp_matches(lower(q), '^(utm_[a-z]+|fbclid|gclid|ref|sessionid|sid)='))) AS params
  FROM b
), n AS (
  SELECT *, CASE WHEN len(params) > 0 THEN path || '?' || array_to_string(params, '&') ELSE path END AS canonical_url FROM u
), j AS (
  SELECT v.*, f.record_id AS f_id, f.etag AS f_etag, f.modified AS f_modified, f.size AS f_size, f.type AS f_type, f.digest AS f_digest
  FROM (SELECT * FROM n WHERE NOT is_full) v
  ASOF LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY canonical_url, date ORDER BY record_id DESC) AS rn FROM n WHERE is_full) WHERE rn = 1) f
  ON v.canonical_url = f.canonical_url AND v.date > f.date
), o AS (
  SELECT *, CASE WHEN f_id IS NULL THEN 'no response'
    WHEN etag IS NOT NULL AND f_etag IS NOT NULL THEN CASE WHEN regexp_replace(etag, '^W/', '') = regexp_replace(f_etag, '^W/', '') THEN 'resolved' ELSE 'mismatch' END
    WHEN modified IS NOT NULL AND f_modified IS NOT NULL THEN CASE WHEN modified = f_modified THEN 'resolved' ELSE 'mismatch' END
    ELSE 'unverified' END AS outcome FROM j
)
SELECT record_id, canonical_url, CASE WHEN outcome = 'resolved' THEN f_id END AS resolved_id, outcome,
       'cache-control: ' || cache || '|content-length: ' || CASE WHEN outcome = 'resolved' THEN f_size ELSE size END
       || '|content-type: ' || CASE WHEN outcome = 'resolved' THEN f_type ELSE type END || '|date: ' || strftime(date, '%Y-%m-%d %H:%M:%S')
       || coalesce('|etag: ' || CASE WHEN outcome = 'resolved' THEN coalesce(etag, f_etag) ELSE etag END, '')
       || coalesce('|last-modified: ' || CASE WHEN outcome = 'resolved' THEN coalesce(modified, f_modified) ELSE modified END, '') AS headers,
       CASE WHEN outcome = 'resolved' THEN f_digest ELSE digest END AS digest
FROM o
"""
