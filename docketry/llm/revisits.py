"""Resolution of WARC revisit records that say "not modified".

A revisit (status 304) stands for the latest earlier full response of the same canonical URL. The
as-of join is made of windows: within a slice of time of a URL, and over one row for each slice, so a
URL that holds a large share of all captures is spread over its slices. Only ids and validators go
through the windows; stored headers are joined afterwards by id.

The 304's entity tag must equal the stored one (weak comparison); without an entity tag on both sides
the Last-Modified dates must. Headers of the 304 then replace stored ones of the same name, but for
those that describe the stored body or the connection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SLICE_SECONDS = 3_600

# Parameters that only track, and header fields that a 304 must not replace.
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=|$)"
KEPT_FIELDS = (
    "connection", "content-encoding", "content-length", "content-md5", "content-range", "content-type",
    "keep-alive", "proxy-authenticate", "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade",
)


def canonical_url(url: Column) -> Column:
    """A URL without scheme, www., default port, fragment, tracking parameters and trailing slash.

    The host is in lower case and parameters are sorted. Null for a null or blank URL.
    """
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), r"#.*$", ""), r"(?i)^[a-z][a-z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, r"^([^/?]*)", 1)), r"^www\.|:(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(bare, r"\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.when(F.trim(url) != "", F.concat(host, path, F.lit(""), tail))


def header_fields(headers: Column) -> Column:
    """A block of header lines as an array of (name, value), names in lower case."""
    lines = F.filter(F.split(F.coalesce(headers, F.lit("")), r"\r?\n"), lambda x: x.rlike(r"^[^:\s]+\s*:"))
    return F.transform(
        lines,
        lambda x: F.struct(
            F.lower(F.trim(F.substring_index(x, ":", 1))).alias("name"),
            F.trim(F.regexp_replace(x, r"^[^:]*:", "")).alias("value"),
        ),
    )


def field_value(headers: Column, name: str) -> Column:
    """The first value of a field; null if it is missing or empty."""
    return F.nullif(F.regexp_extract(headers, rf"(?im)^{name}[ \t]*:[ \t]*([^\r\n]*?)[ \t]*\r?$", 1), F.lit(""))


def merged_headers(stored: Column, update: Column) -> Column:
    """Header lines of a stored response refreshed by a 304, sorted by name and value."""
    fresh = F.filter(header_fields(update), lambda f: ~f["name"].isin(*KEPT_FIELDS))
    names = F.transform(fresh, lambda f: f["name"])
    left = F.filter(header_fields(stored), lambda f: ~F.array_contains(names, f["name"]))
    lines = F.transform(F.concat(left, fresh), lambda f: F.concat(f["name"], F.lit(": "), f["value"]))
    return F.array_join(F.array_sort(lines), "\n")


def resolve_revisits(records: DataFrame, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """record_id, url, outcome, refers_to, headers for every revisit record.

    ``records``: record_id, warc_type, target_uri, warc_date (timestamp), status, headers; other
    columns are not read. A full response has type ``response`` and status 200. Earlier means a smaller
    date; of responses of one date the greatest record_id counts. Outcomes: ``resolved``, ``changed``
    (validators differ), ``unvalidated`` (no validator to compare; resolved, but marked), ``orphan``
    (no earlier response), ``not_304``, ``incomplete`` (URL or date is null). Only the first and third
    have refers_to and merged headers. Repeated rows of one record_id count once.
    """
    rows = records.select(
        F.col("record_id").cast("bigint").alias("record_id"), canonical_url(F.col("target_uri")).alias("url"),
        F.unix_micros(F.col("warc_date").cast("timestamp")).alias("at"), F.col("status").cast("int").alias("status"),
        F.lower("warc_type").alias("kind"), "headers",
    ).where("record_id is not null and kind in ('response', 'revisit')")
    full = (F.col("kind") == "response") & (F.col("status") == 200)
    etag = F.regexp_replace(field_value(F.col("headers"), "etag"), r"^W/", "")
    narrow = rows.where("url is not null and at is not null").where(full | (F.col("kind") == "revisit")).select(
        "url", "at", "record_id", F.floor(F.col("at") / (slice_seconds * 1_000_000)).alias("slice"), full.alias("full"),
        "status", etag.alias("etag"), field_value(F.col("headers"), "last-modified").alias("modified"),
    )
    response = F.when(F.col("full"), F.struct("at", "record_id", "etag", "modified"))
    # The last response of each slice, and of all slices before it.
    ends = narrow.groupBy("url", "slice").agg(F.max(response).alias("end"))
    before = W.partitionBy("url").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    carried = ends.select("url", "slice", F.last("end", ignorenulls=True).over(before).alias("carried"))
    # Revisits come first among equal dates, so that a response of that date is not earlier.
    inside = W.partitionBy("url", "slice").orderBy("at", "full", "record_id").rowsBetween(W.unboundedPreceding, 0)
    found = (
        narrow.withColumn("last", F.last(response, ignorenulls=True).over(inside)).where(~F.col("full"))
        .join(carried, ["url", "slice"]).withColumn("stored", F.coalesce("last", "carried"))
    )
    outcome = (
        F.when(~F.col("status").eqNullSafe(304), "not_304")
        .when(F.col("stored").isNull(), "orphan")
        .when(F.col("etag").isNotNull() & F.col("stored.etag").isNotNull(), F.when(F.col("etag") == F.col("stored.etag"), "resolved").otherwise("changed"))
        .when(F.col("modified").isNotNull() & F.col("stored.modified").isNotNull(), F.when(F.col("modified") == F.col("stored.modified"), "resolved").otherwise("changed"))
        .otherwise("unvalidated")
    )
    judged = found.select("record_id", "url", outcome.alias("outcome"), "stored.record_id").toDF("record_id", "url", "outcome", "stored_id")
    ok = F.col("outcome").isin("resolved", "unvalidated")
    judged = judged.select("record_id", "url", "outcome", F.when(ok, F.col("stored_id")).alias("refers_to"))
    judged = judged.groupBy("record_id").agg(F.max(F.struct("url", "outcome", "refers_to")).alias("row")).select("record_id", "row.*")
    texts = rows.groupBy("record_id").agg(F.max("headers").alias("headers"))
    # Each linked revisit's own headers, then those of what it refers to.
    linked = judged.where("refers_to is not null").join(texts, "record_id").withColumnRenamed("headers", "update")
    stored = texts.select(F.col("record_id").alias("refers_to"), F.col("headers").alias("stored"))
    linked = linked.join(stored, "refers_to").select(
        "record_id", "url", "outcome", "refers_to", merged_headers(F.col("stored"), F.col("update")).alias("headers")
    )
    nothing = F.lit(None)
    rest = judged.where("refers_to is null").withColumn("headers", nothing.cast("string"))
    broken = rows.where("kind = 'revisit' and (url is null or at is null)").select(
        "record_id", "url", F.lit("incomplete").alias("outcome"), nothing.cast("bigint").alias("refers_to"), nothing.cast("string").alias("headers")
    ).dropDuplicates(["record_id"])
    return linked.unionByName(rest).unionByName(broken)


# Captures of the given pages, in SQL that Spark and DuckDB both read: a response, a revisit under
# another spelling of the URL, one that knows the date alone, and a second response or an early revisit.
CAPTURES = """
SELECT page_id * 4 + k AS record_id,
    CASE WHEN k = 0 OR k = 3 AND page_id % 11 <> 0 THEN 'response' ELSE 'revisit' END AS warc_type,
    CASE k WHEN 1 THEN concat(replace(url, 'http://', 'https://'), CASE WHEN url LIKE '%#%' THEN '' ELSE '#more' END)
        WHEN 2 THEN replace(url, '://www.', '://WWW.') ELSE url END AS target_uri,
    1704067200 + (page_id * 977) % 7000000 + CASE k WHEN 3 THEN CASE WHEN page_id % 11 = 0 THEN -5 ELSE 90000 END ELSE k * 40000 END AS seconds,
    CASE WHEN k = 0 OR k = 3 AND page_id % 11 <> 0 THEN 200 WHEN k = 2 AND page_id % 13 = 0 THEN 200 ELSE 304 END AS status,
    CASE WHEN k = 0 THEN concat('Content-Type: text/html', chr(10), 'ETag: "', digest, '"', chr(10), 'Last-Modified: day ',
            CAST(page_id % 300 AS string), chr(10), 'Content-Length: ', CAST(size AS string), chr(10), 'Cache-Control: max-age=60')
        WHEN k = 1 THEN concat('ETag: W/"', CASE WHEN page_id % 7 = 0 THEN 'other' ELSE digest END, '"', chr(10),
            'Cache-Control: max-age=600', chr(10), 'Content-Length: 0', chr(10), 'Connection: close', chr(10), 'X-Seen: again')
        WHEN k = 2 THEN concat('last-modified:  day ', CAST(page_id % 300 + CASE WHEN page_id % 5 = 0 THEN 1 ELSE 0 END AS string), chr(10), 'Date: now')
        ELSE concat('Date: then', chr(10), 'Last-Modified: never') END AS headers
FROM hashed LATERAL VIEW explode(array(0, 1, 2, 3)) kinds AS k"""
