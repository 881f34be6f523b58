"""Not-modified revisits of web archives (operator 6).

A revisit record says that a page had not changed; it is resolved by an as-of join on the canonical
URL to the latest earlier full response, whose validators must agree, and gets that
response's payload and headers, with those headers of its own that a 304 may update.

The as-of join is made of windows over distinct (URL, time) points: ranges of time
split a hot URL, the last response of each range is carried to the later ranges, and records
of one point share its answer. Payloads take no part in it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import materialise

#: Query parameters that name a visit, not a page.
TRACKING = "utm_[a-z]+|ref|gclid|fbclid|sessionid|jsessionid|phpsessid"
#: Header fields that a not-modified response may update; of others the stored ones stay.
PERMITTED = ("age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "server", "vary", "via", "warning")
#: Points of a time range, about, and ranges at most.
RANGE_POINTS, MOST_RANGES = 50_000, 1_000


def canonical_url(url: str = "url") -> F.Column:
    """host[:port]/path[?query]: scheme, user, www, default port, fragment, final slashes and tracking parameters go, host is lower-cased, parameters are sorted."""
    c = F.regexp_replace(F.trim(F.col(url)), "#.*$", "")
    c = F.regexp_replace(c, "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(c, "^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(host, "^.*@", ""), "^www[0-9]*\\.", ""), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(c, "^[^/?]*([^?]*)", 1), "/+$", "")
    query = F.regexp_extract(c, "\\?(.*)$", 1)
    parts = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(f"(?i)^({TRACKING})(=|$)")))
    return F.concat(host, path, F.when(F.size(parts) > 0, F.concat(F.lit("?"), F.array_join(parts, "&"))).otherwise(""))


def latest_earlier(records: DataFrame) -> DataFrame:
    """(u, at, response_id) for the points (u, at) of revisits with an earlier response; records: u, at, record_id, full."""
    points = records.groupBy("u", "at").agg(F.max(F.when(F.col("full"), F.col("record_id"))).alias("response_id"), F.max(~F.col("full")).alias("asks"))
    points = materialise(points)
    n = points.count()
    cuts = max(1, min(MOST_RANGES, n // RANGE_POINTS))
    marks = points.agg(F.percentile_approx("at", [i / cuts for i in range(1, cuts)], 10_000)).first()[0] if cuts > 1 else []
    marks = sorted(set(marks or []))
    slot = F.size(F.filter(F.array(*[F.lit(m) for m in marks]).cast(f"array<{points.schema['at'].dataType.simpleString()}>"), lambda m: m <= F.col("at"))) if marks else F.lit(0)
    points = points.withColumn("range", slot)
    inside = W.partitionBy("u", "range").orderBy("at").rowsBetween(W.unboundedPreceding, -1)
    near = points.withColumn("found", F.last("response_id", ignorenulls=True).over(inside))
    ends = points.where("response_id is not null").groupBy("u", "range").agg(F.max_by("response_id", "at").alias("last"))
    ranges = points.select("u", "range").distinct().join(ends, ["u", "range"], "left")
    carried = ranges.withColumn("carried", F.last("last", ignorenulls=True).over(W.partitionBy("u").orderBy("range").rowsBetween(W.unboundedPreceding, -1)))
    out = near.where("asks").join(carried.select("u", "range", "carried"), ["u", "range"])
    return out.select("u", "at", F.coalesce("found", "carried").alias("response_id")).where("response_id is not null")


def resolve(records: DataFrame, payload: bool = False) -> DataFrame:
    """Resolve the revisits among records.

    records: record_id, record_type ('response' or 'revisit'), url, captured_at (any ordered type), etag,
    last_modified, headers (map), payload. Returns a row per record: record_id, canonical_url, state, response_id,
    headers, payload_bytes, payload_crc32, and with payload the payload.

    state is 'response' for full responses, and for revisits 'resolved', 'validator_mismatch' (the latest earlier
    response has another entity tag, or, where the revisit names none, another time of modification; nothing is merged)
    or 'no_earlier_response', also where url or captured_at is null. A revisit without validators accepts any.
    Weak tags compare without W/. Of responses at one time the largest record_id counts. Null payloads have null
    digests; null headers are empty. Repeated rows repeat; record_id should be unique. Other columns are ignored.
    """
    empty = F.expr("cast(map() as map<string, string>)")
    lower = F.transform_keys(F.coalesce("headers", empty), lambda k, _: F.lower(k))
    tag = lambda c: F.regexp_replace(F.trim(F.col(c)), "^W/", "")
    body = F.col("payload").cast("binary")
    rows = records.select(
        "record_id", (F.col("record_type") == "response").alias("full"), canonical_url().alias("u"), F.col("captured_at").alias("at"), tag("etag").alias("etag"), F.trim("last_modified").alias("modified"), lower.alias("headers"),
        F.octet_length(body).cast("long").alias("payload_bytes"), F.crc32(body).alias("payload_crc32"),
    )
    rows = materialise(rows.withColumn("full", F.coalesce("full", F.lit(False))))
    known = rows.where("u is not null and at is not null")
    at = latest_earlier(known.select("u", "at", "record_id", "full"))
    asks = materialise(rows.where("not full and u is not null and at is not null").join(at, ["u", "at"], "left").unionByName(rows.where("not full and (u is null or at is null)").withColumn("response_id", F.lit(None).cast(rows.schema["record_id"].dataType))))
    full = rows.where("full").select(F.col("record_id").alias("response_id"), F.col("etag").alias("e2"), F.col("modified").alias("m2"), F.col("headers").alias("h2"), F.col("payload_bytes").alias("b2"), F.col("payload_crc32").alias("c2"))
    full = full.dropDuplicates(["response_id"])
    # revisits without a response stay out of the join, where they would meet in one task
    none = [F.lit(None).cast(full.schema[c].dataType).alias(c) for c in full.columns if c != "response_id"]
    met = asks.where("response_id is not null").join(full, "response_id", "left").unionByName(asks.where("response_id is null").select("*", *none))
    agrees = F.when(F.col("etag").isNotNull(), F.col("etag").eqNullSafe(F.col("e2"))).when(F.col("modified").isNotNull(), F.col("modified").eqNullSafe(F.col("m2"))).otherwise(True)
    met = met.withColumn("ok", F.col("response_id").isNotNull() & agrees)
    fresh = F.map_filter("headers", lambda k, _: k.isin(*PERMITTED))
    merged = F.map_concat(F.map_filter("h2", lambda k, _: ~F.map_contains_key(fresh, k)), fresh)
    state = F.when(F.col("response_id").isNull(), "no_earlier_response").when(F.col("ok"), "resolved").otherwise("validator_mismatch")
    done = met.select("record_id", F.col("u").alias("canonical_url"), state.alias("state"), "response_id", F.when(F.col("ok"), merged).otherwise(F.col("headers")).alias("headers"), F.when(F.col("ok"), F.col("b2")).alias("payload_bytes"), F.when(F.col("ok"), F.col("c2")).alias("payload_crc32"))
    own = rows.where("full").select("record_id", F.col("u").alias("canonical_url"), F.lit("response").alias("state"), F.col("record_id").alias("response_id"), "headers", "payload_bytes", "payload_crc32")
    out = own.unionByName(done)
    if payload:
        bodies = records.where("record_type = 'response'").select(F.col("record_id").alias("response_id"), "payload").dropDuplicates(["response_id"])
        out = out.join(bodies, "response_id", "left").withColumn("payload", F.when(F.col("state").isin("response", "resolved"), F.col("payload")))
    return out


def captures(pages: DataFrame) -> DataFrame:
    """Archive records made of pages: each page's response, and a later revisit, some with another validator, an earlier time, or only a time of modification."""
    i = F.col("page_id")
    text = lambda c: c.cast("string")
    html = F.coalesce("html", F.lit(""))
    first = pages.select(
        (i * 2).alias("record_id"), F.lit("response").alias("record_type"), "url", i.alias("captured_at"), F.md5(html.cast("binary")).alias("etag"), text(i).alias("last_modified"),
        F.create_map(F.lit("Content-Type"), F.lit("text/html"), F.lit("Date"), text(i), F.lit("Cache-Control"), F.lit("max-age=60"), F.lit("Content-Length"), text(F.octet_length(html))).alias("headers"), F.col("html").alias("payload"),
    )
    time = F.when(i % 11 == 0, i - 5).otherwise(i + 1 + i % 7)
    again = pages.select(
        (i * 2 + 1).alias("record_id"), F.lit("revisit").alias("record_type"), F.concat("url", F.lit("#again")).alias("url"), time.alias("captured_at"),
        F.when(i % 3 != 0, F.concat(F.lit("W/"), F.md5(F.concat(html, F.when(i % 5 == 0, F.lit("x")).otherwise(F.lit(""))).cast("binary")))).alias("etag"), F.when(i % 3 == 0, text(i + F.when(i % 2 == 0, 0).otherwise(1))).alias("last_modified"),
        F.create_map(F.lit("Date"), text(time), F.lit("Cache-Control"), F.lit("no-cache"), F.lit("Content-Length"), F.lit("0"), F.lit("Set-Cookie"), F.lit("a=b")).alias("headers"), F.lit(None).cast("string").alias("payload"),
    )
    return first.unionByName(again)
