"""WARC not-modified revisits resolved by an as-of join.

A revisit record (server answered 304) has no payload; it stands for the latest earlier full response of the same
canonical URL. The join is resolved if the validators agree: the revisit's ETag (weak comparison), else its
Last-Modified, else its payload digest must equal the response's. A resolved revisit gets the response's payload
digest and headers, with those headers replaced that a 304 may update.

The as-of join sorts all records by (URL, time, kind, record_id) into ranges, fills the last response forward inside a
range and, from one small row per range, across ranges. No URL's history meets in one task, and the history is not
multiplied: a URL with a third of all records is cut into as many ranges as its size asks for.

Defined cases: records with a null URL or time never resolve (reason ``no-response``); a revisit at the same time as a
response comes after it; equal times are ordered by record_id, then by validators; repeated rows each get their
result; empty headers merge to the response's; an empty table gives an empty result; a revisit without validators is
``unverified``, with others than the response's ``changed``; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lectern.llm.common import staged

# Header fields that a 304 response may update.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary", "set-cookie", "age")
RESPONSE_FIELDS = ("record_id", "ts", "etag", "last_modified", "digest", "headers")


def canonical_url(url: Column) -> Column:
    """Scheme and ``www.`` dropped, host in lower case, default port, fragment and final slash dropped, query sorted."""
    bare = F.regexp_replace(F.regexp_replace(url, r"#.*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, r"^([^/?]*)", 1)), r"^www\.|:(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.array_join(F.array_sort(F.split(F.regexp_extract(bare, r"\?(.*)$", 1), "&")), "&")
    return F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def bare_etag(etag: Column) -> Column:
    return F.regexp_replace(etag, "^W/", "")


def merged_headers(old: Column, new: Column) -> Column:
    """The response's headers; permitted ones of the revisit take their place."""
    none = F.create_map().cast("map<string,string>")
    update = F.map_filter(F.coalesce(new, none), lambda k, _: k.isin(*PERMITTED))
    kept = F.map_filter(F.coalesce(old, none), lambda k, _: ~F.array_contains(F.map_keys(update), k))
    return F.map_concat(kept, update)


def resolve(records: DataFrame) -> DataFrame:
    """(record_id, url, ts, resolved_id, reason, digest, headers) of every revisit.

    ``records``: record_id, url, ts, kind (response or revisit), etag, last_modified, digest, headers (lower-case names).
    """
    later = (F.col("kind") != "response").cast("int")
    rows = records.where(F.col("kind").isin("response", "revisit")).select(
        canonical_url(F.col("url")).alias("site"), "ts", later.alias("later"), "record_id", "url", "etag",
        "last_modified", "digest", "headers")
    order = ["site", "ts", "later", "record_id", "etag", "digest"]
    # Written once: the ranges must be the same for both readers.
    ranged = staged(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "revisits")
    usable = (F.col("later") == 0) & F.col("site").isNotNull() & F.col("ts").isNotNull()
    response = F.when(usable, F.struct(*RESPONSE_FIELDS))
    here = Window.partitionBy("part", "site").orderBy(*order[1:]).rowsBetween(Window.unboundedPreceding, 0)
    filled = ranged.withColumn("own", F.last(response, ignorenulls=True).over(here))

    # What ranges before hand over: per range the last response of its last site, if the next range goes on with it.
    ends = ranged.groupBy("part").agg(F.max("site").alias("last_site"))
    last = ranged.join(ends, "part").where((F.col("site") == F.col("last_site")) & usable).groupBy("part", "site").agg(
        F.max_by(F.struct(*RESPONSE_FIELDS), F.struct("ts", "record_id", "etag", "digest")).alias("carried"))
    # One row per range: the latest range before that ended in the same site with a response.
    starts = ranged.groupBy("part").agg(F.min("site").alias("site")).withColumn("wants", F.lit(True))
    before = Window.partitionBy("site").orderBy("part", F.col("wants").desc()).rowsBetween(
        Window.unboundedPreceding, -1)
    events = starts.select("part", "site", "wants", F.lit(None).cast(last.schema["carried"].dataType).alias("carried")).union(
        last.select("part", "site", F.lit(False), "carried"))
    carry = events.withColumn("carried", F.last("carried", ignorenulls=True).over(before)).where("wants").select(
        "part", "site", "carried")
    joined = filled.where("later = 1").join(carry, ["part", "site"], "left").withColumn(
        "found", F.when(F.col("site").isNotNull() & F.col("ts").isNotNull(), F.coalesce("own", "carried")))
    same = F.when(F.col("etag").isNotNull() & F.col("found.etag").isNotNull(),
                  bare_etag(F.col("etag")) == bare_etag(F.col("found.etag"))).when(
        F.col("last_modified").isNotNull() & F.col("found.last_modified").isNotNull(),
        F.col("last_modified") == F.col("found.last_modified")).when(
        F.col("digest").isNotNull() & F.col("found.digest").isNotNull(), F.col("digest") == F.col("found.digest"))
    reason = F.when(F.col("found").isNull(), "no-response").when(same.isNull(), "unverified").when(same, "resolved").otherwise("changed")
    out = joined.withColumn("reason", reason)
    done = F.col("reason") == "resolved"
    return out.select("record_id", "url", "ts", F.when(done, F.col("found.record_id")).alias("resolved_id"), "reason",
                      F.when(done, F.col("found.digest")).otherwise(F.col("digest")).alias("digest"),
                      F.when(done, merged_headers(F.col("found.headers"), F.col("headers"))).otherwise(F.col("headers")).alias("headers"))


def page_records(pages: DataFrame) -> DataFrame:
    """Captures derived from ``pages``: each page as a response when it was crawled, and a 304 answer half a day after.

    page_id is the crawl's clock, in hours, so pages of one URL follow each other. Every seventh revisit carries the
    ETag of other content, every eleventh only the time of its content.
    """
    digest = F.sha1(F.coalesce(F.col("html"), F.lit("")))
    hours, k = F.col("page_id"), F.col("page_id")
    etag = F.concat(F.lit('"'), F.substring(digest, 1, 16), F.lit('"'))
    rows = pages.select("page_id", "url", digest.alias("digest"), etag.alias("tag"), (hours * 3600).alias("at"))
    dated = lambda t: F.date_format(F.timestamp_seconds(t), "yyyy-MM-dd HH:mm:ss")
    response = F.struct(
        (k * 2).alias("record_id"), F.col("at").alias("ts"), F.lit("response").alias("kind"), F.col("tag").alias("etag"),
        dated(F.col("at")).alias("last_modified"), F.col("digest").alias("digest"),
        F.create_map(F.lit("content-type"), F.lit("text/html"), F.lit("etag"), F.col("tag"), F.lit("date"),
                     dated(F.col("at"))).alias("headers"))
    later = F.col("at") + 43200
    changed = F.concat(F.lit('W/"'), F.reverse(F.substring("digest", 1, 16)), F.lit('"'))
    weak = F.concat(F.lit("W/"), F.col("tag"))
    revisit = F.struct(
        (k * 2 + 1).alias("record_id"), later.alias("ts"), F.lit("revisit").alias("kind"),
        F.when(k % 11 == 0, F.lit(None).cast("string")).when(k % 7 == 0, changed).otherwise(weak).alias("etag"),
        dated(F.col("at")).alias("last_modified"), F.lit(None).cast("string").alias("digest"),
        F.create_map(F.lit("content-type"), F.lit("text/plain"), F.lit("date"), dated(later)).alias("headers"))
    return rows.select("url", F.explode(F.array(response, revisit)).alias("r")).select("url", "r.*")
