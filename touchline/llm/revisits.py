"""Not-modified revisits of a web archive, resolved to the response that they repeat.

A revisit record has no body: it says that a URL had not changed. An as-of join by canonical URL finds the latest
earlier full response, whose validators must agree with the revisit's; the answer is that response with the headers
that a 304 may change taken from the revisit.

The join is a window over short stretches of time of each URL, with the last response before a stretch carried in
from one aggregate per stretch, so that a URL with a third of all records is many groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.common import table

#: Headers that a not-modified answer may bring up to date, in lower case.
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary"]
#: Records in a stretch of time, on average over all URLs, and stretches at most.
STRETCH_RECORDS = 1_000_000
STRETCHES = 1024
LEAST_STRETCHES = 16


def canonical_url(url: Column) -> Column:
    """Without scheme, "www.", fragment, tracking parameters and closing slash; the host in lower case."""
    bare = F.regexp_replace(F.trim(url), r"^[A-Za-z][A-Za-z0-9+.-]*://|#.*$", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, r"^[^/?]*", 0)), r"^www\.|:(80|443)$", "")
    rest = F.regexp_extract(bare, r"^[^/?]*(.*)$", 1)
    rest = F.regexp_replace(rest, r"([?&])(utm_[a-z]+|ref)=[^&]*", "$1")
    rest = F.regexp_replace(F.regexp_replace(F.regexp_replace(rest, r"&+", "&"), r"\?&", "?"), r"[?&/]+$", "")
    return F.concat(host, rest)


def resolve_revisits(records: DataFrame, stretches: int | None = None) -> DataFrame:
    """One row for each revisit: record_id, original_id, state, headers.

    ``records`` has record_id, url, time, kind ("response" or "revisit"), etag, last_modified, headers (a map with
    names in lower case). The original is the latest response of the URL that comes before the revisit by (time,
    record_id). ``state`` is "resolved"; "changed" if both have an etag, or else both a modification date, that
    differ; "unverified" if neither can be compared; "missing" without an earlier response. Only resolved and
    unverified revisits get headers. A null URL or time is "missing"; records that repeat are each resolved; other
    columns play no part."""
    rows = records.select("record_id", canonical_url(F.col("url")).alias("key"), "time", "kind", "etag", "last_modified", "headers")
    if stretches is None:
        stretches = min(STRETCHES, max(LEAST_STRETCHES, rows.count() // STRETCH_RECORDS))
    shares = [i / stretches for i in range(1, stretches)]
    bounds = rows.agg(F.percentile_approx("time", shares or [0.5], 10_000)).first()[0] or []
    rows = rows.withColumn("stretch", F.lit(0) + sum(((F.col("time") >= b).cast("int") for b in sorted(set(bounds))), F.lit(0)))
    response = F.when((F.col("kind") == "response") & F.col("time").isNotNull(), F.struct("time", "record_id", "etag", "last_modified", "headers"))
    known = rows.where(F.col("key").isNotNull() & F.col("time").isNotNull()).withColumn("response", response)

    within = Window.partitionBy("key", "stretch").orderBy("time", "record_id").rowsBetween(Window.unboundedPreceding, -1)
    latest = known.groupBy("key", "stretch").agg(F.max_by("response", F.when(F.col("response").isNotNull(), F.struct("time", "record_id"))).alias("latest"))
    # a URL has no more rows here than there are stretches
    earlier = Window.partitionBy("key").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    carried = latest.select("key", "stretch", F.last("latest", ignorenulls=True).over(earlier).alias("carried"))
    found = (
        known.withColumn("near", F.last("response", ignorenulls=True).over(within))
        .where(F.col("kind") == "revisit")
        .join(carried, ["key", "stretch"])
        .withColumn("original", F.coalesce("near", "carried"))
    )
    lost = rows.where((F.col("kind") == "revisit") & (F.col("key").isNull() | F.col("time").isNull()))
    mine, theirs = (lambda c: F.col(c)), (lambda c: F.col(f"original.{c}"))
    state = (
        F.when(F.col("original").isNull(), "missing")
        .when(mine("etag").isNotNull() & theirs("etag").isNotNull(), F.when(mine("etag") == theirs("etag"), "resolved").otherwise("changed"))
        .when(
            mine("last_modified").isNotNull() & theirs("last_modified").isNotNull(),
            F.when(mine("last_modified") == theirs("last_modified"), "resolved").otherwise("changed"),
        )
        .otherwise("unverified")
    )
    none = F.create_map().cast("map<string,string>")
    new = F.map_filter(F.coalesce("headers", none), lambda name, _: name.isin(PERMITTED))
    old = F.map_filter(F.coalesce(theirs("headers"), none), lambda name, _: ~F.map_contains_key(new, name))
    resolved = found.select("record_id", theirs("record_id").alias("original_id"), state.alias("state"), F.map_concat(old, new).alias("merged"))
    resolved = resolved.select(
        "record_id", "original_id", "state", F.when(F.col("state").isin("resolved", "unverified"), F.col("merged")).alias("headers")
    )
    return resolved.unionByName(
        lost.select("record_id", F.lit(None).cast(resolved.schema["original_id"].dataType).alias("original_id"), F.lit("missing").alias("state"), F.lit(None).cast("map<string,string>").alias("headers"))
    )


def archive_of(pages: DataFrame) -> DataFrame:
    """Pages as archive records: a response for each, and a revisit of its URL right after it. The time is the
    page's number within seven interleaved crawls, so that a URL's captures lie apart."""
    time = (F.col("page_id") % 7) * 1_000_000_000 + F.col("page_id") * 2
    etag, date = F.md5("html"), F.concat(F.lit("day "), (F.col("page_id") % 30).cast("string"))
    kind = F.explode(F.array(F.lit("response"), F.lit("revisit"))).alias("kind")
    revisit = F.col("kind") == "revisit"
    return pages.select("page_id", "url", "html", kind).select(
        (F.col("page_id") * 2 + revisit.cast("int")).alias("record_id"),
        "url",
        (time + revisit.cast("int")).alias("time"),
        "kind",
        F.when(F.col("page_id") % 3 != 0, etag).alias("etag"),
        date.alias("last_modified"),
        F.create_map(F.lit("content-length"), F.length("html").cast("string"), F.lit("date"), F.concat("kind", F.lit(" "), date)).alias("headers"),
    )


def op4_revisit_resolution(spark, sf_dir) -> DataFrame:
    found = resolve_revisits(archive_of(table(spark, sf_dir, "pages")))
    return found.select("record_id", "original_id", "state", F.to_json("headers").alias("headers"))
