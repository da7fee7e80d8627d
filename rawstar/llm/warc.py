r"""WARC: not-modified revisits resolved by an as-of join to the latest earlier full response.

Captures are rows (id, url, ts, kind, status, headers). For each ``revisit`` the operator finds, under
the same canonical URL, the latest ``response`` of status 200 that comes before it by (ts, id),
checks the validators, and merges the revisit's permitted headers over the response's.

Canonical URLs leave out scheme, user's case of the host, ``www.``, default port, fragment and
trailing slashes, and sort the query's parameters. Entity tags decide where both sides have
one, compared weakly; else the modification dates if both have one; else nothing is proved.

All captures are range-partitioned by (url, ts, id), so a URL with a third of all captures is cut
over many partitions; each partition looks back inside itself, and for a URL begun earlier one
carried row per partition gives the response before it.

A revisit without usable URL or time, without an earlier response, or with other validators is
returned unresolved, with its reason and its own headers. Null headers are empty. Captures that repeat give
rows that repeat. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rawstar.session import materialize, shuffle_width

# Headers of a not-modified answer that never replace stored ones.
KEPT_HEADERS = (
    "connection",
    "content-encoding",
    "content-length",
    "content-location",
    "content-md5",
    "content-range",
    "content-type",
    "keep-alive",
    "proxy-authenticate",
    "proxy-authorization",
    "te",
    "trailer",
    "transfer-encoding",
    "upgrade",
)
_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*://"


def canonical_url(url: Column) -> Column:
    """Host, path and sorted query; null where there is no host."""
    plain = F.regexp_replace(F.trim(url), r"(?s)#.*$", "")
    host = F.lower(F.regexp_extract(plain, _SCHEME + r"([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^www[0-9]*\.", "")
    path = F.regexp_replace(F.regexp_extract(plain, _SCHEME + r"[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(plain, r"(?s)\?(.*)$", 1)
    ordered = F.concat(F.lit("?"), F.array_join(F.array_sort(F.split(query, "&")), "&"))
    return F.when(host != "", F.concat(host, path, F.when(query != "", ordered).otherwise("")))


def _lower_names(headers: Column) -> Column:
    """Header names in lower case; of names equal in it, the last in name order counts."""
    entries = F.array_sort(F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>"))))
    named = F.transform(entries, lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    last = F.filter(
        F.transform(named, lambda e, i: F.struct(e["key"].alias("key"), e["value"].alias("value"), i.alias("i"))),
        lambda e: ~F.exists(F.slice(named, e["i"] + 2, F.size(named)), lambda x: x["key"] == e["key"]),
    )
    return F.map_from_entries(F.transform(last, lambda e: F.struct(e["key"], e["value"])))


def _merged(stored: Column, fresh: Column) -> Column:
    allowed = F.map_filter(fresh, lambda k, v: ~k.isin(*KEPT_HEADERS) & v.isNotNull())
    kept = F.map_filter(stored, lambda k, v: ~F.array_contains(F.map_keys(allowed), k))
    return F.map_concat(kept, allowed)


def _weak(tag: Column) -> Column:
    return F.regexp_replace(tag, r"^W/", "")


def latest_before(captures: DataFrame) -> DataFrame:
    """``captures`` (key, ts, id, kind, found) with ``before``: the last non-null ``found`` earlier under the key."""
    order = ["key", "ts", "id", "kind"]
    placed = captures.repartitionByRange(shuffle_width(captures.sparkSession), *order)
    placed = materialize(placed.withColumn("part", F.spark_partition_id()), "captures")
    inside = Window.partitionBy("part", "key").orderBy("ts", "id", "kind")
    looked = placed.withColumn("near", F.last("found", True).over(inside.rowsBetween(Window.unboundedPreceding, -1)))
    ends = placed.where("found is not null").groupBy("part", "key").agg(F.max_by("found", F.struct("ts", "id")).alias("end"))
    parts = placed.select("part", "key").distinct().join(ends, ["part", "key"], "left")
    # A key is in fewer parts than there are partitions.
    earlier = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.withColumn("far", F.last("end", True).over(earlier)).where("far is not null")
    joined = looked.join(carried.select("part", "key", "far"), ["part", "key"], "left")
    return joined.withColumn("before", F.coalesce("near", "far")).drop("part", "near", "far")


def resolve_revisits(captures: DataFrame) -> DataFrame:
    """For each revisit: id, canonical_url, response_id, outcome and the merged headers."""
    rows = captures.select(
        "id", canonical_url(F.col("url")).alias("key"), "ts", "kind", "status", _lower_names(F.col("headers")).alias("headers")
    )
    full = (F.col("kind") == "response") & (F.col("status") == 200)
    rows = rows.where(full | (F.col("kind") == "revisit"))
    rows = rows.withColumn("found", F.when(full, F.struct("id", "headers")))
    usable = F.col("key").isNotNull() & F.col("ts").isNotNull()
    placed = latest_before(rows.where(usable).drop("status")).where("kind = 'revisit'")
    lost = rows.where(~usable & (F.col("kind") == "revisit")).drop("status").withColumn("before", F.col("found"))
    both = placed.unionByName(lost)
    fresh, stored = F.col("headers"), F.col("before.headers")
    tags = _weak(fresh["etag"]) == _weak(stored["etag"])
    dates = fresh["last-modified"] == stored["last-modified"]
    outcome = (
        F.when(~usable, "no url or time")
        .when(F.col("before").isNull(), "no earlier response")
        .when(F.coalesce(tags, dates), "resolved")
        .when(F.coalesce(tags, dates).isNull(), "no validator")
        .otherwise("validators differ")
    )
    both = both.withColumn("outcome", outcome)
    done = F.col("outcome") == "resolved"
    return both.select(
        "id",
        F.col("key").alias("canonical_url"),
        F.when(done, F.col("before.id")).alias("response_id"),
        "outcome",
        F.when(done, _merged(stored, fresh)).otherwise(fresh).alias("headers"),
    )
