"""Resolves not-modified revisits to the latest earlier full response of the same canonical address.

A record is (record_id, url, ts, status, headers, body), ``ts`` whole seconds or finer as a long. Status 200 is a full
response, 304 a revisit. The as-of join never gathers one address: rows of an address are dealt by ``span`` of time,
one window runs per address and span, and the last full response of each span, one row, is carried to the
later spans. Bodies and headers of the chosen response are then joined by record id.

A revisit's ETag is compared weakly with the response's; without one its Last-Modified must be the same.
Verdicts: ``resolved``, ``validator_mismatch``, ``no_validator`` (the revisit has none), ``no_earlier``. Only a resolved
revisit gets the body, and the response's headers updated by the headers a 304 may carry.

Defined results: a NULL address or time, or an earlier response without one, matches nothing; equal times are not earlier;
of responses at one time the largest record id counts; header names are compared in lower case, the last of equal
names wins; NULL headers and NULL values are none; repeated revisits are resolved each; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ladderweek.llm.common import stored

#: The header fields a 304 response carries to update the stored one.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")


def canonical_url(url: Column) -> Column:
    """Host in lower case without default port, path (at least ``/``), sorted query without utm fields; no scheme."""
    pattern = r"(?s)^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^?#]*)(?:\?([^#]*))?"
    part = lambda n: F.regexp_extract(url, pattern, n)
    host = F.regexp_replace(F.lower(part(1)), r":(80|443)$", "")
    path = F.when(part(2) == "", F.lit("/")).otherwise(part(2))
    fields = F.filter(F.split(part(3), "&"), lambda f: (f != "") & ~f.startswith("utm_"))
    query = F.array_join(F.array_sort(fields), "&")
    whole = F.concat(host, path, F.when(query == "", F.lit("")).otherwise(F.concat(F.lit("?"), query)))
    return F.when(url.rlike(pattern), whole).otherwise(F.regexp_replace(url, r"(?s)#.*$", ""))


def lower_names(headers: Column) -> Column:
    entries = F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>")))
    entries = F.filter(entries, lambda e: e["value"].isNotNull())
    named = F.transform(entries, lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    last = F.filter(
        F.transform(named, lambda e, i: F.struct(e["key"].alias("key"), e["value"].alias("value"), i.alias("at"))),
        lambda e: ~F.exists(F.slice(named, e["at"] + 2, F.size(named)), lambda later: later["key"] == e["key"]),
    )
    return F.map_from_entries(F.transform(last, lambda e: F.struct(e["key"], e["value"])))


def merged_headers(response: Column, revisit: Column) -> Column:
    """The response's headers, updated by the permitted ones of the revisit."""
    news = F.map_filter(revisit, lambda k, _: k.isin(*PERMITTED))
    kept = F.map_filter(response, lambda k, _: ~F.map_contains_key(news, k))
    return F.map_concat(kept, news)


def latest_earlier(rows: DataFrame, span: int) -> DataFrame:
    """(record_id, source_id, canonical) of the revisits; rows are (record_id, canonical, ts, full)."""
    dealt = rows.withColumn("part", F.floor(F.col("ts") / span))
    mark = F.when(F.col("full"), F.struct("ts", "record_id"))
    before = Window.partitionBy("canonical", "part").orderBy("ts").rangeBetween(Window.unboundedPreceding, -1)
    inside = dealt.withColumn("near", F.max(mark).over(before)).where("not full")
    ends = dealt.where("full").groupBy("canonical", "part").agg(F.max(F.struct("ts", "record_id")).alias("end"))
    asked = dealt.where("not full").select("canonical", "part").distinct()
    spans = ends.join(asked, ["canonical", "part"], "full_outer")  # a row per address and span
    past = Window.partitionBy("canonical").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = spans.select("canonical", "part", F.max("end").over(past).alias("far")).where("far is not null")
    found = inside.join(carried, ["canonical", "part"], "left")
    return found.select("record_id", "canonical", F.coalesce("near.record_id", "far.record_id").alias("source_id"))


def resolve(records: DataFrame, span: int = 86_400) -> DataFrame:
    """One row per revisit: record_id, canonical_url, source_id, verdict, headers, body."""
    light = records.where("status in (200, 304)").select(
        "record_id", canonical_url(F.col("url")).alias("canonical"), "ts", (F.col("status") == 200).alias("full")
    )
    usable = F.col("canonical").isNotNull() & F.col("ts").isNotNull()
    placed = stored(latest_earlier(light.where(usable), span).distinct(), "asof")
    revisits = records.where("status = 304").select(
        "record_id", canonical_url(F.col("url")).alias("canonical_url"), lower_names(F.col("headers")).alias("own")
    )
    revisits = revisits.join(placed.select("record_id", "source_id"), "record_id", "left")
    sources = records.where("status = 200").select(
        F.col("record_id").alias("source_id"), lower_names(F.col("headers")).alias("theirs"), "body"
    )
    both = revisits.join(sources, "source_id", "left")
    weak = lambda c: F.regexp_replace(c, r"^\s*W/", "")
    etag, modified = F.col("own")["etag"], F.col("own")["last-modified"]
    same = F.when(etag.isNotNull(), weak(etag) == weak(F.col("theirs")["etag"])).otherwise(
        modified == F.col("theirs")["last-modified"]
    )
    verdict = (
        F.when(F.col("source_id").isNull(), "no_earlier")
        .when(etag.isNull() & modified.isNull(), "no_validator")
        .when(F.coalesce(same, F.lit(False)), "resolved")
        .otherwise("validator_mismatch")
    )
    ok = F.col("verdict") == "resolved"
    return both.withColumn("verdict", verdict).select(
        "record_id",
        "canonical_url",
        "source_id",
        "verdict",
        F.when(ok, merged_headers(F.col("theirs"), F.col("own"))).alias("headers"),
        F.when(ok, F.col("body")).alias("body"),
    )
