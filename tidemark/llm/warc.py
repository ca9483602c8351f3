"""WARC revisits: each not-modified record finds the latest earlier full response of its page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.sweep import latest_mark

#: Header fields that a not-modified record must not change: those of one connection,
#: and those that describe the stored body.
KEPT = (
    "connection",
    "content-encoding",
    "content-length",
    "content-md5",
    "content-range",
    "content-type",
    "keep-alive",
    "proxy-authenticate",
    "proxy-authorization",
    "proxy-connection",
    "te",
    "trailer",
    "transfer-encoding",
    "upgrade",
)


def canonical_url(url: Column) -> Column:
    """Lower-case scheme and host, no default port, fragment or utm_ parameters, ``/`` for no path."""
    whole = F.regexp_replace(F.trim(url), "#.*$", "")
    scheme = F.lower(F.regexp_extract(whole, "^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    host = F.lower(F.regexp_extract(whole, "^[^:/?]+://([^/?]*)", 1))
    host = F.when(scheme == "http", F.regexp_replace(host, ":80$", "")).when(
        scheme == "https", F.regexp_replace(host, ":443$", "")
    ).otherwise(host)
    path = F.regexp_extract(whole, "^[^:/?]+://[^/?]*([^?]*)", 1)
    query = F.regexp_extract(whole, r"^[^?]*\?(.*)$", 1)
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: ~F.startswith(p, F.lit("utm_")) & (p != "")), "&")
    return F.when(scheme == "", whole).otherwise(
        F.concat(scheme, F.lit("://"), host, F.when(path == "", "/").otherwise(path), F.when(kept == "", "").otherwise(F.concat(F.lit("?"), kept)))
    )


def header(headers: Column, name: str) -> Column:
    """The first value of a header field, whatever its case; NULL if there is none."""
    return F.get(F.filter(headers, lambda h: F.lower(h["name"]) == name), F.lit(0))["value"]


def _weak(tag: Column) -> Column:
    return F.regexp_replace(F.trim(tag), "^W/", "")


def merge_headers(stored: Column, update: Column) -> Column:
    """The stored fields, those that the update may change replaced by its own."""
    allowed = F.filter(update, lambda h: ~F.lower(h["name"]).isin(*KEPT))
    names = F.transform(allowed, lambda h: F.lower(h["name"]))
    return F.concat(F.filter(stored, lambda h: ~F.array_contains(names, F.lower(h["name"]))), allowed)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """(record_id, url, canonical_url, ts, status, original_id, headers) for every revisit record.

    ``records`` has record_id, url, ts, kind (``response``, ``revisit`` or others),
    status and headers, an array of (name, value). A full response is a ``response``
    with status 200. Each revisit takes the latest full response of its canonical url
    with an earlier ts; of several at one ts, the greatest record_id.

    ``status`` is ``resolved`` if the validators agree: the entity tags, weakly
    compared, if both have one, else the times of last modification; ``mismatch`` if
    they differ, ``no_validator`` if the two share none, ``no_original`` if there is no
    earlier response. Only a resolved revisit gets ``original_id`` and ``headers``:
    the response's, updated by the fields that a not-modified record may change.

    Revisits without url or ts have no original. Null headers are none. Repeated
    records each give a row. Other columns are ignored; an empty table gives no rows.

    Captures are swept in order of (url, ts) over ranges, so a page may hold any part
    of the rows. Only keys, validators and headers move, never bodies.
    """
    empty = F.expr("cast(array() as array<struct<name:string,value:string>>)")
    slim = records.select(
        "record_id",
        "url",
        canonical_url(F.col("url")).alias("canonical_url"),
        "ts",
        "kind",
        F.col("status").cast("int").alias("code"),
        F.coalesce(
            F.transform("headers", lambda h: F.struct(h["name"].alias("name"), h["value"].alias("value"))), empty
        ).alias("headers"),
    )
    revisits = slim.filter("kind = 'revisit'").drop("kind", "code")
    placed = revisits.filter("canonical_url IS NOT NULL AND ts IS NOT NULL")
    originals = slim.filter(
        "kind = 'response' AND code = 200 AND canonical_url IS NOT NULL AND ts IS NOT NULL"
    ).select(
        "canonical_url",
        "ts",
        F.struct("record_id", F.col("canonical_url").alias("page"), "headers").alias("mark"),
    )
    points = placed.withColumn("at", F.col("ts"))
    found = latest_mark(points, originals, ["canonical_url", "ts"], ["record_id", "url"], strict=True)
    found = found.withColumn(
        "mark", F.when(F.col("mark.page") == F.col("canonical_url"), F.col("mark"))
    ).drop("at")
    lost = revisits.filter("canonical_url IS NULL OR ts IS NULL").withColumn(
        "mark", F.lit(None).cast(dict(originals.dtypes)["mark"])
    )
    both = found.unionByName(lost)
    theirs, ours = F.col("mark.headers"), F.col("headers")
    tag, old_tag = _weak(header(ours, "etag")), _weak(header(theirs, "etag"))
    time, old_time = header(ours, "last-modified"), header(theirs, "last-modified")
    agree = F.when(tag.isNotNull() & old_tag.isNotNull(), tag == old_tag).when(
        time.isNotNull() & old_time.isNotNull(), time == old_time
    )
    status = (
        F.when(F.col("mark").isNull(), "no_original")
        .when(agree.isNull(), "no_validator")
        .when(agree, "resolved")
        .otherwise("mismatch")
    )
    out = both.withColumn("status", status)
    resolved = F.col("status") == "resolved"
    return out.select(
        "record_id",
        "url",
        "canonical_url",
        "ts",
        "status",
        F.when(resolved, F.col("mark.record_id")).alias("original_id"),
        F.when(resolved, merge_headers(theirs, ours)).alias("headers"),
    )
