"""URL filters as a temporal list join.

Dated list entries (a scope is added to or removed from a list at a time) become validity intervals; every capture is
then evaluated against the intervals that held when it was fetched. Intervals are cut at fixed time buckets, so that
the as-of join is an equality join on scope and bucket and a hot scope is spread over its buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tesselar.workspace import materialize

#: Days of a time bucket.
BUCKET_DAYS = 30
#: Interval rows of about 60 bytes that may be sent to every executor; more are joined by a shuffle.
BROADCAST_ROWS = 100_000
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)"


def url_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, HOST, 1))


def url_scopes(url: Column) -> Column:
    """The scopes a URL lies in: its host and every parent domain of two labels or more, and its path prefixes.

    A domain scope is a host name, a prefix scope a host and the first segments of the path. No host, no scope.
    """
    host = url_host(url)
    labels = F.split(host, r"\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    segments = F.filter(F.split(F.regexp_extract(url, PATH, 1), "/"), lambda s: s != "")
    prefixes = F.when(
        F.size(segments) > 0,
        F.transform(
            F.sequence(F.lit(1), F.size(segments)),
            lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(segments, 1, i), "/")),
        ),
    ).otherwise(F.array().cast("array<string>"))
    return F.when(host != "", F.array_distinct(F.concat(domains, prefixes)))


def bucket(time: Column) -> Column:
    return F.floor(F.unix_timestamp(time) / (BUCKET_DAYS * 86400))


def validity_intervals(entries: DataFrame) -> DataFrame:
    """``list``, ``scope``, ``valid_from``, ``valid_to`` from rows ``list, scope, op ('add' or 'remove'), at``.

    An add holds until the next row of its list and scope, without one for ever (``valid_to`` null). At one
    moment a removal counts after an addition; repeated rows count once; rows with a null field are ignored.
    """
    rows = entries.select("list", "scope", "op", "at").na.drop().distinct()
    later = Window.partitionBy("list", "scope").orderBy("at", "op")
    spans = rows.withColumn("valid_to", F.lead("at").over(later)).where(F.col("op") == "add")
    spans = spans.where(F.col("valid_to").isNull() | (F.col("valid_to") > F.col("at")))
    return spans.select("list", "scope", F.col("at").alias("valid_from"), "valid_to")


def evaluate_captures(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """One row per capture (``page_id, url, fetched_at``) with the entries of its time.

    ``n_active`` counts the active entries whose scope the URL lies in. The longest such scope decides; of equal
    scopes the list of the greatest name (``block`` before ``allow``). ``blocked`` says whether that list is
    ``block``; ``scope`` and ``listed_at`` name the entry and are null without one. Captures with a null or
    unreadable URL or a null time meet no entry. Times may lie as far apart as they like. Repeated rows are one capture; other columns are ignored.
    """
    spans = materialize(validity_intervals(entries), "list-intervals")
    # Only buckets that a capture lies in: one with a date far off adds one, and all years of the calendar have 122,000.
    used = captures.select(bucket(F.col("fetched_at")).alias("bucket")).agg(F.sort_array(F.collect_set("bucket"))).scalar()
    first_bucket, last_bucket = bucket(F.col("valid_from")), bucket(F.col("valid_to"))
    inside = F.filter(F.col("used"), lambda b: (b >= first_bucket) & (last_bucket.isNull() | (b <= last_bucket)))
    cut = spans.withColumn("used", used).withColumn("bucket", F.explode(inside)).drop("used")
    cut = materialize(cut, "list-buckets")
    if cut.count() <= BROADCAST_ROWS:
        cut = F.broadcast(cut)
    asked = captures.select(
        "page_id", "url", "fetched_at", F.explode_outer(url_scopes(F.col("url"))).alias("scope"), bucket(F.col("fetched_at")).alias("bucket")
    )
    at = F.col("a.fetched_at")
    met = asked.alias("a").join(
        cut.alias("c"),
        (F.col("a.scope") == F.col("c.scope"))
        & (F.col("a.bucket") == F.col("c.bucket"))
        & (at >= F.col("c.valid_from"))
        & (F.col("c.valid_to").isNull() | (at < F.col("c.valid_to"))),
        "left",
    )
    entry = F.struct(F.length("c.scope").alias("n"), F.col("c.list").alias("list"), F.col("c.scope").alias("scope"), F.col("c.valid_from").alias("valid_from"))
    # At most one entry per list and scope of the URL: a small set.
    active = met.groupBy("a.page_id", "a.url", "a.fetched_at").agg(F.collect_set(F.when(F.col("c.scope").isNotNull(), entry)).alias("active"))
    first = F.array_max("active")
    return active.select(
        "page_id",
        "url",
        "fetched_at",
        F.size("active").cast("long").alias("n_active"),
        F.coalesce(first["list"] == "block", F.lit(False)).alias("blocked"),
        first["scope"].alias("scope"),
        first["valid_from"].alias("listed_at"),
    )


#: The captures and the dated lists of the registered query are derived from ``pages``: the time from the id, the
#: entries from a checksum of each host, domain and first path segment.
START = "unix_timestamp(TIMESTAMP '2023-01-01 00:00:00')"
DERIVED = {
    "host": ("block", 3, 400),
    "domain": ("block", 4, 300),
    "prefix": ("block", 10, 500),
    "exempt": ("allow", 6, 350),
}


def derived_captures(pages: DataFrame) -> DataFrame:
    start = F.expr(START)
    seconds = F.pmod(F.col("page_id") * 7919, F.lit(730)) * 86400 + F.pmod(F.col("page_id") * 104729, F.lit(86400))
    return pages.select("page_id", "url", F.timestamp_seconds(start + seconds).alias("fetched_at"))


def derived_entries(pages: DataFrame) -> DataFrame:
    scopes = pages.select(url_host(F.col("url")).alias("host"), F.regexp_extract("url", r"^[^:]+://[^/?#]*/([^/?#]+)", 1).alias("segment"))
    scopes = scopes.where("host <> ''").distinct()
    named = {
        "host": F.col("host"),
        "domain": F.regexp_extract("host", r"([^.]+\.[^.]+\.[^.]+)$", 1),
        "prefix": F.when(F.col("segment") != "", F.concat("host", F.lit("/"), "segment")),
        "exempt": F.col("host"),
    }
    kinds = F.explode(F.array(*[F.struct(F.lit(kind).alias("kind"), scope.alias("scope")) for kind, scope in named.items()])).alias("k")
    rows = scopes.select(kinds).select("k.kind", "k.scope").where("scope <> ''").distinct()
    rows = rows.withColumn("x", F.conv(F.substring(F.md5(F.concat("kind", F.lit(" "), "scope")), 1, 6), 16, 10).cast("long"))
    chosen = None
    for kind, (name, share, spread) in DERIVED.items():
        own = rows.where((F.col("kind") == kind) & (F.col("x") % share == 0)).select(F.lit(name).alias("list"), "scope", "x", (F.col("x") % spread).alias("day"))
        chosen = own if chosen is None else chosen.unionAll(own)
    events = F.array(
        F.struct(F.lit("add").alias("op"), F.col("day").alias("day")),
        F.struct(F.lit("remove").alias("op"), (F.col("day") + 60 + F.col("x") % 90).alias("day")),
        F.when(F.col("x") % 5 == 0, F.struct(F.lit("add").alias("op"), (F.col("day") + 200).alias("day"))),
    )
    dated = chosen.select("list", "scope", F.explode(F.array_compact(events)).alias("e"))
    at = F.timestamp_seconds(F.expr(START) + F.col("e.day") * 86400)
    return dated.select("list", "scope", F.col("e.op").alias("op"), at.alias("at"))


def op1_url_lists(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return evaluate_captures(derived_captures(pages), derived_entries(pages))


OP1_SQL = r"""
WITH p AS (SELECT page_id, url, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1) AS path,
    regexp_extract(url, '^[^:]+://[^/?#]*/([^/?#]+)', 1) AS segment,
    TIMESTAMP '2023-01-01 00:00:00' + to_seconds((page_id * 7919) % 730 * 86400 + (page_id * 104729) % 86400) AS fetched_at FROM pages),
k AS (SELECT DISTINCT * FROM (
    SELECT 'host' AS kind, host AS scope FROM p UNION ALL SELECT 'exempt', host FROM p
    UNION ALL SELECT 'domain', regexp_extract(host, '([^.]+\.[^.]+\.[^.]+)$', 1) FROM p
    UNION ALL SELECT 'prefix', host || '/' || segment FROM p WHERE segment <> '' AND host <> '') WHERE scope <> ''),
x AS (SELECT *, CAST('0x' || substr(md5(kind || ' ' || scope), 1, 6) AS BIGINT) AS x FROM k),
c AS (SELECT CASE kind WHEN 'exempt' THEN 'allow' ELSE 'block' END AS list, scope, x,
    x % CASE kind WHEN 'host' THEN 400 WHEN 'domain' THEN 300 WHEN 'prefix' THEN 500 ELSE 350 END AS day FROM x
    WHERE x % CASE kind WHEN 'host' THEN 3 WHEN 'domain' THEN 4 WHEN 'prefix' THEN 10 ELSE 6 END = 0),
e AS (SELECT DISTINCT list, scope, op, TIMESTAMP '2023-01-01 00:00:00' + to_seconds(day * 86400) AS since FROM (
    SELECT list, scope, 'add' AS op, day FROM c UNION ALL SELECT list, scope, 'remove', day + 60 + x % 90 FROM c
    UNION ALL SELECT list, scope, 'add', day + 200 FROM c WHERE x % 5 = 0)),
s AS (SELECT *, lead(since) OVER (PARTITION BY list, scope ORDER BY since, op) AS valid_to FROM e),
i AS (SELECT * FROM s WHERE op = 'add' AND (valid_to IS NULL OR valid_to > since)),
m AS (SELECT DISTINCT page_id, url, fetched_at, i.list, i.scope, i.since FROM p JOIN i ON p.fetched_at >= i.since AND (i.valid_to IS NULL OR p.fetched_at < i.valid_to)
    AND (p.host = i.scope OR ends_with(p.host, '.' || i.scope) OR p.host || p.path = i.scope OR starts_with(p.host || p.path, i.scope || '/'))
    AND (contains(i.scope, '.'))),
r AS (SELECT *, row_number() OVER (PARTITION BY page_id, url, fetched_at ORDER BY length(scope) DESC, list DESC, scope DESC, since DESC) AS n,
    count(*) OVER (PARTITION BY page_id, url, fetched_at) AS n_active FROM m)
SELECT p.page_id, p.url, p.fetched_at, CAST(coalesce(r.n_active, 0) AS BIGINT) AS n_active, coalesce(r.list = 'block', false) AS blocked,
    r.scope, r.since AS listed_at FROM (SELECT DISTINCT page_id, url, fetched_at FROM p) p
LEFT JOIN (SELECT * FROM r WHERE n = 1) r ON p.page_id = r.page_id AND p.url = r.url
"""
