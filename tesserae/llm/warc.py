"""Resolution of not-modified revisits in web captures.

A revisit (a 304 response) stands for the latest full response with the same canonical URL captured
before it. That is an as-of join. What a revisit finds hangs on its URL and time alone, so captures of
one URL and time are summed up first, and any burst is a row. The times of a URL are then walked in
order. A URL with more than `PER_BUCKET` of them is dealt to buckets by quantiles of its own times, so
that one with any share of all captures is spread over tasks, and the last response of its earlier
buckets, a row a bucket, is carried into the later ones.

The revisit's validators must agree with the response's. Its headers then replace the response's,
as far as a 304 may update them (RFC 9110, 15.4.5).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, table

#: Headers that a 304 may update.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
#: Times of a URL in one bucket, about.
PER_BUCKET = 100_000
#: Buckets of a URL at most; each is walked in order, in any memory, so more times only take longer.
BUCKETS = 1024


def canonical_url(url: Column) -> Column:
    """Host (lower case, without www and default ports), path without trailing slashes, and query without tracking, its parts in order.

    Scheme and fragment go. Null stays null.
    """
    bare = F.regexp_replace(F.regexp_replace(url, "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(bare, "^[^/?]*", 0))
    host = F.regexp_replace(F.regexp_replace(host, "^www[0-9]*\\.", ""), ":(80|443)$", "")
    rest = F.regexp_replace(bare, "^[^/?]*", "")
    rest = F.regexp_replace(rest, "([?&])(utm_[^=&]*|ref|fbclid|gclid)=[^&]*", "$1")
    rest = F.regexp_replace(F.regexp_replace(rest, "&&+", "&"), "\\?&+", "?")
    rest = F.regexp_replace(F.regexp_replace(rest, "[?&]+$", ""), "/+(\\?|$)", "$1")
    asked = F.regexp_extract(rest, "\\?(.*)$", 1)
    asked = F.when(asked == "", "").otherwise(F.concat(F.lit("?"), F.array_join(F.array_sort(F.split(asked, "&")), "&")))
    return F.concat(host, F.regexp_replace(rest, "\\?.*$", ""), asked)


def _bucketed(times: DataFrame, per_bucket: int) -> tuple[DataFrame, DataFrame]:
    """`times` (key, ts, ...) with the number of each one's bucket, and the keys that have several."""
    large = materialize(times.groupBy("key").count().where(F.col("count") > per_bucket))
    quantiles = F.percentile_approx("ts", [i / BUCKETS for i in range(1, BUCKETS)], 10_000)
    cuts = times.join(large, "key").groupBy("key").agg(quantiles.alias("cuts"), F.first("count").alias("count"))
    # Of 1,023 quantiles every so many, to leave buckets of about the size asked for.
    step = F.greatest(F.lit(1), F.floor(per_bucket * BUCKETS / F.col("count"))).cast("int")
    cuts = materialize(cuts.select("key", step.alias("step"), "cuts").select("key", F.expr("filter(array_distinct(cuts), (c, i) -> i % step = 0)").alias("cuts")))
    number = F.coalesce(F.size(F.filter("cuts", lambda c: c <= F.col("ts"))), F.lit(0))
    return times.join(cuts, "key", "left").withColumn("bucket", F.when(F.col("cuts").isNull(), 0).otherwise(number)).drop("cuts"), cuts.select("key")


def _bare(tag: Column) -> Column:
    """An entity tag for weak comparison."""
    return F.regexp_replace(tag, "^W/", "")


def resolve(records: DataFrame, per_bucket: int = PER_BUCKET) -> DataFrame:
    """One row for each revisit of `records` (record_id, url, ts, revisit, headers).

    record_id and ts are longs, revisit says whether the row is one, headers is a map with names in
    lower case. Returned: record_id, canonical_url, status, response_id and headers. status is
    'resolved', 'validator_mismatch' (response_id is the response that disagreed; headers are null)
    or 'no_earlier_response' (so for null URLs and times too). Earlier means a smaller ts; of
    responses with the same ts the greatest record_id counts, a null one being the least. Entity tags are compared weakly, and
    decide alone where both sides have one; else the dates of last modification do, where both have
    one; else nothing speaks against it. Null headers are none, and headers with a null value are not
    there. Repeated revisits are resolved each; other columns are left out; an empty table gives an
    empty result.
    """
    named = records.select("record_id", canonical_url(F.col("url")).alias("key"), "ts", "revisit", F.map_filter(F.coalesce("headers", F.create_map().cast("map<string,string>")), lambda k, v: v.isNotNull()).alias("headers"))
    known = named.where("key is not null and ts is not null")
    response = F.when(~F.col("revisit"), F.struct("record_id", "headers"))
    times = known.groupBy("key", "ts").agg(F.max_by(response, F.when(~F.col("revisit"), F.coalesce("record_id", F.lit(-(1 << 63))))).alias("here"))
    times, large = _bucketed(materialize(times), per_bucket)
    before = Window.partitionBy("key", "bucket").orderBy("ts").rowsBetween(Window.unboundedPreceding, -1)
    walked = times.withColumn("near", F.last("here", ignorenulls=True).over(before))
    ends = times.join(large, "key", "left_semi").groupBy("key", "bucket").agg(F.max_by("here", F.when(F.col("here").isNotNull(), F.col("ts"))).alias("end"))
    earlier = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("key", "bucket", F.last("end", ignorenulls=True).over(earlier).alias("carried"))
    earliest = walked.join(carried, ["key", "bucket"], "left").select("key", "ts", F.coalesce("near", "carried").alias("full"))
    found = known.where("revisit").join(earliest, ["key", "ts"])
    own, full = F.col("headers"), F.col("full.headers")
    tags = own["etag"].isNotNull() & full["etag"].isNotNull()
    dates = own["last-modified"].isNotNull() & full["last-modified"].isNotNull()
    agrees = F.when(tags, _bare(own["etag"]) == _bare(full["etag"])).when(dates, own["last-modified"] == full["last-modified"]).otherwise(True)
    status = F.when(F.col("full").isNull(), "no_earlier_response").when(agrees, "resolved").otherwise("validator_mismatch")
    updates = F.map_filter(own, lambda k, v: k.isin(*PERMITTED))
    kept = F.map_filter(full, lambda k, v: ~F.array_contains(F.map_keys(updates), k))
    out = found.select(
        "record_id", F.col("key").alias("canonical_url"), status.alias("status"), F.col("full.record_id").alias("response_id"), F.when(status == "resolved", F.map_concat(kept, updates)).alias("headers")
    )
    lost = named.where("revisit and (key is null or ts is null)").select(
        "record_id", F.col("key").alias("canonical_url"), F.lit("no_earlier_response").alias("status"), F.lit(None).cast("long").alias("response_id"), F.lit(None).cast("map<string,string>").alias("headers")
    )
    return out.unionByName(lost)


#: Pages between a page's capture and its revisit in captures().
DELAY = 5000


def _headers(kind: Column, ts: Column, etag: Column, modified: Column) -> Column:
    names = (("content-type", kind), ("date", ts.cast("string")), ("etag", etag), ("last-modified", modified))
    return F.map_filter(F.create_map(*(x for name, value in names for x in (F.lit(name), value))), lambda k, v: v.isNotNull())


def captures(pages: DataFrame) -> DataFrame:
    """Captures made of `pages`: of every page a full response and a revisit with its validators, and one of its host's robots.txt.

    Times follow page_id; every seventh page is revisited before its response. The entity tag is a
    digest of the page, weak in revisits of odd pages; every third page gives a date instead. A
    host's robots.txt is fetched with each of its pages: in full for odd ones, as a revisit for the
    others, and its tag changes every six pages; so a URL has many captures of both kinds in turn.
    """
    p = pages.select("page_id", "url", F.substring(F.md5(F.coalesce("html", F.lit(""))), 1, 12).alias("tag"))
    page, quote, none = F.col("page_id"), F.lit('"'), F.lit(None).cast("string")
    dated, odd = page % 3 == 0, page % 2 == 1
    etag = F.when(~dated, F.concat(quote, F.col("tag"), quote))
    modified = F.when(dated, F.concat(F.lit("day "), (page % 28).cast("string")))
    again = F.when(page % 7 == 0, page - 1).otherwise(page + DELAY)
    weak = F.when(odd, F.concat(F.lit("W/"), etag)).otherwise(etag)
    robots = F.concat(F.regexp_extract(canonical_url(F.col("url")), "^[^/?]*", 0), F.lit("/robots.txt"))
    version = F.concat(quote, F.floor(page / 6).cast("string"), quote)
    html, message = F.lit("text/html"), F.lit("message/http")
    full = p.select((3 * page).alias("record_id"), "url", page.alias("ts"), F.lit(False).alias("revisit"), _headers(html, page, etag, modified).alias("headers"))
    revisit = p.select((3 * page + 1).alias("record_id"), "url", again.alias("ts"), F.lit(True).alias("revisit"), _headers(message, again, weak, modified).alias("headers"))
    host = p.select((3 * page + 2).alias("record_id"), robots.alias("url"), page.alias("ts"), (~odd).alias("revisit"), _headers(F.when(odd, "text/plain").otherwise(message), page, version, none).alias("headers"))
    return full.unionByName(revisit).unionByName(host)


def op2_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revisits of all pages, resolved."""
    found = resolve(captures(table(spark, sf_dir, "pages")))
    h = F.col("headers")
    return found.select(
        "record_id", "canonical_url", "status", "response_id", h["date"].alias("date"), h["etag"].alias("etag"), h["last-modified"].alias("last_modified"), h["content-type"].alias("content_type"), F.coalesce(F.size(h), F.lit(-1)).alias("n_headers")
    )


def _sql_replace(text: str, pattern: str, to: str = "") -> str:
    return f"regexp_replace({text}, '{pattern}', '{to}', 'g')"


_BARE = _sql_replace(_sql_replace("url", "#.*$"), "^[A-Za-z][A-Za-z0-9+.-]*://")
_HOST = _sql_replace(_sql_replace(f"lower(regexp_extract({_BARE}, '^[^/?]*'))", r"^www[0-9]*\."), ":(80|443)$")
_REST = _sql_replace(_sql_replace(_BARE, "^[^/?]*"), r"([?&])(utm_[^=&]*|ref|fbclid|gclid)=[^&]*", r"\1")
_REST = _sql_replace(_sql_replace(_sql_replace(_sql_replace(_REST, "&&+", "&"), r"\?&+", "?"), "[?&]+$"), r"/+(\?|$)", r"\1")
_ASKED = f"regexp_extract({_REST}, '\\?(.*)$', 1)"
_KEY = f"({_HOST}) || {_sql_replace(_REST, r'\?.*$')} || CASE WHEN {_ASKED} = '' THEN '' ELSE '?' || array_to_string(list_sort(string_split({_ASKED}, '&')), '&') END"
OP2_SQL = f"""
WITH p AS (
  SELECT page_id, {_KEY} AS key, substr(md5(coalesce(html, '')), 1, 12) AS tag, '"' || (page_id // 6) || '"' AS version,
    CASE WHEN page_id % 7 = 0 THEN page_id - 1 ELSE page_id + {DELAY} END AS again FROM pages),
f AS (
  SELECT 3 * page_id AS id, key, page_id AS ts, CASE WHEN page_id % 3 <> 0 THEN '"' || tag || '"' END AS etag,
    CASE WHEN page_id % 3 = 0 THEN 'day ' || (page_id % 28) END AS modified, 'text/html' AS kind FROM p
  UNION ALL SELECT 3 * page_id + 2, regexp_extract(key, '^[^/?]*') || '/robots.txt', page_id, version, NULL, 'text/plain' FROM p WHERE page_id % 2 = 1),
r AS (
  SELECT 3 * page_id + 1 AS id, key, again AS ts,
    CASE WHEN page_id % 3 <> 0 THEN CASE WHEN page_id % 2 = 1 THEN 'W/' ELSE '' END || '"' || tag || '"' END AS etag,
    CASE WHEN page_id % 3 = 0 THEN 'day ' || (page_id % 28) END AS modified FROM p
  UNION ALL SELECT 3 * page_id + 2, regexp_extract(key, '^[^/?]*') || '/robots.txt', page_id, version, NULL FROM p WHERE page_id % 2 = 0),
j AS (
  SELECT r.id, r.key, r.ts, r.etag, r.modified, f.id AS fid, f.etag AS fetag, f.modified AS fmodified, f.kind,
    row_number() OVER (PARTITION BY r.id ORDER BY f.ts DESC, f.id DESC) AS n
  FROM r LEFT JOIN f ON r.key = f.key AND f.ts < r.ts),
s AS (
  SELECT *, CASE WHEN fid IS NULL THEN 'no_earlier_response'
    WHEN etag IS NOT NULL AND fetag IS NOT NULL THEN CASE WHEN regexp_replace(etag, '^W/', '') = fetag THEN 'resolved' ELSE 'validator_mismatch' END
    WHEN modified IS NOT NULL AND fmodified IS NOT NULL THEN CASE WHEN modified = fmodified THEN 'resolved' ELSE 'validator_mismatch' END
    ELSE 'resolved' END AS status
  FROM j WHERE n = 1)
SELECT id AS record_id, key AS canonical_url, status, fid AS response_id,
  CASE WHEN status = 'resolved' THEN CAST(ts AS VARCHAR) END AS date,
  CASE WHEN status = 'resolved' THEN coalesce(etag, fetag) END AS etag,
  CASE WHEN status = 'resolved' THEN coalesce(modified, fmodified) END AS last_modified,
  CASE WHEN status = 'resolved' THEN kind END AS content_type,
  CAST(CASE WHEN status = 'resolved' THEN 2 + (coalesce(etag, fetag) IS NOT NULL)::INT + (coalesce(modified, fmodified) IS NOT NULL)::INT ELSE -1 END AS INTEGER) AS n_headers
FROM s
"""
