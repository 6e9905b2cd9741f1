"""Line deduplication by site-relative frequency, in DataFrame functions only.

For each host, the pages that contain a line are divided by the host's pages; lines above ``max_ratio`` that stand on at
least ``min_pages`` pages are boilerplate of that host and are dropped from its pages. Only 128-bit hashes of lines are
shuffled, counted with partial sums first, so a host or line with a third of all rows is summed where it is read.

The query counts rows, as its SQL does. The stage (``drop_lines``) counts distinct texts, so that copies of a page don't
make its prose boilerplate, and leaves each dropped line whole in the host's page of least doc_id: the page that near
dedup keeps of a group of copies.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, text_or_empty

MAX_RATIO = 0.01
MIN_PAGES = 5
#: Boilerplate lines up to which the list of lines by host is broadcast (16 bytes each, 8 MB); above it, it is joined.
BROADCAST_LINES = 500_000
#: Ways in which a host's pages are dealt when the list is joined.
SALTS = 64


def line_key(line: Column) -> Column:
    """Line, without white space around it, as two independent 64-bit hashes."""
    bare = F.trim(line, F.lit(" \t\r\f\x0b"))
    return F.struct(F.xxhash64(bare).alias("h1"), F.xxhash64(F.lit(1), bare).alias("h2"))


def is_blank(line: Column) -> Column:
    return ~line.rlike(r"[^\x20\x09-\x0D]")


def text_boilerplate(docs: DataFrame, host: str = "source", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """As boilerplate(), of distinct texts instead of rows, with first, the least doc_id whose page holds the line."""
    t = text_or_empty()
    key = F.struct(F.xxhash64(t).alias("h1"), F.xxhash64(F.lit(1), t).alias("h2"))
    pages = docs.select(F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"), t.alias("t"), key.alias("page"), F.col("doc_id").alias("id"))
    totals = pages.select("host", "page").distinct().groupBy("host").agg(F.count("*").alias("host_pages"))
    lines = F.array_distinct(F.transform(F.filter(F.split("t", "\n"), lambda x: ~is_blank(x)), line_key))
    once = pages.select("host", "page", "id", F.explode(lines).alias("line")).groupBy("host", "line", "page").agg(F.min("id").alias("first"))
    seen = once.groupBy("host", "line").agg(F.count("*").alias("pages"), F.min("first").alias("first")).where(F.col("pages") >= min_pages)
    return seen.join(totals, "host").where(F.col("pages") > max_ratio * F.col("host_pages"))


def boilerplate(docs: DataFrame, host: str = "source", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, line struct, pages, host_pages) of lines to drop."""
    pages = docs.select(F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"), text_or_empty().alias("t"))
    totals = pages.groupBy("host").agg(F.count("*").alias("host_pages"))
    lines = F.array_distinct(F.transform(F.filter(F.split("t", "\n"), lambda x: ~is_blank(x)), line_key))
    seen = pages.select("host", F.explode(lines).alias("line")).groupBy("host", "line").agg(F.count("*").alias("pages")).where(F.col("pages") >= min_pages)
    return seen.join(totals, "host").where(F.col("pages") > max_ratio * F.col("host_pages"))


def _apply(pages: DataFrame, listed: DataFrame, spread: bool) -> DataFrame:
    """pages (host, t, ...) with drop, the array of line keys to drop, or null."""
    by_host = listed.groupBy("host").agg(F.collect_list("line").alias("drop"))  # at most lines-per-page / max_ratio
    if not spread:
        return pages.join(F.broadcast(by_host), "host", "left")
    salted = by_host.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = pages.withColumn("salt", F.pmod(F.xxhash64("t"), F.lit(SALTS)).cast("int"))
    return dealt.join(salted, ["host", "salt"], "left").drop("salt")


def deduplicate(docs: DataFrame, host: str = "source", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES, broadcast_lines: int = BROADCAST_LINES, by_text: bool = False) -> DataFrame:
    """docs' columns as struct __row, with clean text, n_lines and n_dropped.

    A line counts once a page however often it stands there; lines without a word are neither counted nor dropped. Null
    hosts are one host, null text is empty; a page whose lines all go keeps an empty text. Ratios are strict: a line
    at max_ratio stays. Repeated rows are pages of their own; an empty table gives an empty table. With by_text, pages
    are distinct texts, and the page of least doc_id (all without one, if none has one) keeps a listed line.
    """
    found = (text_boilerplate if by_text else boilerplate)(docs, host, max_ratio, min_pages)
    listed = materialize(found.select("host", "line", *["first"] * by_text), "boilerplate")
    pages = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"), text_or_empty().alias("t"))
    spread = listed.count() > broadcast_lines
    joined = _apply(pages, listed, spread)
    if by_text:
        own = listed.groupBy(F.col("host").alias("__host"), "first").agg(F.collect_list("line").alias("own"))
        joined = joined.join(own if spread else F.broadcast(own), (F.col("host") == F.col("__host")) & F.col("__row.doc_id").eqNullSafe(F.col("first")), "left")
    else:
        joined = joined.withColumn("own", F.lit(None).cast("array<struct<h1:bigint,h2:bigint>>"))
    lines = F.split("t", "\n")
    # first by a hash set, so that a page costs its lines plus its host's list; then whole keys against those found
    found = F.array_intersect(F.transform(lines, lambda x: line_key(x)["h1"]), F.col("drop.h1"))
    bound = F.transform(F.array(found), lambda hits: F.filter(F.col("drop"), lambda d: F.array_contains(hits, d["h1"])))  # made once a row
    joined = joined.withColumn("drop", F.when(F.col("drop").isNotNull(), bound[0]))
    owned = lambda x: F.coalesce(F.array_contains(F.col("own"), line_key(x)), F.lit(False))
    stays = F.filter(lines, lambda x: is_blank(x) | ~F.array_contains(F.col("drop"), line_key(x)) | owned(x))
    some = joined.withColumn("left", F.when(F.coalesce(F.size("drop"), F.lit(0)) <= 0, lines).otherwise(stays))
    return some.select("__row", F.array_join("left", "\n").alias("clean"), F.size(lines).cast("long").alias("n_lines"), (F.size(lines) - F.size("left")).cast("long").alias("n_dropped"))


def report(docs: DataFrame) -> DataFrame:
    """Columns of op4: doc_id, n_lines, n_dropped, clean_chars, clean_sha256."""
    out = deduplicate(docs)
    return out.select(F.col("__row.doc_id").cast("long").alias("doc_id"), "n_lines", "n_dropped", F.length("clean").cast("long").alias("clean_chars"), F.sha2("clean", 256).alias("clean_sha256"))


def drop_lines(docs: DataFrame) -> DataFrame:
    """docs with clean texts (null texts stay null), n_chars counted anew, other columns as they were.

    Rows whose every line goes go too: their lines stand in other rows of the host.
    """
    out = deduplicate(docs, by_text=True).where((F.col("n_dropped") == 0) | ~is_blank(F.col("clean"))).withColumn("__text", F.when(F.col("__row.text").isNotNull(), F.col("clean")))
    fields = {"text": F.col("__text"), "n_chars": F.length("__text").cast("long")}
    return out.select(*[fields.get(c, F.col(f"__row.`{c}`")).alias(c) for c in docs.columns])


ORACLE_SQL = f"""
WITH page AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(source, '') AS host, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
line AS (SELECT rid, doc_id, host, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM page),
bare AS (SELECT *, trim(line, ' ' || chr(9) || chr(13) || chr(12) || chr(11)) AS b, NOT regexp_matches(line, '[^\\x20\\x09-\\x0D]') AS blank FROM line),
total AS (SELECT host, count(*) AS host_pages FROM page GROUP BY host),
seen AS (SELECT host, b, count(DISTINCT rid) AS pages FROM bare WHERE NOT blank GROUP BY host, b),
bad AS (SELECT host, b FROM seen JOIN total USING (host) WHERE pages >= {MIN_PAGES} AND pages > {MAX_RATIO} * host_pages),
flag AS (SELECT x.*, NOT blank AND bad.b IS NOT NULL AS gone FROM bare x LEFT JOIN bad ON bad.host = x.host AND bad.b = x.b),
doc AS (SELECT rid, any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
        coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS clean FROM flag GROUP BY rid)
SELECT doc_id, n_lines, n_dropped, length(clean) AS clean_chars, sha256(clean) AS clean_sha256 FROM doc
"""
