"""URL filters by a temporal list join.

A block list is a log of dated entries (host pattern, date, action). Each entry holds until the next entry of the same
pattern: dated entries become validity intervals [valid_from, valid_to). A capture is evaluated against the entries
active when it was fetched: its host and every parent domain are joined with the list's patterns, the interval is
tested, and the longest active pattern decides.

Suffixes of more labels than the list's deepest pattern can match nothing and are not made; that depth is the list's own.
Captures are first counted by (host, day): suffixes are made once a host and dealt over salts, as half of all hosts may
end in one listed pattern; a (host, day) of more than ``hot_rows`` captures gets copies of its verdict over salts.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import materialize, same_columns

ENTRY_SCHEMA = T.StructType([T.StructField("pattern", T.StringType()), T.StructField("entry_date", T.DateType()), T.StructField("action", T.StringType())])
OPEN_END = "9999-12-31"
#: Ways in which a pattern's hosts are dealt, and captures of a (host, day) from which its verdict is.
SALTS = 16
HOT_ROWS = 200_000


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and final dot; empty if the URL has none."""
    authority = F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    return F.lower(F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r"\.?(:[0-9]*)?$", ""))


def host_patterns(host: Column, depth: Column | int | None = None) -> Column:
    """The host and its parent domains, of at most depth labels (all if None), each once."""
    labels = F.split(host, r"\.")
    n = F.size(labels) if depth is None else F.least(F.size(labels), F.lit(depth) if isinstance(depth, int) else depth)
    return F.array_distinct(F.transform(F.sequence(F.lit(1), n), lambda k: F.array_join(F.slice(labels, -k, k), ".")))


def validity_intervals(entries: DataFrame) -> DataFrame:
    """(pattern, action, valid_from, valid_to): each entry holds until its pattern's next.

    Of entries of a pattern on one date the greatest action word counts; entries without pattern or date are void.
    """
    one = entries.where("pattern IS NOT NULL AND pattern <> '' AND entry_date IS NOT NULL").groupBy(F.lower("pattern").alias("pattern"), "entry_date").agg(F.max("action").alias("action"))
    after = F.lead("entry_date").over(Window.partitionBy("pattern").orderBy("entry_date"))
    return one.select("pattern", "action", F.col("entry_date").alias("valid_from"), F.coalesce(after, F.lit(OPEN_END).cast("date")).alias("valid_to"))


def _hits(asked: DataFrame, entries: DataFrame) -> DataFrame:
    """(host, day, hit): of the entries active on a day, that of the longest pattern. asked: distinct (host, day)."""
    spans = materialize(validity_intervals(entries), "list-intervals")
    depth = spans.agg(F.max(F.size(F.split("pattern", r"\."))).alias("d")).first()["d"]
    if depth is None:
        return asked.select("host", "day", F.lit(None).cast("struct<size:int,pattern:string,action:string,valid_from:date>").alias("hit")).where(F.lit(False))
    hosts = asked.select("host").distinct()
    keys = hosts.select("host", F.explode(host_patterns(F.col("host"), int(depth))).alias("pattern")).withColumn("salt", F.pmod(F.xxhash64("host"), F.lit(SALTS)).cast("int"))
    dealt = spans.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    listed = keys.join(dealt, ["pattern", "salt"]).drop("salt")
    active = asked.join(listed, "host").where("valid_from <= day AND day < valid_to")
    return active.groupBy("host", "day").agg(F.max(F.struct(F.length("pattern").alias("size"), "pattern", "action", "valid_from")).alias("hit"))


def evaluate(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched_on", hot_rows: int = HOT_ROWS) -> DataFrame:
    """captures' columns as struct __row, with host, day, pattern, action and valid_from of the deciding entry (else null).

    The longest active pattern decides. Captures without URL, host or fetch date match nothing and stay; repeated rows
    each get a row; an empty table or list gives an empty table or no match; columns of any name stay as they are.
    """
    rows = captures.select(F.struct(*[F.col(f"`{c}`") for c in captures.columns]).alias("__row"), host_of(F.col(f"`{url}`")).alias("host"), F.col(f"`{fetched}`").cast("date").alias("day"))
    asked = materialize(rows.select("host", "day").where("host <> '' AND day IS NOT NULL").groupBy("host", "day").agg(F.count("*").alias("n")), "captures-by-day")
    salts = F.when(F.col("n") > hot_rows, F.ceil(F.col("n") / hot_rows)).otherwise(1).cast("int")
    verdict = _hits(asked.select("host", "day"), entries).join(asked.select("host", "day", salts.alias("salts")), ["host", "day"])
    hot = asked.where(F.col("n") > hot_rows).select("host", "day", salts.alias("salts"))  # one of hot_rows captures at most
    dealt = rows.join(F.broadcast(hot), ["host", "day"], "left")
    whole = F.xxhash64(*[F.col(f"__row.`{c}`") for c, kind in captures.dtypes if "map<" not in kind and "variant" not in kind])  # maps have no hash
    dealt = dealt.withColumn("salt", F.when(F.col("salts").isNull(), 0).otherwise(F.pmod(whole, F.col("salts"))).cast("int")).drop("salts")
    spread = verdict.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
    out = dealt.join(spread, ["host", "day", "salt"], "left")
    return out.select("__row", "host", "day", F.col("hit.pattern").alias("pattern"), F.col("hit.action").alias("action"), F.col("hit.valid_from").alias("valid_from"))


def filter_captures(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched_on") -> DataFrame:
    """captures whose deciding entry is not a block, all columns as they were."""
    return same_columns(evaluate(captures, entries, url, fetched).where("NOT (action <=> 'block')").select("__row.*"), captures)


# The synthetic pages carry neither fetch dates nor a list. The query dates both by md5, alike in Spark and DuckDB: a page's
# fetch day from its page_id, and for each domain of the table a listing day and, for half of them, a later release.
_START, _DAYS = "2024-01-01", 360


def _digits(col: Column, at: int) -> Column:
    return F.conv(F.substring(F.md5(col), at, 4), 16, 10).cast("int")


def dated_captures(pages: DataFrame) -> DataFrame:
    day = F.date_add(F.lit(_START).cast("date"), _digits(F.col("page_id").cast("string"), 1) % _DAYS)
    return pages.select("page_id", "url", day.alias("fetched_on"))


def dated_entries(pages: DataFrame) -> DataFrame:
    """Entries for a third of the hosts and parent domains of two or more labels."""
    names = pages.select(host_of(F.col("url")).alias("host")).distinct().select(F.explode(host_patterns(F.col("host"))).alias("pattern")).where(F.col("pattern").contains(".")).distinct()
    listed = names.where(_digits(F.col("pattern"), 1) % 3 == 0)
    start = F.date_add(F.lit(_START).cast("date"), _digits(F.col("pattern"), 5) % _DAYS)
    block = listed.select("pattern", start.alias("entry_date"), F.lit("block").alias("action"))
    allow = listed.where(_digits(F.col("pattern"), 9) % 2 == 0).select("pattern", F.date_add(start, 1 + _digits(F.col("pattern"), 13) % 90).alias("entry_date"), F.lit("allow").alias("action"))
    return block.unionByName(allow)


def report(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Columns of op10: page_id, host, fetched_on, pattern, action, valid_from, kept; nulls and repeats as evaluate() says."""
    entries = materialize(dated_entries(pages), "list-entries")
    out = evaluate(dated_captures(pages), entries)
    return out.select(F.col("__row.page_id").alias("page_id"), "host", F.col("day").alias("fetched_on"), "pattern", "action", "valid_from", (~F.col("action").eqNullSafe("block")).alias("kept"))


_MD5 = "('0x' || substr(md5({0}), {1}, 4))::INT"
ORACLE_SQL = f"""
WITH page AS (SELECT page_id, lower(regexp_replace(regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '^.*@', ''), '\\.?(:[0-9]*)?$', '')) AS host,
        DATE '{_START}' + ({_MD5.format('page_id::VARCHAR', 1)} % {_DAYS})::INT AS fetched_on FROM pages),
host AS (SELECT DISTINCT host, string_split(host, '.') AS l FROM page),
tail AS (SELECT host, array_to_string(l[len(l) - k + 1:], '.') AS pattern FROM (SELECT host, l, unnest(range(1, len(l) + 1)) AS k FROM host)),
name AS (SELECT host, pattern FROM tail UNION SELECT host, host FROM host),
listed AS (SELECT DISTINCT pattern, DATE '{_START}' + ({_MD5.format('pattern', 5)} % {_DAYS})::INT AS d FROM name WHERE contains(pattern, '.') AND {_MD5.format('pattern', 1)} % 3 = 0),
entry AS (SELECT pattern, d, 'block' AS action FROM listed UNION ALL
          SELECT pattern, d + (1 + {_MD5.format('pattern', 13)} % 90)::INT, 'allow' FROM listed WHERE {_MD5.format('pattern', 9)} % 2 = 0),
span AS (SELECT pattern, action, d AS valid_from, coalesce(lead(d) OVER (PARTITION BY pattern ORDER BY d), DATE '{OPEN_END}') AS valid_to FROM entry),
hit AS (SELECT page_id, s.pattern, s.action, s.valid_from, row_number() OVER (PARTITION BY page_id ORDER BY length(s.pattern) DESC, s.pattern DESC) AS k
        FROM page JOIN name USING (host) JOIN span s ON s.pattern = name.pattern AND s.valid_from <= fetched_on AND fetched_on < s.valid_to)
SELECT page_id, host, fetched_on, pattern, action, valid_from, coalesce(action, '') <> 'block' AS kept
FROM page LEFT JOIN (SELECT * FROM hit WHERE k = 1) USING (page_id)
"""
