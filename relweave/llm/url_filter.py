"""URL filters by a temporal list join, in DataFrame functions only.

List entries are dated: an entry (a domain with its subdomains, or the beginning of a path) is added and
removed on given days. The dated events become validity intervals, which do not overlap within an entry.
Every capture asks with all entries that could cover it (each suffix of its host, alone and with each beginning
of its path up to as many segments as the deepest entry has) for those whose interval holds its day of fetching: an as-of join
as an equi-join with a range condition that finds one interval at most.

Captures are first reduced to distinct (host, longest path beginning, day), which combines map-side, so a host with
a third of all captures brings few rows into the join; the decision then goes back by an ordinary join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relweave.llm.exact_dedup import quoted

_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)"
_WHOLE_PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^?#]*)"


def host_of(url: Column) -> Column:
    """Lower-case host of an absolute URL without user, port and trailing dot; NULL where there is none."""
    host = F.lower(F.regexp_replace(F.regexp_extract(url, _HOST, 1), r"\.$", ""))
    return F.when(host != "", host)


def path_of(url: Column) -> Column:
    """First path segment, '' where there is none."""
    return F.coalesce(F.regexp_extract(url, _PATH, 1), F.lit(""))


def beginning_of(url: Column, parts: int) -> Column:
    """The first ``parts`` path segments, fewer where the path ends or has an empty one, '' where there is none."""
    segments = F.split(F.coalesce(F.regexp_extract(url, _WHOLE_PATH, 1), F.lit("")), "/")
    gap = F.array_position(segments, F.lit(""))
    filled = F.slice(segments, F.lit(1), F.when(gap > 0, gap - 1).otherwise(F.size(segments)).cast("int"))
    return F.array_join(F.slice(filled, 1, parts), "/")


def validity_intervals(events: DataFrame) -> DataFrame:
    """(entry, valid_from, valid_to) from (entry, day, added): from the day on, up to but without ``valid_to``.

    ``valid_to`` is NULL while the entry is listed. Of several events of an entry on a day, an addition
    wins. Repeated additions do not start a new interval; a removal of what is not listed does nothing.
    Events with a NULL part are ignored. An entry has at most one event a day after that, which bounds
    the rows of one window.
    """
    given = events.select(F.lower("entry").alias("entry"), F.col("day").cast("date").alias("day"), "added")
    daily = given.where("entry is not null and day is not null and added is not null")
    daily = daily.groupBy("entry", "day").agg(F.max(F.col("added").cast("int")).alias("added"))
    history = Window.partitionBy("entry").orderBy("day")
    turns = daily.withColumn("before", F.coalesce(F.lag("added").over(history), F.lit(0))).where("added <> before")
    spans = turns.withColumn("valid_to", F.lead("day").over(history)).where("added = 1")
    return spans.select("entry", F.col("day").alias("valid_from"), "valid_to")


def filter_captures(captures: DataFrame, events: DataFrame, url: str = "url", fetched: str = "fetched_on") -> DataFrame:
    """``captures`` with ``filter_host``, ``filter_blocked``, ``filter_entry``, ``filter_since``, ``filter_entries``.

    ``filter_entry`` is the longest active entry that covers the capture (of equal lengths the first by
    name), ``filter_since`` the start of its interval, ``filter_entries`` how many cover it. A NULL or
    relative URL and a NULL day match nothing; the depth of the deepest entry is read from the events first; every row comes back once, repeated rows each. Names that
    the captures have already are refused.
    """
    added = ["filter_host", "filter_blocked", "filter_entry", "filter_since", "filter_entries"]
    clash = set(added) & set(captures.columns)
    if clash:
        raise ValueError(f"the captures have columns named {sorted(clash)}")
    link = quoted(url).cast("string")
    deepest = events.agg(F.max(F.size(F.split("entry", "/")) - 1)).first()[0] or 0
    asked = captures.withColumns({
        "filter_host": host_of(link), "_path": beginning_of(link, deepest) if deepest > 0 else F.lit(""), "_day": quoted(fetched).cast("date"),
    })
    targets = asked.where("filter_host is not null and _day is not null").select("filter_host", "_path", "_day").distinct()
    labels = F.split("filter_host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    segments = F.filter(F.split(F.lower("_path"), "/"), lambda x: x != "")
    starts = F.transform(F.sequence(F.lit(0), F.size(segments)), lambda i: F.array_join(F.slice(segments, F.lit(1), i), "/"))
    covering = F.flatten(F.transform(suffixes, lambda h: F.transform(starts, lambda p: F.when(p == "", h).otherwise(F.concat_ws("/", h, p)))))
    keys = targets.select("*", F.explode(covering).alias("key"))
    spans = validity_intervals(events)
    active = (F.col("valid_from") <= F.col("_day")) & (F.col("valid_to").isNull() | (F.col("_day") < F.col("valid_to")))
    hits = keys.join(spans, (keys.key == spans.entry) & active)
    best = F.min(F.struct((-F.length("entry")).alias("rank"), "entry", "valid_from"))
    found = hits.groupBy("filter_host", "_path", "_day").agg(best.alias("best"), F.count(F.lit(1)).alias("filter_entries"))
    decided = asked.join(found, ["filter_host", "_path", "_day"], "left")
    return decided.select(
        *[quoted(c) for c in captures.columns], "filter_host", F.col("best").isNotNull().alias("filter_blocked"),
        F.col("best.entry").alias("filter_entry"), F.col("best.valid_from").alias("filter_since"),
        F.coalesce("filter_entries", F.lit(0).cast("long")).alias("filter_entries"),
    )


def dated_captures(pages: DataFrame) -> DataFrame:
    """Pages with a day of fetching derived from their id (the table has none)."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") * 7 % 366).cast("int"))
    return pages.select("page_id", "url", day.alias("fetched_on"))


def dated_list(pages: DataFrame) -> DataFrame:
    """Events of a block list derived from the pages' own hosts, parent domains and paths."""
    url = F.col("url")
    seen = pages.select("page_id", host_of(url).alias("host"), F.lower(path_of(url)).alias("path")).where("host is not null")
    hosts = seen.groupBy("host").agg(F.min("page_id").alias("lo"), F.count(F.lit(1)).alias("n"))
    parents = hosts.where("lo % 5 = 1").groupBy(F.regexp_replace("host", r"^[^.]*\.", "").alias("entry")).agg(F.max("lo").alias("lo"))
    paths = seen.where("path <> ''").groupBy("host", "path").agg(F.min("page_id").alias("lo")).where("lo % 4 = 2")

    def event(frame: DataFrame, entry: Column, days: str, added: bool) -> DataFrame:
        day = F.date_add(F.lit("2024-01-01").cast("date"), F.expr(days).cast("int"))
        return frame.select(entry.alias("entry"), day.alias("day"), F.lit(added).alias("added"))

    listed = hosts.where("lo % 3 = 1")
    return (
        event(listed, F.col("host"), "lo % 200", True)
        .union(event(listed, F.col("host"), "lo % 200 + 20 + n % 40", False))
        .union(event(listed.where("n % 2 = 1"), F.col("host"), "lo % 200 + 120", True))
        .union(event(parents, F.col("entry"), "lo % 300", True))
        .union(event(parents, F.col("entry"), "lo % 300 + 15", False))
        .union(event(paths, F.concat_ws("/", "host", "path"), "lo % 250", True))
    )


def query(spark, folder: str) -> DataFrame:
    """Decision for every page, on the day it was fetched."""
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url")
    found = filter_captures(dated_captures(pages), dated_list(pages))
    return found.withColumns({c: F.col(c).cast("string") for c in ("fetched_on", "filter_since")})


SQL = r"""
WITH seen AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST(page_id * 7 % 366 AS INTEGER) AS fetched_on,
         nullif(lower(regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1), '\.$', '')), '') AS host,
         coalesce(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)', 1)), '') AS path
  FROM pages
),
hosts AS (SELECT host, min(page_id) AS lo, count(*) AS n FROM seen WHERE host IS NOT NULL GROUP BY 1),
parents AS (SELECT regexp_replace(host, '^[^.]*\.', '') AS entry, max(lo) AS lo FROM hosts WHERE lo % 5 = 1 GROUP BY 1),
paths AS (SELECT host || '/' || path AS entry, min(page_id) AS lo FROM seen WHERE host IS NOT NULL AND path <> '' GROUP BY 1),
events AS (
  SELECT host AS entry, lo % 200 AS d, true AS added FROM hosts WHERE lo % 3 = 1
  UNION ALL SELECT host, lo % 200 + 20 + n % 40, false FROM hosts WHERE lo % 3 = 1
  UNION ALL SELECT host, lo % 200 + 120, true FROM hosts WHERE lo % 3 = 1 AND n % 2 = 1
  UNION ALL SELECT entry, lo % 300, true FROM parents
  UNION ALL SELECT entry, lo % 300 + 15, false FROM parents
  UNION ALL SELECT entry, lo % 250, true FROM paths WHERE lo % 4 = 2
),
daily AS (SELECT entry, DATE '2024-01-01' + CAST(d AS INTEGER) AS day, max(CAST(added AS INTEGER)) AS added FROM events GROUP BY ALL),
turns AS (
  SELECT * FROM (SELECT *, coalesce(lag(added) OVER (PARTITION BY entry ORDER BY day), 0) AS before FROM daily) WHERE added <> before
),
spans AS (
  SELECT entry, day AS valid_from, valid_to
  FROM (SELECT *, lead(day) OVER (PARTITION BY entry ORDER BY day) AS valid_to FROM turns) WHERE added = 1
),
hits AS (
  SELECT page_id, entry, valid_from,
         row_number() OVER (PARTITION BY page_id ORDER BY length(entry) DESC, entry) AS turn, count(*) OVER (PARTITION BY page_id) AS n
  FROM seen JOIN spans ON (host = entry OR ends_with(host, '.' || entry) OR (path <> '' AND host || '/' || path = entry))
   AND valid_from <= fetched_on AND (valid_to IS NULL OR fetched_on < valid_to)
)
SELECT s.page_id, s.url, CAST(s.fetched_on AS VARCHAR) AS fetched_on, host AS filter_host, h.entry IS NOT NULL AS filter_blocked, h.entry AS filter_entry,
       CAST(h.valid_from AS VARCHAR) AS filter_since, coalesce(h.n, 0) AS filter_entries
FROM seen s LEFT JOIN hits h ON h.page_id = s.page_id AND h.turn = 1
"""
