"""URL filters by a temporal list join.

List entries are dated: they are added and removed over time. Each addition becomes a validity
interval that ends with the next event of the same list and key. A capture asks with its host,
every parent domain of it and its host with the first path segment; it is evaluated against the
entries that were active when it was fetched. Intervals and captures meet by key and month, so
a key with a long history is read a month at a time, and then by the dates. An interval is laid
out over the months in which anything was fetched, and no others: an open end or a very distant
date costs nothing.

Edge cases: null or unparsable urls, and null fetch dates, match nothing; events with a null
key, date or list are ignored; of several events of a key on one day an addition wins; repeated
captures are answered each; empty captures give no rows, empty lists block nothing; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)"


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, HOST, 1))


def keys(url: Column) -> Column:
    """Host, its parent domains of two labels or more, and host/first path segment."""
    labels = F.split(host(url), r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    first = F.regexp_extract(url, PATH, 1)
    return F.when(host(url) != "", F.concat(domains, F.when(first != "", F.array(F.concat_ws("/", host(url), first))).otherwise(F.array().cast("array<string>"))))


def intervals(events: DataFrame) -> DataFrame:
    """(list, key, from, until) of (list, key, date, action 'add' or 'remove'); open ends are null."""
    known = events.where("list is not null and key is not null and date is not null and action in ('add', 'remove')")
    daily = known.groupBy("list", "key", "date").agg(F.min("action").alias("action"))  # 'add' before 'remove'
    follow = Window.partitionBy("list", "key").orderBy("date")
    return daily.withColumn("until", F.lead("date").over(follow)).where("action = 'add'").select("list", "key", F.col("date").alias("from"), "until")


def evaluate(captures: DataFrame, events: DataFrame) -> DataFrame:
    """Per row of (id, url, fetched): id, url, fetched, lists (that held it then), n_entries, blocked."""
    captures = captures.select("id", "url", "fetched")
    month = F.trunc("fetched", "month").alias("month")
    months = captures.where("fetched is not null").agg(F.sort_array(F.collect_set(month)).alias("months"))  # one row; the calendar bounds it
    held = F.filter("months", lambda m: (m >= F.trunc("from", "month")) & (F.col("until").isNull() | (m < F.col("until"))))
    active = intervals(events).where(F.col("until").isNull() | (F.col("from") < F.col("until"))).join(F.broadcast(months)).withColumn("month", F.explode(held)).drop("months")
    asked = captures.where("url is not null and fetched is not null").distinct()
    asked = asked.select("id", "url", "fetched", month, F.explode(keys(F.col("url"))).alias("key"))
    met = asked.join(active, ["key", "month"]).where((F.col("fetched") >= F.col("from")) & (F.col("until").isNull() | (F.col("fetched") < F.col("until"))))
    verdict = met.groupBy("id", "url", "fetched").agg(F.array_join(F.array_sort(F.collect_set("list")), ",").alias("lists"), F.count("*").alias("n_entries"))
    same = [F.col(f"c.{c}").eqNullSafe(F.col(f"v.{c}")) for c in ("id", "url", "fetched")]
    out = captures.alias("c").join(verdict.alias("v"), same, "left")
    return out.select("c.id", "c.url", "c.fetched", F.coalesce("lists", F.lit("")).alias("lists"), F.coalesce("n_entries", F.lit(0)).cast("long").alias("n_entries"), F.col("n_entries").isNotNull().alias("blocked"))
