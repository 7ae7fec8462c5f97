"""URL filters as a temporal list join.

List entries are dated: a key (a host, a parent domain, or a host with the first segments of a path)
is added to or removed from a list on a day. Entries become validity intervals, and every capture is
evaluated against the entries that were active on the day it was fetched. The longest active key
decides; if a block and an allow list hold it, block wins. Without an active key a capture is allowed.

An add that repeats an add, or a remove without an add, changes nothing; of entries on the same day the
remove wins. Entries with a null list, kind, key, action or day are left out, as are unknown actions.
A capture with a null URL, host or day is allowed. Each capture is a row, also where ids repeat or are null;
verdicts follow from URL and day alone. Only the columns named below are read. A URL gets keys of as many path segments as the longest key of the entries has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def host(url: Column) -> Column:
    """Lower-case host of a URL without user and port; empty if there is none."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def keys(url: Column, most: int) -> Column:
    """All keys that can match a URL: its host, the parent domains, the host with up to ``most`` path segments."""
    name, labels = host(url), F.split(host(url), r"\.")
    segments = F.filter(F.split(path(url), "/"), lambda s: s != "")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    count = F.least(F.size(segments), F.lit(most))
    paths = F.when(count > 0, F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), lambda i: F.concat_ws("/", name, F.array_join(F.slice(segments, 1, i), "/"))))
    return F.when(name != "", F.array_distinct(F.concat(domains, F.coalesce(paths, F.array().cast("array<string>")))))


def intervals(entries: DataFrame) -> DataFrame:
    """(kind, list, key, since, until): when a key is on a list; ``until`` is null while it lasts.

    ``entries``: list, kind (block or allow), key, action (add or remove), on_day. A key has one entry
    a day and list at most after the first aggregation, so a window holds no more rows than days.
    """
    sound = entries.where("list is not null and kind in ('allow', 'block') and key is not null and action in ('add', 'remove') and on_day is not null")
    daily = sound.groupBy("kind", "list", "key", "on_day").agg(F.max("action").alias("action"))
    order = Window.partitionBy("kind", "list", "key").orderBy("on_day")
    changes = daily.withColumn("_before", F.coalesce(F.lag("action").over(order), F.lit("remove"))).where("action <> _before")
    return changes.withColumn("until", F.lead("on_day").over(order)).where("action = 'add'").select("kind", "list", "key", F.col("on_day").alias("since"), "until")


def verdicts(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """(capture_id, blocked, n_active, decided_by) of every capture.

    ``captures``: capture_id, url, fetched_on. Each distinct (key, day) is looked up once, so a host
    with a third of all captures costs one lookup a day; each distinct (URL, day) is judged once, and only keys
    that are found go on. Captures then pick up their verdict.
    """
    active = intervals(entries)
    most = entries.agg(F.max(F.size(F.split("key", "/")) - 1).alias("n")).first().n or 0
    captures = captures.select("capture_id", "url", "fetched_on")
    judged = captures.where("url is not null and fetched_on is not null").select("url", "fetched_on").distinct()
    asked = judged.select("url", "fetched_on", F.explode(keys(F.col("url"), most)).alias("key"))
    probes = asked.select("key", "fetched_on").distinct()
    current = (F.col("since") <= F.col("fetched_on")) & (F.col("until").isNull() | (F.col("fetched_on") < F.col("until")))
    found = probes.join(active, "key").where(current).groupBy("key", "fetched_on")
    found = found.agg(F.count(F.lit(1)).alias("n"), F.max(F.col("kind") == "block").alias("blocked"))
    rank = F.struct(F.length("key").alias("size"), F.col("blocked"), F.col("key"))
    rows = asked.join(found, ["key", "fetched_on"])
    best = rows.groupBy("url", "fetched_on").agg(F.max(rank).alias("best"), F.sum("n").alias("n_active"))
    whole = captures.join(best, ["url", "fetched_on"], "left")
    return whole.select("capture_id", F.coalesce("best.blocked", F.lit(False)).alias("blocked"), F.coalesce("n_active", F.lit(0)).alias("n_active"), F.col("best.key").alias("decided_by"))
