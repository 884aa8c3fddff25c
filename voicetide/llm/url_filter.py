"""Temporal list join: which list entries were active when a capture was fetched.

A list is a log of dated entries: from ``effective_at`` on, ``domain`` (and what
lies below it) is blocked, allowed, or off the list.  An entry holds until the
next one of the same list and domain, so the log becomes validity intervals.  A
capture is judged by the entries that were active at its fetch time: in each
list the most specific listed domain above its host counts, and the capture is
blocked if any list blocks it.

Everything is DataFrame code.  The verdict depends on host and fetch time only,
so captures are reduced to those before the join.  Intervals and captures meet
in equal periods of ``PERIOD_DAYS``, which keeps a domain with a long history
from meeting all of its captures; a long history is ordered period by period.  The
captures below a busy domain (``com``) in one period are dealt over many tasks.

Defined results.  Null or unreadable url, or no fetch time: no entry applies.
Entries without list, domain, action or date are ignored.  Entries of one list,
domain and date: block goes before allow before remove.  Repeated captures: the
same verdict each.  Empty tables: nothing blocked, or an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voicetide.llm.base import HOT_ROWS, dealt_join

PERIOD_DAYS = 30
#: Actions by precedence among entries of the same date.
ACTIONS = ("remove", "allow", "block")
REMOVE, ALLOW, BLOCK = range(3)

HOST = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def host(url: Column) -> Column:
    """The host of a URL in lower case, null if there is none."""
    found = F.regexp_extract(F.lower(F.trim(url)), HOST, 1)
    return F.nullif(F.rtrim(found, F.lit(".")), F.lit(""))


def above(name: Column) -> Column:
    """A host and every domain above it."""
    labels = F.split(name, r"\.")
    n = F.size(labels)
    return F.transform(
        F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n - i + 1), ".")
    )


def period(at: Column) -> Column:
    return F.floor(F.datediff(at, F.lit("1970-01-01").cast("date")) / PERIOD_DAYS).cast("int")


def intervals(entries: DataFrame) -> DataFrame:
    """(list, domain, action code, valid_from, valid_to); an open end is null.

    The next entry is sought inside a period first, then among the first entries
    of the periods, so no domain's whole history is sorted in one task.
    """
    code = F.array_position(F.array(*map(F.lit, ACTIONS)), F.lower("action")) - 1
    log = (
        entries.select(
            F.col("list"), F.lower("domain").alias("domain"), code.alias("code"),
            F.col("effective_at").alias("valid_from"),
        )
        .filter("list IS NOT NULL AND domain IS NOT NULL AND code >= 0 AND valid_from IS NOT NULL")
        .groupBy("list", "domain", "valid_from")
        .agg(F.max("code").cast("int").alias("code"))
        .withColumn("_period", period(F.col("valid_from")))
    )
    key = ["list", "domain"]
    inside = Window.partitionBy(*key, "_period").orderBy("valid_from")
    across = Window.partitionBy(*key).orderBy("_period")
    firsts = (
        log.groupBy(*key, "_period").agg(F.min("valid_from").alias("_first"))
        .select(*key, "_period", F.lead("_first").over(across).alias("_later"))
    )
    near = log.withColumn("_next", F.lead("valid_from").over(inside))
    return near.join(firsts, [*key, "_period"]).select(
        *key, "code", "valid_from", F.coalesce("_next", "_later").alias("valid_to")
    )


def verdicts(keys: DataFrame, entries: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Per (host, fetched_at) with an active entry: lists that name it, that block it,
    and the first blocking list."""
    last = keys.agg(F.max(period(F.col("fetched_at"))).alias("_last"))
    active = intervals(entries).filter(F.col("code") != REMOVE)
    # one row with one number is attached to the intervals
    spread = (
        active.join(F.broadcast(last), F.lit(True))
        .withColumn("_from", period(F.col("valid_from")))
        .withColumn("_to", F.least(F.coalesce(period(F.col("valid_to")), "_last"), "_last"))
        .filter("_from <= _to")
        .withColumn("_period", F.explode(F.sequence("_from", "_to")))
        .select("list", "domain", "code", "valid_from", "valid_to", "_period")
    )
    asked = keys.select(
        "host", "fetched_at", period(F.col("fetched_at")).alias("_period"),
        F.explode(above(F.col("host"))).alias("domain"),
    )
    at = F.col("fetched_at")
    during = (at >= F.col("valid_from")) & (
        F.col("valid_to").isNull() | (at < F.col("valid_to"))
    )
    meet = ["domain", "_period"]
    counts = asked.groupBy(*meet).agg(F.count(F.lit(1)).alias("_n"))
    hits = dealt_join(
        asked, spread, meet, ["host", "fetched_at"], counts, hot_rows=hot_rows
    ).filter(during)
    by_list = hits.groupBy("host", "fetched_at", "list").agg(
        F.max(F.struct(F.length("domain").alias("n"), "code")).alias("_best")
    )
    blocks = F.col("_best.code") == BLOCK
    return by_list.groupBy("host", "fetched_at").agg(
        F.count(F.lit(1)).alias("n_lists"),
        F.count_if(blocks).alias("n_blocking"),
        F.min(F.when(blocks, F.col("list"))).alias("blocked_by"),
    )


def judge(captures: DataFrame, entries: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """All captures (with ``url`` and ``fetched_at``) with host and verdict added."""
    own = ("host", "n_lists", "n_blocking", "blocked_by", "blocked")
    rows = captures.drop(*own).withColumn("host", host(F.col("url").cast("string")))
    keys = rows.select("host", "fetched_at").filter(
        "host IS NOT NULL AND fetched_at IS NOT NULL"
    ).distinct()
    found = verdicts(keys, entries, hot_rows)
    return (
        rows.join(found, ["host", "fetched_at"], "left")
        .withColumn("n_lists", F.coalesce("n_lists", F.lit(0)))
        .withColumn("n_blocking", F.coalesce("n_blocking", F.lit(0)))
        .withColumn("blocked", F.col("n_blocking") > 0)
    )
