"""URL filters as a temporal list join.

List entries are dated events: an entry is added or removed. Per entry they become validity intervals, from an addition to the
next event. A capture asks for its host, all domains above it and all path prefixes, and an as-of join gives it, of each list
that knows one of those, the interval that began last before the fetch, if it still holds. The most specific active entry
decides.

The as-of join is a sorted union: intervals and questions of one entry in the order of time, each question taking the last
interval before it. So a question meets one interval of an entry, however many the entry has. Questions are reduced to distinct
(entry, time) first. An entry that a third of all captures ask for is split by minute: a first pass over the distinct minutes
carries the interval that holds at the start of each minute into it, a second one answers inside the minutes. Ten years have
some five million minutes, which bounds the rows of an entry in the first pass, however many its captures. Answers go back to
the captures by (entry, time).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.plans.staging import Scratch

#: More specific kinds decide first.
RANK = {"prefix": 3, "host": 2, "domain": 1}


def validity_intervals(events: DataFrame) -> DataFrame:
    """(list, kind, value, verdict, since, until) from events (list, kind, value, verdict, action, since).

    An addition holds until the next event of the same list, kind and value, or for good (until null). Of events at one
    time, a removal comes last and of several additions the one with the greatest verdict holds; repeated events are one.
    Events with a null in any column but list say nothing and are left out; a null list is a list of its own.
    """
    known = events.select("list", "kind", "value", "verdict", "action", "since")
    known = known.dropna(subset=["kind", "value", "verdict", "action", "since"]).distinct()
    along = Window.partitionBy("list", "kind", "value").orderBy("since", F.col("action") == "remove", "verdict")
    held = known.withColumn("until", F.lead("since").over(along))
    return held.filter("action = 'add' and (until is null or until > since)").drop("action")


def host_of(url: Column) -> Column:
    """The lower-case host of an absolute URL, without user and port; empty if there is none."""
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1))
    return F.regexp_replace(host, r"\.$", "")


def _keys(url: Column, host: Column) -> Column:
    """All (kind, value) that a list may know the URL by; none without a host."""
    labels = F.split(host, r"\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.struct(F.lit("domain").alias("kind"), F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("value")),
    )
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*/?([^?#]*)", 1)
    steps = F.filter(F.split(path, "/"), lambda s: s != "")
    prefixes = F.transform(
        F.sequence(F.lit(1), F.size(steps)),
        lambda i: F.struct(
            F.lit("prefix").alias("kind"),
            F.concat_ws("/", host, F.array_join(F.slice(steps, F.lit(1), i), "/")).alias("value"),
        ),
    )
    none = F.array().cast("array<struct<kind:string,value:string>>")
    own = F.array(F.struct(F.lit("host").alias("kind"), host.alias("value")))
    prefixes = F.when(F.size(steps) > 0, prefixes).otherwise(none)
    return F.when(host != "", F.concat(own, domains, prefixes)).otherwise(none)


def as_of(asked: DataFrame, intervals: DataFrame) -> DataFrame:
    """(kind, value, at, list, verdict) of every interval that holds at a question (kind, value, at); questions are distinct."""
    entry = ["list", "kind", "value"]
    lists = intervals.select(*entry).distinct()
    # dates count as their midnights
    asked = asked.join(lists.hint("merge"), ["kind", "value"]).select(*entry, "at", F.col("at").cast("timestamp").alias("time"))
    asked = asked.withColumn("minute", F.date_trunc("minute", "time"))
    times = [F.col(c).cast("timestamp").alias(c) for c in ("since", "until")]
    begun = intervals.select(*entry, F.struct(*times, "verdict").alias("now")).withColumn("minute", F.date_trunc("minute", "now.since"))

    def answered(questions: DataFrame, starts: DataFrame, by: list[str], order: list) -> DataFrame:
        """Questions with the last start before or at them, by a sorted union."""
        none = F.lit(None).cast(starts.schema["now"].dataType).alias("now")
        both = starts.withColumn("asks", F.lit(False)).unionByName(questions.select("*", none).withColumn("asks", F.lit(True)), allowMissingColumns=True)
        along = Window.partitionBy(*by).orderBy(*order, "asks").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return both.withColumn("now", F.last("now", ignorenulls=True).over(along)).filter("asks").drop("asks")

    # of one minute, the interval that began last is carried on; a minute's own ones come after its start
    last = begun.groupBy(*entry, "minute").agg(F.max_by("now", "now.since").alias("now"))
    following = last.withColumn("minute", F.col("minute") + F.expr("interval 1 minute"))
    carried = answered(asked.select(*entry, "minute").distinct(), following, entry, ["minute"])
    starts = carried.filter("now is not null").select(*entry, "minute", "now", F.lit(None).cast("timestamp").alias("time"))
    inside = begun.join(asked.select(*entry, "minute").distinct(), [*entry, "minute"], "left_semi").withColumn("time", F.col("now.since"))
    found = answered(asked, starts.unionByName(inside.select(*starts.columns)), [*entry, "minute"], [F.col("time").asc_nulls_first()])
    holds = F.col("now.until").isNull() | (F.col("time") < F.col("now.until"))
    return found.filter(F.col("now").isNotNull() & holds).select("kind", "value", "at", "list", "now.verdict")


def filter_urls(captures: DataFrame, events: DataFrame, url_col: str = "url", time_col: str = "fetched") -> DataFrame:
    """All columns of ``captures`` and url_host, n_active, verdict, rule.

    n_active counts the entries of all lists active at the fetch. The verdict is that of the most specific one: path
    prefix, host, domain; then the longest value; then the least verdict by name, so that allow beats block; it is
    ``none`` where no entry is active, as for null or relative URLs and null times. rule is the deciding ``kind:value``, or
    empty. A null list is a list of its own. Repeated captures get a row each. Empty tables on either side work. Columns of
    these four names are replaced; others may have any name.
    """
    scratch = Scratch(captures.sparkSession, "url-filter")
    intervals = validity_intervals(events).withColumn("list", F.struct(F.col("list").alias("name")))  # never null
    intervals = scratch.write(intervals, "intervals")
    rest = captures.drop("url_host", "n_active", "verdict", "rule")
    keyed = rest.select(F.struct(*rest.columns).alias("row"), F.col(url_col).alias("url"), F.col(time_col).alias("at"))
    asked = keyed.select("url", "at").dropna().distinct().withColumn("host", host_of(F.col("url")))
    asked = scratch.write(asked.select("url", "at", F.explode(_keys(F.col("url"), F.col("host"))).alias("key")).select("url", "at", "key.*"), "asked")
    active = as_of(asked.select("kind", "value", "at").distinct(), intervals)
    rank = F.create_map(*[F.lit(x) for pair in RANK.items() for x in pair])[F.col("kind")]
    best = F.struct((-rank).alias("r"), (-F.length("value")).alias("l"), "verdict", "kind", "value")
    answers = active.groupBy("kind", "value", "at").agg(F.count(F.lit(1)).alias("n"), F.min(best).alias("best"))
    answers = scratch.write(answers, "answers")
    judged = asked.join(answers.hint("merge"), ["kind", "value", "at"]).groupBy("url", "at").agg(F.sum("n").alias("n"), F.min("best").alias("best"))
    joined = keyed.join(judged.hint("merge"), ["url", "at"], "left")
    return joined.select(
        *[F.col("row")[c].alias(c) for c in rest.columns],
        host_of(F.col("url")).alias("url_host"),
        F.coalesce("n", F.lit(0)).alias("n_active"),
        F.coalesce("best.verdict", F.lit("none")).alias("verdict"),
        F.coalesce(F.concat_ws(":", "best.kind", "best.value"), F.lit("")).alias("rule"),
    )
