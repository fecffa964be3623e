"""Line dedup: suffix ranks of line sequences by prefix doubling; later copies of maximal repeated line runs go.

The corpus is a suffix array over sequences of line ids. Level k of the doubling ranks the runs of ``2**k`` lines that start
at each line; a run's rank is the first place where it stands, so ranks name runs exactly, and suffixes of one rank are an
interval of the suffix array whose longest common prefix is at least ``2**k``. The interval of suffixes that share m lines,
``2**k <= m < 2**(k + 1)``, is named by the ranks of their first and of their last ``2**k`` lines.

A line goes if a maximal repeated run of ``min_words`` words or more holds it, other than at the run's first place. Take
such a run and a line in it: the run's part from that line on, or up to it, or a part around it has the words, and of
those parts the shortest is a later copy as well. So it is enough to look up two runs a line: the shortest one that starts
there and has the words, and the shortest one that ends there. The doubling stops where no such run is as long as its level;
runs of blank lines are all that takes it far.

All of it is DataFrame operations. A line or run that stands very often is one row per task before it is shuffled; joins
back to its places can be split. Nothing is gathered but the removed spans of one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import merged_spans, row_key
from millrace.plans.staging import Scratch

WORD = r"[^\x20\x09-\x0D]+"
_KEY = ["_k1", "_k2"]
_STATE = [*_KEY, "pos", "place", "from_here", "to_here"]


def _shortest(lines: str, least: int) -> tuple[Column, Column]:
    """Per line, where the shortest run with ``least`` words that starts there stops, and where the one that ends there starts.

    ``lines``: a column of (i, words) of the lines that have words. A run needs ``least`` of those at most.
    """
    start = F.struct(F.lit(0).cast("long").alias("words"), F.lit(None).cast("int").alias("i"))

    def reach(some: Column) -> Column:
        return F.aggregate(
            some, start,
            lambda s, x: F.when(s["words"] >= least, s).otherwise(F.struct((s["words"] + x["words"]).alias("words"), x["i"].alias("i"))),
            lambda s: F.when(s["words"] >= least, s["i"]),
        )

    def span(i: Column) -> Column:
        return F.slice(lines, i + 1, least)

    def back(i: Column) -> Column:
        return F.reverse(F.slice(lines, F.greatest(i + 2 - least, F.lit(1)), F.least(i + 1, F.lit(least))))

    before = lambda i: F.coalesce(F.get(lines, i - 1)["i"], F.lit(-1))
    after = lambda i, n: F.coalesce(F.get(lines, i + 1)["i"], n)
    stops = F.flatten(F.transform(lines, lambda x, i: F.array_repeat(reach(span(i)) + 1, x["i"] - before(i))))
    head = F.array_repeat(F.lit(None).cast("int"), F.coalesce(F.get(lines, F.lit(0))["i"], F.lit(0)))
    starts = F.transform(lines, lambda x, i: F.array_repeat(reach(back(i)), after(i, F.col("_n")) - x["i"]))
    return stops, F.concat(head, F.flatten(starts))


def _lines(docs: DataFrame, id_col: str, text_col: str, least: int) -> DataFrame:
    """A row per line: place, two hashes, and the lines of the shortest runs from and to it that have the words."""
    split = docs.select(*row_key(id_col, text_col), F.col(id_col).alias("_id"), F.split(F.col(text_col), "\n", -1).alias("_lines"))
    counted = F.transform("_lines", lambda x, i: F.struct(i.alias("i"), F.regexp_count(x, F.lit(WORD)).alias("words")))
    told = split.filter(F.col("_lines").isNotNull()).withColumn("_n", F.size("_lines"))
    if least < 1:
        stop, start = (F.transform("_lines", lambda x, i: i + 1), F.transform("_lines", lambda x, i: i))
    else:
        told = told.withColumn("_full", F.filter(counted, lambda x: x["words"] > 0))
        stop, start = _shortest("_full", least)
    zipped = F.arrays_zip(F.col("_lines").alias("line"), stop.alias("stop"), start.alias("start"))
    rows = told.select(*_KEY, "_id", F.posexplode(zipped).alias("pos", "_at"))
    return rows.select(
        *_KEY,
        "pos",
        F.struct(F.col("_id").isNull().alias("last"), F.col("_id").alias("id"), "_k2", "pos").alias("place"),
        (F.col("_at.stop") - F.col("pos")).alias("from_here"),
        (F.col("pos") + 1 - F.col("_at.start")).alias("to_here"),
        F.xxhash64("_at.line").alias("_h1"),
        F.xxhash64(F.lit("line"), "_at.line").alias("_h2"),
    )


def _with_first(runs: DataFrame, same: list[str], scratch: Scratch, label: str) -> DataFrame:
    """Those of the runs that stand twice or more, with their rank: the first place of any that agree in ``same``."""
    groups = runs.groupBy(*same).agg(F.count(F.lit(1)).alias("_times"), F.min("place").alias("rank"))
    groups = scratch.write(groups.filter("_times > 1").drop("_times"), f"{label}-groups")
    # always by sorting: the rows of a hot line can then be dealt to several tasks, at any size
    return runs.join(groups.hint("merge"), same)


def repeated_runs(docs: DataFrame, scratch: Scratch, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """(_k1, _k2, a, b): lines a to b of a text, later copies of runs with ``min_words`` words; all such lines are covered."""
    lines = scratch.write(_lines(docs, id_col, text_col, min_words), "lines")
    ranked = _with_first(lines, ["_h1", "_h2"], scratch, "level1").select(*_STATE, "rank")
    # rows that repeat id and text are one document
    level = scratch.write(ranked.dropDuplicates([*_KEY, "pos"]), "level1")
    scratch.release(lines)
    size = 1
    while True:
        later = level.filter((F.col("rank") != F.col("place")) & ((F.col("from_here") == size) | (F.col("to_here") == size)))
        scratch.append(later.select(*_KEY, F.col("pos").alias("a"), (F.col("pos") + size).alias("b")), "later")
        if size > 1:
            scratch.append(_between(level, size, scratch), "later")
        # only runs that are no longer than what is looked up; one that reaches over the end of its text stands once
        ahead = level.select(*_KEY, (F.col("pos") - size).alias("pos"), F.col("rank").alias("_next"), F.col("to_here").alias("_to"))
        doubled = level.withColumnRenamed("rank", "_first").drop("to_here").join(ahead, [*_KEY, "pos"])
        doubled = doubled.withColumnRenamed("_to", "to_here")
        size *= 2
        asked = [F.coalesce(F.col(c) >= size, F.lit(True)) for c in ("from_here", "to_here")]
        doubled = scratch.write(doubled.filter(asked[0] | asked[1]), f"runs{size}")
        scratch.release(level)
        if not doubled.count():
            break
        level = scratch.write(_with_first(doubled, ["_first", "_next"], scratch, f"level{size}").select(*_STATE, "rank"), f"level{size}")
        scratch.release(doubled)
    return scratch.read("later")


def _between(level: DataFrame, size: int, scratch: Scratch) -> DataFrame:
    """Later copies among the looked up runs of more than ``size`` and less than twice as many lines."""
    asked = [(F.col("pos"), F.col("from_here")), (F.col("pos") + size - F.col("to_here"), F.col("to_here"))]
    runs = [level.filter((n > size) & (n < 2 * size)).select(*_KEY, at.alias("pos"), n.alias("n")) for at, n in asked]
    runs = runs[0].unionByName(runs[1]).distinct().withColumn("_end", F.col("pos") + F.col("n") - size)
    runs = runs.join(level.select(*_KEY, "pos", "place", F.col("rank").alias("_first")), [*_KEY, "pos"])
    runs = runs.join(level.select(*_KEY, F.col("pos").alias("_end"), F.col("rank").alias("_last")), [*_KEY, "_end"])
    runs = scratch.write(runs, f"between{size}")
    later = _with_first(runs, ["n", "_first", "_last"], scratch, f"between{size}").filter("rank <> place")
    return later.select(*_KEY, F.col("pos").alias("a"), (F.col("pos") + F.col("n")).alias("b"))


def line_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 3
) -> DataFrame:
    """All columns of ``docs``, with later copies of repeated line runs cut out of the text, and n_lines, n_removed, n_runs.

    Lines end at line feeds. A line is removed if a run of lines that holds it, of any length and with at least ``min_words``
    words in all, stands at an earlier place too: in a document with a smaller id, null ids last, or earlier in the same one,
    where the two may overlap. Documents with one id are in order of a hash of their texts. Rows that repeat id and text are
    one document: they keep and lose the same lines. Null texts stay null, with no lines; an empty text is one line of no
    words. A text that loses all its lines becomes empty. n_runs counts the removed stretches of a text. An empty table gives
    no rows. Columns named like the three counts are replaced; others may have any name.
    """
    scratch = Scratch(docs.sparkSession, "line-dedup")
    spans = repeated_runs(docs, scratch, id_col, text_col, min_words)
    lists = scratch.write(merged_spans(spans, _KEY), "spans")
    rest = docs.drop("n_lines", "n_removed", "n_runs")
    keyed = rest.select(F.struct(*rest.columns).alias("_row"), *row_key(id_col, text_col))
    # one shuffle of the texts at any size: the lists grow with the corpus and are not broadcast
    joined = keyed.join(lists.hint("merge"), _KEY, "left")
    lines = F.split(F.col("_row")[text_col], "\n", -1)
    count = F.size("spans")

    def kept_before(i):
        """The lines between span i - 1 and span i; past the last span, up to the end."""
        start = F.when(i == 0, F.lit(0)).otherwise(F.get("spans", i - 1)["b"])
        stop = F.when(i < count, F.get("spans", i)["a"]).otherwise(F.size("_lines"))
        return F.slice("_lines", start + 1, stop - start)

    kept = F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), count), kept_before)), "\n")
    removed = F.aggregate("spans", F.lit(0), lambda n, s: n + s["b"] - s["a"])
    out = joined.withColumn("_lines", F.when(F.col("spans").isNotNull(), lines))
    text = F.when(F.col("spans").isNotNull(), kept).otherwise(F.col("_row")[text_col]).alias(text_col)
    return out.select(
        *[text if c == text_col else F.col("_row")[c].alias(c) for c in rest.columns],
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(removed, F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(count, F.lit(0)).cast("long").alias("n_runs"),
    )
