"""Benchmark decontamination by a broadcast hash set of normalised n-grams.

Words are lower-cased runs of letters and digits. The windows of the benchmark items go, in blocks of a bounded number of
windows, to every executor as sorted arrays of hashes; each task rolls the same windows over its documents, looks them up
behind a small presence table, and compares the words themselves before it calls a window hit. One block is one pass over
the documents, so that what is broadcast stays bounded however large the benchmark is; with several blocks the hits of a
document are joined up afterwards.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import textkernel as tk
from millrace.llm.common import merged_spans, row_key
from millrace.plans.staging import Scratch, if_small

#: Windows of one broadcast block. With the words for verification, about 150 bytes each.
BLOCK_WINDOWS = 200_000
_TABLE_BITS = 22
_SPANS = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))


class WindowSet:
    """The windows of one block of items: by length, sorted hashes with the items and the words of each."""

    def __init__(self, items: list[tuple[str, bytes]], size: int):
        found: dict[int, dict[int, dict[bytes, set[str]]]] = {}
        for item, text in items:
            w = tk.words_of(np.frombuffer(text, np.uint8), np.array([0, len(text)]), tk.ALNUM, lower=True)
            n = w.count(0)
            if n:
                length = min(size, n)
                raw = w.raw(0, n)
                for i, h in enumerate(tk.windows_of(w.hashes, length)):
                    at = found.setdefault(length, {}).setdefault(int(h), {})
                    at.setdefault(b" ".join(raw[i : i + length]), set()).add(item)
        self.entries = found
        self.sorted = {length: np.array(sorted(at), np.uint64) for length, at in found.items()}
        self.present = {}
        for length, hashes in self.sorted.items():
            table = np.zeros(1 << _TABLE_BITS, bool)
            table[hashes >> np.uint64(64 - _TABLE_BITS)] = True
            self.present[length] = table

    def hits(self, w: tk.Words) -> list[tuple[int, int, set[str]]]:
        """(first word, word after the last, items) of every window of the texts that is in the set."""
        out = []
        if not len(w.hashes):
            return out
        stop = tk.owner_ends(w)
        for length, hashes in self.sorted.items():
            g = tk.windows_of(w.hashes, length)
            at = np.flatnonzero(self.present[length][g >> np.uint64(64 - _TABLE_BITS)])
            at = at[at + length <= stop[at]]
            near = np.minimum(np.searchsorted(hashes, g[at]), len(hashes) - 1)
            for i in at[hashes[near] == g[at]]:
                items = self.entries[length][int(g[i])].get(b" ".join(w.raw(i, i + length)))
                if items:
                    out.append((int(i), int(i) + length, items))
        return out


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, size: int, limit: int) -> Iterator[list[tuple[str, bytes]]]:
    """The items, a bounded number of windows at a time; the driver holds one block."""
    block, windows = [], 0
    rows = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")), F.col(text_col).cast("string"))
    for item, text in rows.toLocalIterator():
        text = (text or "").encode()
        block.append((item, text))
        windows += max(1, len(text) // 4)
        if windows >= limit:
            yield block
            block, windows = [], 0
    if block:
        yield block


def find_windows(
    docs: DataFrame, benchmark: DataFrame, id_col="doc_id", text_col="text", item_col="item_id", item_text_col="text",
    size: int = 10, block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_hit, items (sorted strings).

    A word is hit if a window of ``size`` words that a benchmark item also has covers it; an item of fewer words, but not
    none, is one window. Null and empty texts, of documents or items, have no words. A null item id counts as the empty
    string, and rows that repeat an item id are one item. Repeated document rows are reported each. Empty tables on
    either side give no hits. Other columns are ignored.
    """
    spark = docs.sparkSession
    schema = "_k1 long, _k2 long, _id {}, n_words long, spans array<struct<a:int,b:int>>, items array<string>"
    schema = schema.format(docs.schema[id_col].dataType.simpleString())
    source = docs.select(*row_key(id_col, text_col), F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    parts = []
    for block in _blocks(benchmark, item_col, item_text_col, size, block_windows):
        sent = spark.sparkContext.broadcast(WindowSet(block, size))
        parts.append(source.mapInArrow(_scan(sent), schema))
    if not parts:
        parts.append(source.mapInArrow(_scan(None), schema))
    if len(parts) == 1:
        hits = parts[0].select("_id", "n_words", F.col("spans").alias("_spans"), "items")
    else:
        # the rows that agree in id and text agree in their hits
        scratch = Scratch(spark, "decontaminate")
        first = scratch.write(parts[0], "block").select("_k1", "_k2", "_id", "n_words", "spans", "items")
        more = [scratch.write(p.filter(F.size("spans") > 0), "block").select("_k1", "_k2", "spans", "items") for p in parts[1:]]
        rest = more[0]
        for m in more[1:]:
            rest = rest.unionByName(m)
        rest = rest.groupBy("_k1", "_k2").agg(
            F.flatten(F.collect_set("spans")).alias("_spans"), F.flatten(F.collect_set("items")).alias("_items")
        )
        empty = F.array().cast("array<string>")
        hits = first.join(rest, ["_k1", "_k2"], "left").select(
            "_id",
            "n_words",
            F.concat("spans", F.coalesce("_spans", F.array().cast("array<struct<a:int,b:int>>"))).alias("_spans"),
            F.array_sort(F.array_distinct(F.concat("items", F.coalesce("_items", empty)))).alias("items"),
        )
    # spans of one block are disjoint; those of several blocks may overlap
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("upto"))
    hit = F.aggregate(
        F.array_sort("_spans"),
        start,
        lambda s, p: F.struct(
            (s["n"] + F.greatest(p["b"] - F.greatest(p["a"], s["upto"]), F.lit(0))).alias("n"),
            F.greatest(s["upto"], p["b"]).alias("upto"),
        ),
        lambda s: s["n"],
    )
    return hits.select(F.col("_id").alias(id_col), "n_words", hit.alias("n_hit"), "items")


def _merged(hits: list[tuple[int, int, set[str]]]) -> list[list[int]]:
    spans: list[list[int]] = []
    for a, b, _ in sorted(hits, key=lambda h: h[:2]):
        if spans and a <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], b)
        else:
            spans.append([a, b])
    return spans


def _per_text(w: tk.Words, hits: list) -> dict[int, list]:
    """Hits by text, with word numbers that start at 0 in each text."""
    by: dict[int, list] = {}
    if hits:
        owners = np.searchsorted(w.first, [h[0] for h in hits], "right") - 1
        for i, (a, b, items) in zip(owners.tolist(), hits, strict=True):
            base = int(w.first[i])
            by.setdefault(i, []).append((a - base, b - base, items))
    return by


def _scan(sent):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in tk.pieces(batches, "_text"):
            w = tk.words_of_column(piece.column("_text"), tk.ALNUM, lower=True)
            by = _per_text(w, sent.value.hits(w) if sent else [])
            spans, items = [], []
            for i in range(piece.num_rows):
                own = by.get(i, [])
                spans.append([{"a": a, "b": b} for a, b in _merged(own)])
                items.append(sorted({x for h in own for x in h[2]}))
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("_k1"), piece.column("_k2"), piece.column("_id"),
                    pa.array(np.diff(w.first), pa.int64()), pa.array(spans, _SPANS),
                    pa.array(items, pa.list_(pa.string())),
                ],
                names=["_k1", "_k2", "_id", "n_words", "spans", "items"],
            )

    return scan


def remove_windows(
    docs: DataFrame, benchmark: DataFrame, text_col="text", item_col="item_id", item_text_col="text", size: int = 10,
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """The rows of ``docs``, all columns, with hit spans cut out of their texts.

    A span, from its first to its last word, becomes one line break; the rest of the text is untouched, and so are texts
    without a hit, null and empty ones included. Texts are scanned again until no window of the benchmark is left, in case
    a cut joins words up. The result does not depend on ``block_windows``. Ids are not looked at, so null and repeated ones make
    no difference; repeated rows are cut alike, and items that repeat or tie are one window. An empty benchmark cuts nothing, an
    empty table gives no rows. Columns may have any name.
    """
    spark = docs.sparkSession
    blocks = _blocks(benchmark, item_col, item_text_col, size, block_windows)
    first = list(itertools.islice(blocks, 2))
    if not first:
        return docs
    if len(first) == 1:
        return docs.mapInArrow(_cut(spark.sparkContext.broadcast(WindowSet(first[0], size)), text_col), docs.schema)
    return _cut_by_all(docs, benchmark, text_col, item_col, item_text_col, size, block_windows)


def _cut_by_all(docs, benchmark, text_col, item_col, item_text_col, size, block_windows) -> DataFrame:
    """As ``remove_windows``, for several blocks: each round takes the spans of all blocks on one state of the texts.

    Only texts that a round has cut go into the next one; they keep the key of the text that they came from, and meet its
    rows at the end.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "decontaminate-cut")
    texts = docs.select(*_text_key(docs[text_col]), docs[text_col].alias("_text"))
    hit, done = None, []
    while True:
        found = None
        for block in _blocks(benchmark, item_col, item_text_col, size, block_windows):
            sent = spark.sparkContext.broadcast(WindowSet(block, size))
            spans = scratch.write(texts.mapInArrow(_list_spans(sent), "_k1 long, _k2 long, a int, b int"), "block")
            sent.destroy()
            found = spans if found is None else found.unionByName(spans)
        spans = scratch.write(merged_spans(found, ["_k1", "_k2"]), "spans")
        keys = spans.select("_k1", "_k2")
        if hit is None:
            hit = keys
        else:
            done.append(texts.join(keys, ["_k1", "_k2"], "left_anti"))
        if not spans.head(1):
            break
        cut = texts.join(if_small(keys), ["_k1", "_k2"], "left_semi").dropDuplicates(["_k1", "_k2"]).join(spans, ["_k1", "_k2"])
        texts = scratch.write(cut.mapInArrow(_cut_spans, "_k1 long, _k2 long, _text string"), "cut")
    if not done:
        return docs
    whole = done[0]
    for d in done[1:]:
        whole = whole.unionByName(d)
    whole, hit = whole.withColumnRenamed("_text", "_cut"), if_small(hit)

    def same(right: DataFrame) -> Column:
        k1, k2 = _text_key(docs[text_col])
        return (k1 == right["_k1"]) & (k2 == right["_k2"])

    touched = docs.join(hit, same(hit), "left_semi").join(whole, same(whole))
    columns = [whole["_cut"].cast(docs.schema[c].dataType).alias(c) if c == text_col else docs[c] for c in docs.columns]
    return docs.join(hit, same(hit), "left_anti").unionByName(touched.select(*columns))


def _text_key(text: Column) -> list[Column]:
    """Two 64-bit columns that tell texts apart."""
    return [F.xxhash64(text).alias("_k1"), F.xxhash64(F.lit("text"), text).alias("_k2")]


def _list_spans(sent):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in tk.pieces(batches, "_text"):
            w = tk.words_of_column(piece.column("_text"), tk.ALNUM, lower=True)
            by = _per_text(w, sent.value.hits(w))
            rows = [(i, a, b) for i in sorted(by) for a, b in _merged(by[i])]
            at, first, last = zip(*rows, strict=True) if rows else ((), (), ())
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("_k1").take(at), piece.column("_k2").take(at),
                    pa.array(first, pa.int32()), pa.array(last, pa.int32()),
                ],
                names=["_k1", "_k2", "a", "b"],
            )

    return scan


def _cut_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in tk.pieces(batches, "_text"):
        w = tk.words_of_column(piece.column("_text"), tk.ALNUM, lower=True)
        data, offsets = tk.buffers(tk.text_array(piece.column("_text")))
        spans = piece.column("spans").to_pylist()
        texts = [_without(data, offsets, w, i, [(s["a"], s["b"]) for s in own]) for i, own in enumerate(spans)]
        yield pa.RecordBatch.from_arrays(
            [piece.column("_k1"), piece.column("_k2"), pa.array(texts, pa.string())], names=["_k1", "_k2", "_text"]
        )


def _without(data: np.ndarray, offsets: np.ndarray, w: tk.Words, i: int, spans) -> str:
    """The i-th text with a line break for each of its disjoint spans of words."""
    first, kept, last = int(w.first[i]), [], int(offsets[i])
    for a, b in spans:
        kept.append(data[last : w.start[first + a]].tobytes())
        last = int(w.end[first + b - 1])
    kept.append(data[last : int(offsets[i + 1])].tobytes())
    return b"\n".join(kept).decode()


def _cut(sent, text_col: str):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in tk.pieces(batches, text_col):
            at = piece.schema.get_field_index(text_col)
            todo, texts = list(range(piece.num_rows)), None
            column = tk.text_array(piece.column(at))
            while todo:
                w = tk.words_of_column(column, tk.ALNUM, lower=True)
                by = _per_text(w, sent.value.hits(w))
                data, offsets = tk.buffers(column)
                again = []
                for i in sorted(by):
                    texts = piece.column(at).to_pylist() if texts is None else texts
                    texts[todo[i]] = _without(data, offsets, w, i, _merged(by[i]))
                    again.append(todo[i])
                todo = again
                column = pa.array([texts[i] for i in todo], pa.string()) if todo else column
            if texts is not None:
                piece = piece.set_column(at, piece.schema.field(at), pa.array(texts, piece.schema.field(at).type))
            yield piece

    return cut
