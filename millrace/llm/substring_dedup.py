"""Substring dedup: suffix automata over shards of reference text, matching statistics of the documents against them.

A window (``window`` consecutive words) is repeated if its words also start anywhere else. All pairs of shards and documents
would be quadratic, so shards are cut by content: each window belongs to its anchor, the leftmost least hash of its
shorter word grams. Equal windows have equal anchors, so they meet in one shard. The windows of one anchor occurrence are
consecutive and make one snippet of text, in which no window is twice.

1. One pass over the texts lists the snippets: anchor, content hash, place. Only anchors that occur twice go on.
2. Of those, an anchor whose snippets all have one content is repeated whole. Of any other, each content's words are
   read once more, and the shard of the anchor becomes a suffix automaton, with every content counted as often as it
   occurs. Streaming the contents through it gives at each word the longest match up to the window's length and how often
   that occurs: at full length and twice or more, the window is repeated.
3. The repeated spans go back to all places of their content, and each document loses the union of its spans.

A shard goes to the tasks that hold its documents, not to all: its size grows with the corpus, so nothing proves a
bound for a broadcast. The windows of an anchor with very many contents are counted natively instead, with partial sums
before the exchange: a boilerplate passage is then one row per task, whatever the number of documents that hold it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import textkernel as tk
from millrace.llm.common import merged_spans, row_key
from millrace.plans.staging import BROADCAST_BYTES, Scratch, if_small

#: Contents of one anchor up to which they share one automaton: some 50 words each.
SHARD_CONTENTS = 1_000
#: Bytes of per-document lists that may be broadcast, instead of shuffling the texts.
LIST_BYTES = 64 << 20
#: Bytes of repeated windows of hot anchors that may be broadcast.
WINDOW_BYTES = BROADCAST_BYTES


class SuffixAutomaton:
    """All substrings of some word sequences, with the number of places where each occurs."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.places = [0]

    def _state(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        self.places.append(0)
        return len(self.link) - 1

    def _split(self, p: int, word: int, q: int) -> int:
        """A state for the part of q's substrings that extend p's, in q's place on p's suffix path."""
        part = self._state(self.length[p] + 1, self.link[q], self.next[q].copy())
        self.link[q] = part
        while p != -1 and self.next[p].get(word) == q:
            self.next[p][word] = part
            p = self.link[p]
        return part

    def add(self, words: list[int], copies: int = 1) -> None:
        last = 0
        for word in words:
            q = self.next[last].get(word)
            if q is not None:
                last = q if self.length[q] == self.length[last] + 1 else self._split(last, word, q)
            else:
                p, last = last, self._state(self.length[last] + 1, 0, {})
                while p != -1 and word not in self.next[p]:
                    self.next[p][word] = last
                    p = self.link[p]
                if p != -1:
                    q = self.next[p][word]
                    self.link[last] = q if self.length[q] == self.length[p] + 1 else self._split(p, word, q)
            self.places[last] += copies

    def settle(self) -> None:
        """Sums places up the suffix links; call once, after the last add."""
        for s in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            self.places[self.link[s]] += self.places[s]

    def repeated(self, words: list[int], window: int) -> list[int]:
        """The starts of the windows of ``words`` that occur in two places or more."""
        state = matched = 0
        out = []
        for at, word in enumerate(words):
            while state and word not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            state = self.next[state].get(word, 0)
            matched = matched + 1 if state else 0
            if matched >= window:
                matched = window
                while self.length[self.link[state]] >= window:
                    state = self.link[state]
                if self.places[state] >= 2:
                    out.append(at - window + 1)
        return out


def spans_of(starts: list[int], window: int) -> list[tuple[int, int]]:
    """The union of windows at ascending starts as disjoint spans."""
    out: list[tuple[int, int]] = []
    for s in starts:
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], s + window)
        else:
            out.append((s, s + window))
    return out


def _sliding_least(values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The least value of every ``width`` consecutive ones and its leftmost place."""
    least, place, span = values, np.arange(len(values)), 1

    def joined(step: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        right = least[step : step + n] < least[:n]
        return np.where(right, least[step : step + n], least[:n]), np.where(right, place[step : step + n], place[:n])

    while span * 2 <= width:
        least, place = joined(span, len(least) - span)
        span *= 2
    return joined(width - span, len(values) - width + 1) if width > span else (least, place)


def _snippets(w: tk.Words, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """Owner, start (in its text), windows, anchor and content hash of every snippet."""
    if len(w.hashes) < window:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),) * 2
    least, place = _sliding_least(tk.windows_of(w.hashes, gram), window - gram + 1)
    stop = tk.owner_ends(w)[: len(least)]
    at = np.flatnonzero(np.arange(len(least)) + window <= stop)
    new = np.ones(len(at), bool)
    new[1:] = place[at[1:]] != place[at[:-1]]
    first = at[new]
    count = np.diff(np.append(np.flatnonzero(new), len(at)))
    up, down = tk._root_powers(max(len(w.hashes), tk.SPAN_BYTES))
    sums = np.zeros(len(w.hashes) + 1, np.uint64)
    np.cumsum(w.hashes * up[: len(w.hashes)], out=sums[1:])
    content = tk.mix((sums[first + count + window - 1] - sums[first]) * down[first])
    owner = np.searchsorted(w.first, first, "right") - 1
    return owner, first - w.first[owner], count, least[first], content


def substring_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35, gram: int = 12
) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_removed, kept_text (kept words joined by one space).

    Removed is each word that a window covers whose words also start elsewhere, in another document or the same one.
    Words are runs of anything but ASCII white space. Null and empty texts have no words; texts of fewer words than a window
    keep all. Repeated rows repeat each other's windows. An empty table gives no rows; other columns are ignored. ``gram``
    only sets how windows are dealt to shards.
    """
    spark = docs.sparkSession
    gram = max(1, min(gram, window))
    scratch = Scratch(spark, "substring-dedup")
    source = docs.select(*row_key(id_col, text_col), F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))

    def list_snippets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in tk.pieces(batches, "_text"):
            w = tk.words_of_column(piece.column("_text"))
            owner, start, count, anchor, content = _snippets(w, window, gram)
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("_k1").take(pa.array(owner)), piece.column("_k2").take(pa.array(owner)),
                    pa.array(start.astype(np.int32)), pa.array(count.astype(np.int32)),
                    pa.array(anchor.view(np.int64)), pa.array(content.view(np.int64)),
                ],
                names=["_k1", "_k2", "start", "n", "anchor", "content"],
            )

    snippets = scratch.write(
        source.drop("_id").mapInArrow(list_snippets, "_k1 long, _k2 long, start int, n int, anchor long, content long"),
        "snippets",
    )
    twice = snippets.groupBy("anchor").agg(F.count(F.lit(1)).alias("_times")).filter("_times > 1").select("anchor")
    twice = scratch.write(twice, "anchors")
    places = scratch.write(snippets.join(if_small(twice), "anchor", "left_semi"), "places")
    scratch.release(snippets, twice)

    contents = places.groupBy("anchor", "content").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct("_k1", "_k2", "start", "n")).alias("at")
    )
    contents = scratch.write(contents, "contents")
    kinds = contents.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"))
    contents = contents.join(kinds, "anchor")
    whole = contents.filter("kinds = 1").select(
        "anchor", "content", F.array(F.struct(F.lit(0).alias("a"), (F.col("at.n") + (window - 1)).alias("b"))).alias("spans")
    )

    def cut_out(some: DataFrame, label: str, split: bool, entry: str) -> DataFrame:
        """The words of the contents, from one text each."""
        wanted = some.groupBy("at._k1", "at._k2").agg(
            F.collect_list(F.struct("anchor", "content", "at.start", "at.n", "copies")).alias("wanted")
        )
        wanted = scratch.write(wanted, label)
        return _with_lists(source.drop("_id"), wanted, "inner").mapInArrow(_cut_snippets(window, split), entry)

    some = contents.filter((F.col("kinds") > 1) & (F.col("kinds") <= SHARD_CONTENTS))
    shards = cut_out(some, "wanted", False, "anchor long, content long, copies long, words binary")
    judged = shards.repartition("anchor").sortWithinPartitions("anchor", "content")
    judged = judged.mapInArrow(_judge(window), "anchor long, content long, spans array<struct<a:int,b:int>>")
    verdicts = whole.unionByName(judged)
    many = contents.filter(F.col("kinds") > SHARD_CONTENTS)
    if many.head(1):
        entry = "anchor long, content long, first int, copies long, part long, words binary"
        windows = scratch.write(cut_out(many, "wanted-windows", True, entry), "windows")
        same = ["anchor", "part", "words"]
        # a repeated row has its windows again; their copies are two or more anyway
        repeated = windows.groupBy(*same).agg(F.sum("copies").alias("_copies")).filter("_copies > 1").select(*same)
        # written first: the join then reads both sides anew, and a hot window's rows can be dealt to several tasks
        repeated = if_small(scratch.write(repeated, "repeated"), WINDOW_BYTES)
        span = F.struct(F.col("first").alias("a"), (F.col("first") + window).alias("b"))
        hot = windows.join(repeated, same, "left_semi").select("anchor", "content", F.array(span).alias("spans"))
        verdicts = verdicts.unionByName(hot)
    verdicts = scratch.write(verdicts, "verdicts")

    spans = places.join(verdicts, ["anchor", "content"]).select("_k1", "_k2", "start", F.explode("spans").alias("s"))
    spans = spans.select("_k1", "_k2", (F.col("start") + F.col("s.a")).alias("a"), (F.col("start") + F.col("s.b")).alias("b"))
    spans = scratch.write(merged_spans(spans, ["_k1", "_k2"]), "spans")
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"_id {kind}, n_words long, n_removed long, kept_text string"
    kept = _with_lists(source, spans, "left").select("_id", "_text", "spans").mapInArrow(_remove, schema)
    return kept.withColumnRenamed("_id", id_col)


def _with_lists(source: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    """Rows with the list of their key. Short lists go to the texts; else both are shuffled."""
    return source.join(if_small(lists, LIST_BYTES), ["_k1", "_k2"], how)


def _cut_snippets(window: int, split: bool):
    """The words of wanted snippets: whole, or one window at a time with its place in the snippet and its hash."""
    names = ["anchor", "content", "first", "copies", "part", "words"] if split else ["anchor", "content", "copies", "words"]
    types = {"first": pa.int32(), "words": pa.binary()}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in tk.pieces(batches, "_text"):
            w = tk.words_of_column(piece.column("_text"))
            rows: list[tuple] = []
            for i, wanted in enumerate(piece.column("wanted").to_pylist()):
                for s in wanted:
                    lo = int(w.first[i]) + s["start"]
                    words = w.hashes[lo : lo + s["n"] + window - 1]
                    if split:
                        parts = tk.windows_of(words, window).view(np.int64).tolist()
                        rows += [
                            (s["anchor"], s["content"], j, s["copies"], part, words[j : j + window].tobytes())
                            for j, part in enumerate(parts)
                        ]
                    else:
                        rows.append((s["anchor"], s["content"], s["copies"], words.tobytes()))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
            arrays = [pa.array(c, types.get(n, pa.int64())) for c, n in zip(columns, names, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return cut


def _judge(window: int):
    """One automaton per anchor: the repeated spans of each of its contents, SHARD_CONTENTS at most."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["anchor", "content", "spans"]
        types = [pa.int64(), pa.int64(), pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))]
        out: list[tuple] = []
        shard: dict[int, tuple[int, list[int]]] = {}
        now = None

        def close() -> None:
            automaton = SuffixAutomaton()
            for copies, words in shard.values():
                automaton.add(words, copies)
            automaton.settle()
            for content, (_, words) in shard.items():
                spans = spans_of(automaton.repeated(words, window), window)
                if spans:
                    out.append((now, content, [{"a": a, "b": b} for a, b in spans]))

        def rows() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) if out else [[]] * 3
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        for batch in batches:
            for anchor, content, copies, words in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now != anchor:
                    if now is not None:
                        close()
                    now, shard = anchor, {}
                # a repeated row has the same snippet again; its copies are counted already
                shard[content] = (copies, np.frombuffer(words, np.uint64).tolist())
            if out:
                yield rows()
                out = []
        if now is not None:
            close()
            yield rows()

    return judge


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in tk.pieces(batches, "_text"):
        n_words, n_removed, kept = [], [], []
        texts = tk.text_array(piece.column("_text")).to_pylist()
        for text, spans in zip(texts, piece.column("spans").to_pylist(), strict=True):
            words = text.encode().split()
            total, left, last = len(words), [], 0
            for s in spans or ():
                left += words[last : s["a"]]
                last = max(last, s["b"])
            left += words[last:]
            n_words.append(total)
            n_removed.append(total - len(left))
            kept.append(b" ".join(left).decode())
        yield pa.RecordBatch.from_arrays(
            [piece.column("_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
            names=["_id", "n_words", "n_removed", "kept_text"],
        )
