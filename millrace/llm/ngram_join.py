"""N-gram Jaccard join as T-occurrence search.

Documents are sets of word shingles; a partner of x shares at least ``T = ceil(t * |x|)`` of its shingles. In the order of
the lengths of their inverted lists, x's first ``|x| - T + 1`` shingles cannot all be missed by a partner: these are the
short lists to merge, the others the long ones to probe.

1. One pass gives every set's size and signature. Equal sets are one class from here on.
2. Lists of one document link nothing. A second pass deals truncated shingles out by range and counts which are in two
   documents; documents with fewer than T of those are out of the search. Truncation can only keep too many.
3. The sets of the remaining classes are read once, their list lengths counted exactly, and the short lists written as
   (shingle, node).
4. Neighbours in the short lists, by size and then by chance, are searched first: they link a large group of near copies
   with a few searches each. Then, of each list, only documents of different components still have to be searched, in tiles
   if a list is long. Ranks in the lists bound what a pair can still share, and so do parity sketches: every shingle flips one
   bit of its set's, so the bits in which two sketches differ are at most as many as the shingles that only one set has.
5. A search takes one document and the lists of its candidates: DivideSkip pops the short lists off a heap, skips ahead
   where too few can follow, and probes the long lists by bisection for those that reach the rest. What reaches T is held
   against the exact threshold.

Shingles travel as packed arrays, one row per task piece and range; a shingle of many documents of a piece is one entry of
that piece, so that a common passage does not make a range large.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm import textkernel as tk
from millrace.llm.common import one_per_key, row_key
from millrace.llm.components import components
from millrace.plans.staging import Scratch, if_small

#: Shingles of one range, at 5 or 10 bytes each.
RANGE_SHINGLES = 1 << 20
#: Documents of a short list that make one tile, and candidates that one search takes at a time.
TILE = 256
#: Searches of random partners before the whole one, and partners of a document in each. Neither loses a pair: the last
#: search covers all pairs of different components.
ROUNDS = 1
PARTNERS = 16
#: 64-bit words of a parity sketch.
SKETCH_WORDS = 16
_SHARED = 0xFFFF
_PIECE_ROWS = 30_000


def shingle_sets(column: pa.Array, size: int) -> list[np.ndarray]:
    """The distinct shingles of every text, sorted; a text of fewer words is one shingle, one of none has none."""
    w = tk.words_of_column(column, lower=True)
    grams = tk.windows_of(w.hashes, size)
    out = []
    for lo, hi in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
        if hi - lo >= size:
            out.append(np.unique(grams[lo : hi - size + 1]))
        else:
            out.append(tk.windows_of(w.hashes[lo:hi], hi - lo) if hi > lo else np.empty(0, np.uint64))
    return out


def _row_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in tk.pieces(batches, "_text"):
        for lo in range(0, piece.num_rows, _PIECE_ROWS):
            yield piece.slice(lo, _PIECE_ROWS)


def _batch(columns: list, types: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def _describe(size: int):
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _row_pieces(batches):
            sets = shingle_sets(piece.column("_text"), size)
            one = [int(s.sum(dtype=np.uint64).view(np.int64)) for s in sets]
            two = [int(np.bitwise_xor.reduce(tk.mix(s ^ np.uint64(0x5851F42D4C957F2D))).view(np.int64)) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("_k1"), piece.column("_k2"), piece.column("_id"),
                    pa.array([len(s) for s in sets], pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()),
                ],
                names=["_k1", "_k2", "_id", "n", "s1", "s2"],
            )

    return describe


# ---- step 2: which documents have T shingles that another document has too


def _runs(values: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values sorted with their owners, and the start of each run of equal values, with the end appended."""
    order = np.argsort(values, kind="stable")
    values, owners = values[order], owners[order]
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    return values, owners, np.append(np.flatnonzero(new), len(values))


def _control(number: int) -> int:
    """The group of a piece's own row: below the ranges, and another one for pieces of one number in other partitions."""
    return -1 - (TaskContext.get().partitionId() * 31 + number) % 4096


def _deal(size: int, range_bits: int):
    """Per piece: a row per range of truncated shingles, and a row with its documents and what they share among themselves."""
    shift = np.uint64(64 - range_bits - 24)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 32
        for number, piece in enumerate(_row_pieces(batches)):
            sets = shingle_sets(piece.column("_text"), size)
            owners = np.repeat(np.arange(len(sets), dtype=np.uint16), [len(s) for s in sets])
            cut = (np.concatenate(sets) if sets else np.empty(0, np.uint64)) >> shift
            values, owners, starts = _runs(cut, owners)
            shared = np.repeat(np.diff(starts) > 1, np.diff(starts))
            own = np.bincount(owners[shared], minlength=len(sets)).astype(np.uint32)
            heads, kept = values[starts[:-1]], owners[starts[:-1]].copy()
            kept[np.diff(starts) > 1] = _SHARED
            ranges = (heads >> np.uint64(24)).astype(np.int64)
            low = (heads & np.uint64(0xFFFFFF)).astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3]
            edges = np.searchsorted(ranges, np.arange((1 << range_bits) + 1))
            rows = [
                (int(r), base + number, np.ascontiguousarray(low[a:b]).tobytes(), kept[a:b].tobytes(), None)
                for r, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True))
                if b > a
            ]
            k1, k2 = (piece.column(c).to_numpy() for c in ("_k1", "_k2"))
            rows.append((_control(number), base + number, own.tobytes(), b"", np.stack([k1, k2]).tobytes()))
            yield _batch(
                list(zip(*rows, strict=True)),
                [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()],
                ["range", "piece", "low", "owners", "keys"],
            )

    return deal


_COUNTED = "piece long, owners binary, counts binary, keys binary"


def _count_range(table: pa.Table) -> pa.Table:
    """Of one range: how many shingles of each document of a piece are in another document too."""
    names = ["piece", "owners", "counts", "keys"]
    types = [pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    if table.column("range")[0].as_py() < 0:
        piece, own, keys = (table.column(c).to_pylist() for c in ("piece", "low", "keys"))
        return pa.table([pa.array(c, t) for c, t in zip((piece, [b""] * len(piece), own, keys), types, strict=True)], names)
    low, owners, at = [], [], []
    for i, (a, b) in enumerate(zip(table.column("low"), table.column("owners"), strict=True)):
        wide = np.zeros((len(a.as_buffer()) // 3, 4), np.uint8)
        wide[:, :3] = np.frombuffer(a.as_buffer(), np.uint8).reshape(-1, 3)
        low.append(wide.reshape(-1).view("<u4"))
        owners.append(np.frombuffer(b.as_buffer(), np.uint16))
        at.append(np.full(len(owners[-1]), i, np.uint32))
    low, owners, at = np.concatenate(low), np.concatenate(owners), np.concatenate(at)
    order = np.argsort(low, kind="stable")
    low = low[order]
    same = np.zeros(len(low), bool)
    same[1:] = low[1:] == low[:-1]
    same[:-1] |= same[1:]
    hit = order[same]
    hit = hit[owners[hit] != _SHARED]
    who, count = np.unique((at[hit].astype(np.int64) << 16) | owners[hit], return_counts=True)
    edges = np.searchsorted(who >> 16, np.arange(table.num_rows + 1))
    rows = [
        (p, (who[a:b] & 0xFFFF).astype(np.uint16).tobytes(), count[a:b].astype(np.uint32).tobytes(), None)
        for p, a, b in zip(table.column("piece").to_pylist(), edges[:-1].tolist(), edges[1:].tolist(), strict=True)
        if b > a
    ]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
    return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def _sum_piece(table: pa.Table) -> pa.Table:
    """The counts of a piece's documents over all ranges."""
    head = next(i for i, k in enumerate(table.column("keys")) if k.is_valid)
    k1, k2 = np.frombuffer(table.column("keys")[head].as_buffer(), np.int64).reshape(2, -1)
    total = np.frombuffer(table.column("counts")[head].as_buffer(), np.uint32).astype(np.int64)
    for i, (o, c) in enumerate(zip(table.column("owners"), table.column("counts"), strict=True)):
        if i != head:
            total[np.frombuffer(o.as_buffer(), np.uint16)] += np.frombuffer(c.as_buffer(), np.uint32)
    return pa.table([pa.array(k1), pa.array(k2), pa.array(total)], ["_k1", "_k2", "shared"])


# ---- step 3: exact list lengths of the remaining sets, and the short lists


def parity_sketch(grams: np.ndarray) -> np.ndarray:
    """For each bit, whether an odd number of the shingles falls on it."""
    bits = (tk.mix(grams ^ np.uint64(0xA0761D6478BD642F)) >> np.uint64(32)) % np.uint64(64 * SKETCH_WORDS)
    odd = np.bincount(bits.astype(np.int64), minlength=64 * SKETCH_WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


def _pack_sets(size: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _row_pieces(batches):
            sets = shingle_sets(piece.column("_text"), size)
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("node"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                    pa.array([parity_sketch(s).tobytes() for s in sets], pa.binary()),
                ],
                names=["node", "n", "grams", "sketch"],
            )

    return pack


_DEALT = "range int, piece long, grams binary, owners binary, many binary, nodes binary"


def _deal_sets(range_bits: int):
    """As _deal, with whole shingles and, for those shared in the piece, their number there and their owners."""
    names = ["range", "piece", "grams", "owners", "many", "nodes"]
    types = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, number = TaskContext.get().partitionId() << 32, -1
        for batch in batches:
            sizes = batch.column("n").to_numpy()
            lo = 0
            while lo < batch.num_rows:
                hi = lo + max(1, min(_PIECE_ROWS, int(np.searchsorted(np.cumsum(sizes[lo:]), RANGE_SHINGLES, "right"))))
                sets = [np.frombuffer(g.as_buffer(), np.uint64) for g in batch.column("grams")[lo:hi]]
                nodes, counts = batch.column("node").to_numpy()[lo:hi], sizes[lo:hi]
                lo, number = hi, number + 1
                owners = np.repeat(np.arange(len(sets), dtype=np.uint16), counts)
                values, owners, starts = _runs(np.concatenate(sets), owners)
                lengths = np.diff(starts)
                heads, kept = values[starts[:-1]], owners[starts[:-1]].copy()
                kept[lengths > 1] = _SHARED
                edges = np.searchsorted((heads >> np.uint64(64 - range_bits)).astype(np.int64), np.arange((1 << range_bits) + 1))
                rows = []
                for r, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)):
                    if b > a:
                        part = lengths[a:b]
                        many = part[part > 1].astype(np.uint32).tobytes()
                        rows.append((r, base + number, heads[a:b].tobytes(), kept[a:b].tobytes(), many, None))
                shared = np.repeat(lengths > 1, lengths)
                about = np.stack([nodes, counts]).astype(np.int64).tobytes()
                key = base + number
                rows.append((_control(number), key, values[shared].tobytes(), owners[shared].tobytes(), b"", about))
                yield _batch(list(zip(*rows, strict=True)), types, names)

    return deal


def _lengths_of_range(table: pa.Table) -> pa.Table:
    """Of one range: the shingles in two documents or more, with the lengths of their lists, back to their pieces."""
    names = ["piece", "grams", "owners", "lengths", "nodes"]
    types = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
    if table.column("range")[0].as_py() < 0:
        piece, grams, owners, nodes = (table.column(c).to_pylist() for c in ("piece", "grams", "owners", "nodes"))
        columns = (piece, grams, owners, [b""] * len(piece), nodes)
        return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)
    grams, owners, many, at = [], [], [], []
    for i, (g, o, m) in enumerate(zip(table.column("grams"), table.column("owners"), table.column("many"), strict=True)):
        grams.append(np.frombuffer(g.as_buffer(), np.uint64))
        owners.append(np.frombuffer(o.as_buffer(), np.uint16))
        many.append(np.ones(len(owners[-1]), np.int64))
        many[-1][owners[-1] == _SHARED] = np.frombuffer(m.as_buffer(), np.uint32)
        at.append(np.full(len(owners[-1]), i))
    grams, owners, many, at = map(np.concatenate, (grams, owners, many, at))
    _, run = np.unique(grams, return_inverse=True)
    length = np.bincount(run, weights=many).astype(np.int64)[run]
    rows = []
    keep = np.flatnonzero(length > 1)
    edges = np.searchsorted(at[keep], np.arange(table.num_rows + 1))
    for p, a, b in zip(table.column("piece").to_pylist(), edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        if b > a:
            k = keep[a:b]
            rows.append((p, grams[k].tobytes(), owners[k].tobytes(), length[k].astype(np.uint32).tobytes(), None))
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
    return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def _short_lists(percent: int):
    def lists(table: pa.Table) -> pa.Table:
        """The entries of a piece's documents in their short lists."""
        head = next(i for i, k in enumerate(table.column("nodes")) if k.is_valid)
        nodes, counts = np.frombuffer(table.column("nodes")[head].as_buffer(), np.int64).reshape(2, -1)
        shared_grams = np.frombuffer(table.column("grams")[head].as_buffer(), np.uint64)
        shared_owners = np.frombuffer(table.column("owners")[head].as_buffer(), np.uint16)
        grams, owners, lengths = [], [], []
        for i, row in enumerate(zip(table.column("grams"), table.column("owners"), table.column("lengths"), strict=True)):
            if i == head:
                continue
            g, o, n = (np.frombuffer(c.as_buffer(), t) for c, t in zip(row, (np.uint64, np.uint16, np.uint32), strict=True))
            one = o != _SHARED
            many = np.flatnonzero(~one)
            a, b = np.searchsorted(shared_grams, g[many], "left"), np.searchsorted(shared_grams, g[many], "right")
            times = b - a
            inside = np.repeat(a, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            grams += [g[one], np.repeat(g[many], times)]
            owners += [o[one], shared_owners[inside]]
            lengths += [n[one], np.repeat(n[many], times)]
        grams, owners, lengths = map(np.concatenate, (grams, owners, lengths)) if grams else ([], [], [])
        order = np.lexsort((grams, lengths, owners))
        grams, owners = np.asarray(grams, np.uint64)[order], np.asarray(owners, np.int64)[order]
        have = np.bincount(owners, minlength=len(nodes))
        need = -(-percent * counts // 100)
        first = counts - need + 1 - (counts - have)  # of the short lists, those of two documents or more
        rank = np.arange(len(owners)) - np.searchsorted(owners, owners)
        take = (rank < first[owners]) & (have[owners] >= need[owners])
        at = owners[take]
        return pa.table(
            [
                pa.array(grams[take].view(np.int64)), pa.array(nodes[at]), pa.array(counts[at]),
                pa.array((counts - have)[at] + rank[take]),
            ],
            ["gram", "node", "n", "rank"],
        )

    return lists


# ---- steps 4 and 5: candidates and their search


def _may_reach(n, m, rank_n, rank_m, percent: int):
    """Whether two sets can reach the threshold, if a shingle at these ranks is the first one that they share."""
    need = -(-percent * (n + m) // (100 + percent))
    return (100 * np.minimum(n, m) >= percent * np.maximum(n, m)) & (np.minimum(n - rank_n, m - rank_m) >= need)


def _near_enough(n, m, sketch_n: np.ndarray, sketch_m: np.ndarray, percent: int):
    """Whether two sets' sketches leave it open that they reach the threshold."""
    need = -(-percent * (n + m) // (100 + percent))
    return np.bitwise_count(sketch_n ^ sketch_m).sum(axis=-1, dtype=np.int64) <= n + m - 2 * need


def _sketches(column) -> np.ndarray:
    """A row of words per sketch."""
    return np.array([np.frombuffer(s.as_buffer(), np.uint64) for s in column], np.uint64).reshape(-1, SKETCH_WORDS)


def _neighbours(percent: int):
    """Neighbours in sorted lists (gram, node, n, rank, component, sketch) that different components hold."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in ("gram", "node", "n", "rank", "component")]
            columns.append(_sketches(batch.column("sketch")))
            if last is not None:
                columns = [np.append(a, b, axis=0) for a, b in zip(last, columns, strict=True)]
            g, x, n, r, c, k = columns
            near = (g[1:] == g[:-1]) & (c[1:] != c[:-1]) & _may_reach(n[1:], n[:-1], r[1:], r[:-1], percent)
            at = np.flatnonzero(near)
            at = at[_near_enough(n[at], n[at + 1], k[at], k[at + 1], percent)]
            a, b = x[at], x[at + 1]
            found = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["x", "y"])
            last = [v[-1:] for v in columns] if len(g) else last

    return pairs


def _across(percent: int):
    """Pairs of one tile's documents that different components hold."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        now, rows = None, []

        def close() -> list[tuple[int, int]]:
            x, n, r, c, s = (np.array(v) for v in zip(*[row[:-1] for row in rows], strict=True))
            k = _sketches([row[-1] for row in rows])
            # a tile is one chunk of its list with itself, or two chunks
            may = (c[:, None] != c[None, :]) & _may_reach(n[:, None], n[None, :], r[:, None], r[None, :], percent)
            if now[1] == now[2]:
                may &= x[:, None] < x[None, :]
            else:
                may &= (s[:, None] == now[1]) & (s[None, :] == now[2])
            a, b = np.nonzero(may)
            fits = np.zeros(len(a), bool)
            for lo in range(0, len(a), 1 << 14):
                p, q = a[lo : lo + (1 << 14)], b[lo : lo + (1 << 14)]
                fits[lo : lo + (1 << 14)] = _near_enough(n[p], n[q], k[p], k[q], percent)
            a, b = a[fits], b[fits]
            out = []
            for p, q in zip(np.minimum(x[a], x[b]).tolist(), np.maximum(x[a], x[b]).tolist(), strict=True):
                pair = p << 64 | q
                if pair not in seen:
                    seen.add(pair)
                    out.append((p, q))
            if len(seen) > 250_000:  # what is forgotten is only sent twice
                seen.clear()
            return out

        for batch in batches:
            found: list[tuple[int, int]] = []
            names = ("gram", "i", "j", "node", "n", "rank", "component", "chunk")
            columns = [batch.column(c).to_pylist() for c in names] + [batch.column("sketch")]
            for g, i, j, *row in zip(*columns, strict=True):
                if now != (g, i, j):
                    found += close() if rows else []
                    now, rows = (g, i, j), []
                rows.append(row)
            if found:
                yield _batch(list(zip(*found, strict=True)), [pa.int64(), pa.int64()], ["x", "y"])
        if rows and (found := close()):
            yield _batch(list(zip(*found, strict=True)), [pa.int64(), pa.int64()], ["x", "y"])

    return pairs


def _open_lists(entries: DataFrame, group: DataFrame, sketches: DataFrame) -> DataFrame:
    """Entries with their components and sketches, of the lists that several components share; chunks of TILE documents."""
    member = entries.join(if_small(group), "node", "left").withColumn("component", F.coalesce("component", "node"))
    lists = member.groupBy("gram").agg(
        F.count(F.lit(1)).alias("_count"), F.min("component").alias("_low"), F.max("component").alias("_high")
    )
    lists = lists.filter("_low <> _high").select("gram", F.ceil(F.col("_count") / F.lit(TILE)).cast("int").alias("chunks"))
    return member.join(lists, "gram").join(if_small(sketches), "node")


def _tiles(lists: DataFrame) -> DataFrame:
    """Every list as tiles of two of its chunks, or of one with itself."""
    tiled = (
        lists.withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
        .withColumn("_with", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .withColumn("i", F.least("chunk", "_with"))
        .withColumn("j", F.greatest("chunk", "_with"))
        .select("gram", "i", "j", "node", "n", "rank", "component", "chunk", "sketch")
    )
    return tiled.repartition("gram", "i", "j").sortWithinPartitions("gram", "i", "j", "node")


def _partners(pairs: DataFrame, luck: int) -> DataFrame:
    """Of the pairs, PARTNERS for each document, by a hash of the pair."""
    both = pairs.unionByName(pairs.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct()
    nth = F.row_number().over(Window.partitionBy("x").orderBy(F.xxhash64("x", "y", F.lit(luck))))
    some = both.withColumn("_nth", nth).filter(F.col("_nth") <= PARTNERS)
    return some.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()


def divide_skip(lists: list[list[int]], least: int) -> dict[int, int]:
    """Ids that are in at least ``least`` of the sorted lists, with the number of lists that have them."""
    lists = sorted((x for x in lists if x), key=len)
    if len(lists) < least:
        return {}
    longest = len(lists[-1])
    n_long = min(least - 1, int(least / (0.0085 * math.log2(longest + 1) + 1)))
    short, long = lists[: len(lists) - n_long], lists[len(lists) - n_long :]
    need = least - n_long
    heap = [(x[0], i, 0) for i, x in enumerate(short)]
    heapq.heapify(heap)
    found: dict[int, int] = {}
    while len(heap) >= need:
        top, popped = heap[0][0], []
        while heap and heap[0][0] == top:
            popped.append(heapq.heappop(heap))
        if len(popped) >= need:
            total = len(popped)
            for x in long:
                at = bisect_left(x, top)
                total += at < len(x) and x[at] == top
            if total >= least:
                found[top] = total
            ahead = top + 1
        else:
            # with need - 1 lists at smaller ids, the next id that can still reach need is the heap's top
            while heap and len(popped) < need - 1:
                popped.append(heapq.heappop(heap))
            ahead = heap[0][0] if heap else None
        for _, i, at in popped:
            at = bisect_left(short[i], ahead, at) if ahead is not None else len(short[i])
            if at < len(short[i]):
                heapq.heappush(heap, (short[i][at], i, at))
    return found


def _search(percent: int):
    """Streams a document and then its candidates, TILE at a time; gives the pairs that reach the threshold."""

    def links_of(x: int, grams: np.ndarray, some: list[tuple[int, np.ndarray]]) -> list[tuple[int, int]]:
        least = min(-(-percent * (len(grams) + len(g)) // (100 + percent)) for _, g in some)
        lists: list[list[int]] = [[] for _ in range(len(grams))]
        for k, (_, g) in enumerate(some):
            at = np.minimum(np.searchsorted(grams, g), len(grams) - 1)
            for i in at[grams[at] == g].tolist():
                lists[i].append(k)
        out = []
        for k, both in divide_skip(lists, least).items():
            y, g = some[k]
            if 100 * both >= percent * (len(grams) + len(g) - both):
                out.append((x, y))
        return out

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, own, some = None, None, {}
        for batch in batches:
            found: list[tuple[int, int]] = []
            for a, b, raw in zip(*(batch.column(c) for c in ("x", "y", "grams")), strict=True):
                a, b = a.as_py(), b.as_py()
                if a != x or len(some) == TILE:
                    if some:
                        found += links_of(x, own, list(some.items()))
                    some = {}
                grams = np.frombuffer(raw.as_buffer(), np.uint64)
                if b is None:
                    x, own = a, grams
                else:
                    some[b] = grams
            if found:
                yield _batch(list(zip(*found, strict=True)), [pa.int64(), pa.int64()], ["x", "y"])
        if some and (found := links_of(x, own, list(some.items()))):
            yield _batch(list(zip(*found, strict=True)), [pa.int64(), pa.int64()], ["x", "y"])

    return search


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    candidates = pairs.join(sets.select(F.col("node").alias("y"), "grams"), "y").select("x", "y", "grams")
    own = sets.join(pairs.select(F.col("x").alias("node")).distinct(), "node", "left_semi")
    own = own.select(F.col("node").alias("x"), F.lit(None).cast("long").alias("y"), "grams")
    both = candidates.unionByName(own).repartition("x").sortWithinPartitions("x", F.col("y").asc_nulls_first())
    return both.mapInArrow(_search(percent), "x long, y long")


def _with_links(group: DataFrame, links: DataFrame) -> DataFrame:
    """The components so far as links to their names, and more links."""
    return group.select(F.col("node").alias("x"), F.col("component").alias("y")).unionByName(links)


def ngram_join(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 75
) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id.

    A-Z are lower-cased and words are runs of anything but ASCII white space. A document is the set of its ``size``-word
    shingles; with fewer words, its whole sequence is its one shingle; without words or text the set is empty and links
    with nothing. Two documents link if 100 times the intersection is at least ``percent`` times the union. component_id is
    the smallest id that links reach; null ids are reached but name nothing, so it is null only where all are. Repeated
    rows link with each other. An empty table gives no rows; other columns are ignored.
    """
    found = _components_of(docs, Scratch(docs.sparkSession, "ngram-join"), id_col, text_col, size, percent)
    least = F.coalesce("least.id", "_id").alias("component_id")
    return found.select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), least)


def drop_near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 75
) -> DataFrame:
    """The rows of ``docs``, all columns, that stay when one document of each component does: the one with the smallest id.

    Null ids come last; documents that share an id are in order of a hash of their texts. Of rows that repeat id and text, one
    stays. Documents without words are components of their own. An empty table gives no rows; columns may have any name.
    """
    scratch = Scratch(docs.sparkSession, "ngram-join")
    found = _components_of(docs, scratch, id_col, text_col, size, percent)
    own = (F.col("least._k1") == F.col("_k1")) & (F.col("least._k2") == F.col("_k2"))
    stays = found.filter(F.col("least").isNull() | own).groupBy("_k1", "_k2").agg(F.count(F.lit(1)).alias("_rows"))
    stays = scratch.write(stays, "stays")
    keys = ["_k1", "_k2"]
    keyed = docs.select(F.struct(*docs.columns).alias("_row"), *row_key(id_col, text_col))
    kept = keyed.join(if_small(stays.select(*keys)), keys, "left_semi")
    return one_per_key(kept, stays, keys).select(*[F.col("_row")[c].alias(c) for c in docs.columns])


def _components_of(docs: DataFrame, scratch: Scratch, id_col: str, text_col: str, size: int, percent: int) -> DataFrame:
    """Every row's key, id, set size and the least document of its component, null for sets that nothing else has."""
    spark = docs.sparkSession
    source = docs.select(*row_key(id_col, text_col), F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = docs.schema[id_col].dataType.simpleString()
    sets = scratch.write(
        source.mapInArrow(_describe(size), f"_k1 long, _k2 long, _id {kind}, n long, s1 long, s2 long"), "sets"
    )
    total = sets.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    range_bits = min(20, max(4, math.ceil(math.log2(max(1, total / RANGE_SHINGLES)))))

    dealt = source.drop("_id").mapInArrow(
        _deal(size, range_bits), "range int, piece long, low binary, owners binary, keys binary"
    )
    counted = dealt.groupBy("range").applyInArrow(_count_range, _COUNTED)
    shared = counted.groupBy("piece").applyInArrow(_sum_piece, "_k1 long, _k2 long, shared long")
    shared = scratch.write(shared.filter("shared > 0").distinct(), "shared")
    alive = sets.filter("n > 0").join(if_small(shared), ["_k1", "_k2"]).filter(F.col("shared") * 100 >= F.col("n") * percent)
    first = F.struct(F.col("_id").isNull().alias("last"), F.col("_id").alias("id"), "_k1", "_k2")
    classes = alive.groupBy("n", "s1", "s2").agg(F.min(first).alias("first"))
    classes = scratch.write(classes.withColumn("node", F.monotonically_increasing_id()), "classes")

    read = classes.select("first._k1", "first._k2", "node")
    packed = source.drop("_id").join(if_small(read), ["_k1", "_k2"]).select("node", "_text")
    packed = scratch.write(packed.mapInArrow(_pack_sets(size), "node long, n long, grams binary, sketch binary"), "packed")
    total = packed.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    range_bits = min(20, max(4, math.ceil(math.log2(max(1, total / RANGE_SHINGLES)))))
    sketches, packed = packed.select("node", "sketch"), packed.drop("sketch")
    lengths = packed.mapInArrow(_deal_sets(range_bits), _DEALT).groupBy("range")
    lengths = lengths.applyInArrow(_lengths_of_range, "piece long, grams binary, owners binary, lengths binary, nodes binary")
    entries = lengths.groupBy("piece").applyInArrow(_short_lists(percent), "gram long, node long, n long, rank long")
    entries = scratch.write(entries.distinct(), "short-lists")

    # near copies link up in a chain by size, then through some random partners; what is left apart is searched whole
    order = [["gram", "n", "node"]] + [["gram", "_luck"]] * ROUNDS
    group = scratch.write(entries.select("node", F.col("node").alias("component")).limit(0), "components")
    pairs = "x long, y long"
    for luck, by in enumerate(order):
        lists = _open_lists(entries, group, sketches).withColumn("_luck", F.xxhash64("gram", "node", F.lit(luck)))
        near = lists.repartitionByRange(*by).sortWithinPartitions(*by).select("gram", "node", "n", "rank", "component", "sketch")
        near = near.mapInArrow(_neighbours(percent), pairs).distinct()
        near = scratch.write(near if luck == 0 else _partners(near, luck), "neighbours")
        group = scratch.write(components(_with_links(group, _links(near, packed, percent)), scratch), "components")
    across = scratch.write(_tiles(_open_lists(entries, group, sketches)).mapInArrow(_across(percent), pairs).distinct(), "across")
    group = scratch.write(components(_with_links(group, _links(across, packed, percent)), scratch), "components")

    named = classes.join(if_small(group), "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("first").alias("least"))
    named = scratch.write(named.join(least, "component").select("n", "s1", "s2", "least"), "named")
    return sets.join(if_small(named), ["n", "s1", "s2"], "left").select("_k1", "_k2", "_id", "n", "least")
