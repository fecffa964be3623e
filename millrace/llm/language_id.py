"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts, up to ``order`` bytes long and only as deep as its counts carry. A byte is coded
in the longest context that the trees have, at probability ``count / (total + kinds)``; a byte never seen there pays the
escape ``kinds / (total + kinds)`` and is coded one byte of context shorter, down to a uniform code over all bytes; a
context that a language itself has not seen costs it no escape. Counts are frozen before scoring. The language with the
shortest code for the whole text wins; code lengths are whole numbers of 1/256 bits, so that sums do not depend on their
order.

The counts come from a bounded sample of whole labelled texts; Spark sums and prunes them. What is broadcast are the counts,
some 25 bytes each; each worker makes its tables of them once, in bounded memory. All trees share one set of contexts: for each position the
longest shared context is found by stepping backwards, and each language's code length there is one lookup.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm import textkernel as tk
from millrace.plans.staging import Scratch, if_small

#: Code lengths are in 1/UNIT bits. With five contexts of at most 2**40 bytes each, a code is under 256 bits.
UNIT = 256
#: Bytes that are coded at a time, at some 30 bytes of memory each; a longer text is coded in several steps.
SPAN_BYTES = 1 << 20
#: Bytes of sample text whose contexts are counted at a time, at some 100 bytes of memory each.
COUNT_BYTES = 1 << 19


@dataclass
class ContextTrees:
    """Counts of bytes in shared contexts.

    ``names``: the contexts, each its length and its bytes, in order; number 0 is the empty one. ``counts``: by language, the
    numbers of the contexts, the bytes seen there and how often. ``table_bytes``: how much memory a worker gives to tables with a
    place for every byte in every context. The shortest contexts have such places as far as that reaches; the counts of longer
    ones are looked up one by one. Code lengths are the same in either way.
    """

    languages: list[str]
    order: int
    names: np.ndarray
    counts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    table_bytes: int = 256 << 20
    _made: _Tables | None = field(default=None, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"_made": None}

    def tables(self) -> _Tables:
        if self._made is None:
            self._made = _Tables(self)
        return self._made

    def lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Code lengths of texts, one row a text and one column a language, in 1/UNIT bits."""
        out = np.zeros((len(offsets) - 1, len(self.languages)), np.int64)
        if not self.languages:
            return out
        made = self.tables()
        for lo in range(0, len(data), SPAN_BYTES):
            hi = min(lo + SPAN_BYTES, len(data))
            base = max(0, lo - self.order)
            s, edges = made.symbol[data[base:hi]], np.clip(offsets, lo, hi) - lo
            chain = made.chain(s, lo - base, hi - lo, offsets[:-1] - lo, offsets[1:] - lo)
            sums = np.zeros(hi - lo + 1, np.int64)
            for k in range(len(self.languages)):
                np.cumsum(made.code(k, chain, s[lo - base :]), out=sums[1:])
                out[:, k] += sums[edges[1:]] - sums[edges[:-1]]
        return out


class _Tables:
    """What a worker makes of :class:`ContextTrees`.

    ``symbol``: of each byte, the last two numbers are any byte never learned and the start of a text. ``child``: of context c
    and symbol s, the context with s before c, or -1. ``codes``: by language, code lengths by context and symbol. These two have
    the contexts of up to ``depth`` bytes; longer ones are found by their (context, symbol) among ``links`` and ``deep``.
    """

    def __init__(self, trees: ContextTrees):
        learned = np.unique(np.concatenate([byte[at == 0] for at, byte, _ in trees.counts]))
        self.symbol = np.full(256, len(learned), np.int16)
        self.symbol[learned] = np.arange(len(learned))
        self.symbols, self.order = len(learned) + 2, trees.order
        depth, body = trees.names >> 40, trees.names & ((1 << 40) - 1)
        farthest = body >> np.maximum(8 * (depth - 1), 0)
        shorter = np.maximum(depth - 1, 0) << 40 | body & (1 << np.maximum(8 * (depth - 1), 0)) - 1
        above = np.searchsorted(trees.names, shorter)
        ends = np.searchsorted(depth, np.arange(trees.order + 2))  # where the contexts of each length begin
        row_bytes = (len(trees.languages) * 2 + 4 + 24) * self.symbols  # codes, children, and what making codes takes
        self.depth = max((d for d in range(trees.order + 1) if int(ends[d + 1]) * row_bytes <= trees.table_bytes), default=0)
        dense = int(ends[self.depth + 1])
        self.child = np.full((dense, self.symbols), -1, np.int32)
        shallow = np.flatnonzero((depth > 0) & (np.arange(len(depth)) < dense))
        self.child[above[shallow], self.symbol[farthest[shallow]]] = shallow
        far = np.arange(dense, len(depth))
        links = above[far].astype(np.int64) * self.symbols + self.symbol[farthest[far]]
        order = np.argsort(links, kind="stable")
        self.links, self.linked = links[order], far[order].astype(np.int32)
        self.codes, self.exact, self.deep = [], [], []
        for at, byte, n in trees.counts:
            bits = self._bits(ends, above, dense, at, byte, n)
            assert bits.max() < 65_535 / UNIT
            self.codes.append(np.round(bits * UNIT).astype(np.uint16).reshape(-1))
            # where longer contexts go on, they add to lengths that are not rounded yet
            self.exact.append(bits.reshape(-1) if len(far) else None)
            self.deep.append(self._looked_up(dense, len(depth), at, byte, n) if len(far) else None)

    def _bits(self, ends, above, dense, at, byte, n) -> np.ndarray:
        """Code lengths of one language, from short contexts to long ones."""
        bits = np.full((dense, self.symbols), np.log2(256.0))
        for lo, hi in zip(ends[: self.depth + 1].tolist(), ends[1 : self.depth + 2].tolist(), strict=True):
            mine = (at >= lo) & (at < hi)
            counts = np.zeros((hi - lo, self.symbols))
            counts[at[mine] - lo, self.symbol[byte[mine]]] = n[mine]
            kinds, seen = np.count_nonzero(counts, axis=1)[:, None], counts.sum(1)[:, None]
            shorter = bits[above[lo:hi]] if lo else bits[lo:hi]
            escaped = np.log2((seen + kinds) / np.maximum(kinds, 1), where=kinds > 0, out=np.zeros_like(seen)) + shorter
            bits[lo:hi] = np.where(counts > 0, np.log2((seen + kinds) / np.maximum(counts, 1), where=kinds > 0, out=np.zeros_like(counts)), escaped)
        return bits

    def _looked_up(self, dense, contexts, at, byte, n) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of one language's long contexts: (context, symbol) in order, their code lengths, and the escapes by context."""
        kinds, seen = np.bincount(at, minlength=contexts), np.bincount(at, n, minlength=contexts)
        escapes = np.log2((seen + kinds) / np.maximum(kinds, 1), where=kinds > 0, out=np.zeros(contexts))
        mine = at >= dense
        keys = at[mine].astype(np.int64) * self.symbols + self.symbol[byte[mine]]
        order = np.argsort(keys)
        lengths = np.log2((seen + kinds)[at[mine]] / n[mine])
        return keys[order], lengths[order], escapes

    def chain(self, s, skip, size, starts, ends) -> list[np.ndarray]:
        """The longest context at each position, and before it the shorter ones that are not in the dense tables, -1 for none.

        The first is the longest one of the dense tables; each further list has the contexts that are one byte longer.
        """
        best = at = np.zeros(size, np.int32)
        out = []
        for back in range(1, self.order + 1):
            before = np.full(size, self.symbols - 1, s.dtype)
            known = s[max(0, skip - back) : max(0, len(s) - back)]
            before[len(before) - len(known) :] = known
            for j in range(back):  # positions with less text before them than this
                early = starts + j
                early = early[(early < ends) & (early >= 0) & (early < size)]
                before[early] = self.symbols - 1
            if back <= self.depth:
                at = np.where(at >= 0, self.child.reshape(-1)[at * np.int32(self.symbols) + before], at)
                best = np.where(at >= 0, at, best)
            else:
                at = self._longer(at, before)
                out.append(at)
        return [best, *out]

    def _longer(self, at, before) -> np.ndarray:
        found = np.full(len(at), -1, np.int32)
        live = np.flatnonzero(at >= 0)
        if len(live) and len(self.links):
            want = at[live].astype(np.int64) * self.symbols + before[live]
            place = np.minimum(np.searchsorted(self.links, want), len(self.links) - 1)
            hit = self.links[place] == want
            found[live[hit]] = self.linked[place[hit]]
        return found

    def code(self, language: int, chain: list[np.ndarray], s) -> np.ndarray:
        """Code lengths of the bytes in one language."""
        index = chain[0] * np.int32(self.symbols) + s
        codes = self.codes[language][index]
        if not any((more >= 0).any() for more in chain[1:]):
            return codes
        live = np.flatnonzero(chain[1] >= 0)
        keys, lengths, escapes = self.deep[language]
        bits = self.exact[language][index[live]]
        for more in chain[1:]:
            own = np.flatnonzero(more[live] >= 0)
            context = more[live[own]]
            want = context.astype(np.int64) * self.symbols + s[live[own]]
            place = np.minimum(np.searchsorted(keys, want), max(len(keys) - 1, 0))
            hit = keys[place] == want if len(keys) else np.zeros(len(want), bool)
            longer = escapes[context] + bits[own]
            longer[hit] = lengths[place[hit]]
            bits[own] = longer
        codes = codes.copy()
        codes[live] = np.round(bits * UNIT).astype(np.uint16)
        return codes


def _count(order: int):
    """Counts of (context, byte) by language: the context length and its bytes packed in one number."""

    def keys_of(text: np.ndarray) -> list[np.ndarray]:
        text = text.astype(np.uint64)
        packed, keys = text, [text]
        for back in range(1, min(order, len(text) - 1) + 1):
            packed = packed[1:] | (text[:-back] << np.uint64(8 * back))
            keys.append(packed | np.uint64(back << 56))
        return keys

    def counted(lang: str, keys: list[np.ndarray]) -> pa.RecordBatch:
        key, n = np.unique(np.concatenate(keys), return_counts=True)
        columns = [pa.array([lang] * len(key)), pa.array(key.astype(np.int64)), pa.array(n.astype(np.int64))]
        return pa.RecordBatch.from_arrays(columns, names=["_lang", "key", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in tk.pieces(batches, "_text"):
            data, offsets = tk.buffers(tk.text_array(piece.column("_text")))
            languages = piece.column("_lang").to_pylist()
            for lang in sorted(set(languages)):
                keys, held = [], 0
                for i in (i for i, x in enumerate(languages) if x == lang):
                    keys += keys_of(data[offsets[i] : offsets[i + 1]])
                    held += int(offsets[i + 1] - offsets[i])
                    if held >= COUNT_BYTES:
                        yield counted(lang, keys)
                        keys, held = [], 0
                if held:
                    yield counted(lang, keys)

    return count


def learn(sample: DataFrame, order: int = 4, least: int = 8, table_bytes: int = 256 << 20) -> ContextTrees:
    """Context trees from a bounded sample (_lang, _text), with contexts of up to ``order`` bytes, 5 at most.

    A context is kept, for all languages, if some language has seen it ``least`` times; the empty one always is. So a
    language with few texts has the contexts that its own counts carry, whatever the others have. ``table_bytes`` bounds the
    tables that a worker makes, not what is learned: see ``ContextTrees``. Null and empty texts, texts of any length and repeated
    ones count as they are; null languages are left out; no texts give no languages.
    """
    if not 0 <= order <= 5:
        raise ValueError("order is 0 to 5")
    counted = sample.filter(F.col("_lang").isNotNull()).mapInArrow(_count(order), "_lang string, key long, n long")
    counted = counted.groupBy("_lang", "key").agg(F.sum("n").alias("n"))
    counted = counted.withColumn("name", F.shiftright("key", 8)).cache()
    try:
        seen = counted.groupBy("_lang", "name").agg(F.sum("n").alias("n")).groupBy("name").agg(F.max("n").alias("most"))
        kept = seen.filter((F.col("most") >= least) | (F.col("name") == 0)).select("name")
        # bounded by the sample: a row for ``least`` bytes of it at most in a context that only one language has
        table = counted.join(kept, "name", "left_semi").select("_lang", "key", "n").toArrow()
    finally:
        counted.unpersist()
    languages = sorted(pc.unique(table.column("_lang")).to_pylist())
    lang = pc.index_in(table.column("_lang"), value_set=pa.array(languages, pa.string())).to_numpy()
    key, n = (table.column(c).to_numpy().astype(np.int64) for c in ("key", "n"))
    # a name is the context's length, then its bytes: the one furthest back is the highest
    depth, body = key >> 56, key & ((1 << 56) - 1)
    name, byte = depth << 40 | body >> 8, (body & 255).astype(np.uint8)
    names = np.unique(name)
    at = np.searchsorted(names, name).astype(np.int32)
    counts = [(at[lang == k], byte[lang == k], n[lang == k]) for k in range(len(languages))]
    return ContextTrees(languages, order, names, counts, table_bytes)


def held_out(id_col: Column) -> Column:
    """Whether an id belongs to the fold that nothing is learned from."""
    return F.crc32(id_col.cast("string").cast("binary")) % 3 == 1


def training_sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, rows: int, longest: int = 1 << 20) -> DataFrame:
    """(_lang, _text): up to ``rows`` whole labelled texts a language, by the hash of id and text, none of the held-out fold.

    These two bound what is learned from: texts of over ``longest`` bytes and null texts teach nothing, and neither do
    rows with a null language or id. Rows that repeat an id are told apart by their texts; rows that repeat both teach once. An empty
    table gives no rows.
    """
    usable = docs.filter(F.col(lang_col).isNotNull() & (F.octet_length(text_col) <= longest) & ~held_out(F.col(id_col)))
    usable = usable.select(F.col(lang_col).alias("_lang"), F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    luck = F.xxhash64("_id", "_text", F.lit("ppm"))
    usable = usable.withColumn("_luck", luck)
    sizes = usable.groupBy("_lang").agg(F.approx_count_distinct("_luck").alias("_all"))
    # a row a language; the texts stay where they are
    sizes = if_small(Scratch(docs.sparkSession, "language-id").write(sizes, "sizes"))
    # about twice the rows that are wanted, in proportion to what differs; then each once, then exactly those wanted
    thinned = usable.join(sizes, "_lang").filter(F.pmod(F.col("_luck"), F.col("_all")) < 2 * rows)
    once = thinned.groupBy("_lang", "_luck").agg(F.min(F.struct("_id", "_text")).alias("_row"))
    first = Window.partitionBy("_lang").orderBy("_luck")
    return once.withColumn("_rank", F.row_number().over(first)).filter(F.col("_rank") <= rows).select("_lang", F.col("_row._text").alias("_text"))


def identify_language(
    docs: DataFrame, trees: ContextTrees, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """All columns of ``docs`` and lang_pred, lang_score, lang_bits (code bits per byte of the best language).

    Null texts and texts without any letter are ``und`` with score 0; so is everything if no language was learned. The
    score is the share of the best language if languages weigh 2 to the power of minus their code lengths. Ties go to the
    language first in order of name. Columns of these three names are replaced. Texts of any length are coded whole, in
    steps of bounded memory. Repeated rows get a row each; an empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(trees)  # counts only, bounded by the training sample
    added = ["lang_pred", "lang_score", "lang_bits"]
    rest = docs.drop(*added)
    schema = T.StructType(list(rest.schema.fields))
    schema = schema.add("lang_pred", "string").add("lang_score", "double").add("lang_bits", "double")

    def identify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = sent.value
        for piece in tk.pieces(batches, text_col):
            column = tk.text_array(piece.column(piece.schema.get_field_index(text_col)))
            pred, score, rate = [], [], []
            data, offsets = tk.buffers(column)
            lengths = trees.lengths(data, offsets)
            for text, row, size in zip(column.to_pylist(), lengths, np.diff(offsets).tolist(), strict=True):
                if not len(row) or not has_letter(text):
                    pred.append("und")
                    score.append(0.0)
                    rate.append(0.0)
                    continue
                best = int(row.argmin())
                pred.append(trees.languages[best])
                score.append(1.0 / float(np.exp2(np.maximum(row[best] - row, -60 * UNIT) / UNIT).sum()))
                rate.append(float(row[best]) / UNIT / size)
            yield pa.RecordBatch.from_arrays(
                [*piece.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(rate, pa.float64())],
                names=[*piece.schema.names, *added],
            )

    return rest.mapInArrow(identify, schema)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))
