"""Quality classification by co-training.

Two views of a document: its text content (statistics of words and characters, and its words and word pairs, hashed) and its
page metadata (source, language, length and line layout). A logistic classifier per view learns from the labels; in each
round, either one labels the documents without a label that it is surest of, in the proportion of the classes, for the other
to learn from. The labels are dealt into three folds: one is learned from, a second judges whether a view keeps what it was
taught in a round, and the third, which neither has any part in, calibrates the views and weighs their log-odds into one
score for every document.

Features of all documents are made in one pass over the texts and kept as a table. Every round scores all documents without a
label on it, and finds the surest of all of them; the driver fits two small models to a bounded number of labelled rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm import textkernel as tk
from millrace.plans.staging import Scratch

_BYTES = np.arange(256)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_LETTER = _UPPER | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)
_STOP = np.isin(_BYTES, list(b".,;:'?-"))
_SPACE = ~tk.PLAIN
_SYMBOL = ~(_LETTER | _DIGIT | _STOP | _SPACE)
_CLASSES = np.stack([_UPPER, _DIGIT, _LETTER, _STOP, _SYMBOL, _BYTES >= 128])


#: Places that words, and as many that pairs of words, are hashed to.
WORD_PLACES = 128
#: Statistics that come before them; the one at _N_WORDS is 0 only for texts without words.
_STATISTICS, _N_WORDS = 16, 6


def _owned(w: tk.Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The windows of so many words that lie in one text, and their texts."""
    grams = tk.windows_of(w.hashes, size)
    owner = np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))
    inside = owner[: len(grams)] == owner[size - 1 :][: len(grams)]
    return grams[inside], owner[: len(grams)][inside]


def hashed_shares(w: tk.Words, size: int, places: int = WORD_PLACES) -> np.ndarray:
    """Per text and place, the square root of the share of its word windows of that size that are hashed to the place."""
    n = len(w.first) - 1
    grams, owner = _owned(w, size)
    where = ((grams >> np.uint64(17)) % np.uint64(places)).astype(np.int64)
    counts = np.bincount(owner * places + where, minlength=n * places).reshape(n, places)
    return np.sqrt(counts / np.maximum(counts.sum(1, keepdims=True), 1))


def _distinct(w: tk.Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text, how many of its windows are distinct, by 40 bits of their hashes, and how often the most frequent one occurs."""
    n = len(w.first) - 1
    grams, owner = _owned(w, size)
    keys = np.sort((owner.astype(np.uint64) << np.uint64(40)) | (grams >> np.uint64(24)))
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    heads = np.flatnonzero(new)
    texts = (keys[heads] >> np.uint64(40)).astype(np.int64)
    most = np.zeros(n, np.int64)
    np.maximum.at(most, texts, np.diff(np.append(heads, len(keys))))
    return np.bincount(texts, minlength=n), most


def content_features(column: pa.Array) -> np.ndarray:
    """Statistics of words and characters, then hashed words and word pairs, a row a text; one without words has zeros."""
    w = tk.words_of_column(column)
    n = len(w.first) - 1
    size = np.maximum(np.diff(w.offsets), 1)
    out = np.zeros((n, _STATISTICS))
    letters = symbols = None
    for i, mask in enumerate(_CLASSES):  # one class at a time, so that a long text takes 8 bytes a byte
        sums = np.zeros(len(w.data) + 1, np.int64)
        np.cumsum(mask[w.data], out=sums[1:])
        out[:, i] = (sums[w.offsets[1:]] - sums[w.offsets[:-1]]) / size
        if i == 2:
            letters = sums[w.end] - sums[w.start]
        elif i == 4:
            symbols = sums[w.end] - sums[w.start]
    words = np.diff(w.first)
    owner = np.repeat(np.arange(n), words)
    some = np.maximum(words, 1)

    def mean(values: np.ndarray) -> np.ndarray:
        return np.bincount(owner, values, minlength=n) / some

    length = (w.end - w.start).astype(float)
    again = np.zeros(len(owner))
    again[1:] = (w.hashes[1:] == w.hashes[:-1]) & (owner[1:] == owner[:-1])
    kinds, most = _distinct(w, 1)
    threes = np.maximum(words - 2, 0)
    average = mean(length)
    out[:, _N_WORDS:] = np.stack([
        np.log1p(words), np.log1p(average), np.log1p(np.sqrt(mean((length - average[owner]) ** 2))), kinds / some, most / some, mean(length <= 3),
        np.where(threes > 0, _distinct(w, 3)[0] / np.maximum(threes, 1), 1.0),
        np.bincount(owner, again, minlength=n) / np.maximum(words - 1, 1), mean(letters == 0), mean(symbols > 0),
    ], 1)
    out[words == 0] = 0
    return np.hstack([out, hashed_shares(w, 1), hashed_shares(w, 2)])


#: Places that languages and sources are hashed to.
LANG_PLACES, SOURCE_PLACES = 32, 64


def place(name: str, places: int) -> int:
    return zlib.crc32(name.encode()) % places


def metadata_features(column: pa.Array, source: list, lang: list) -> np.ndarray:
    """Length, line layout, hashed language and hashed source, a row a text; a null one has no place."""
    data, offsets = tk.buffers(column)
    out = np.zeros((len(source), 4 + LANG_PLACES + SOURCE_PLACES))
    feeds = np.flatnonzero(data == 10)
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        inner = feeds[np.searchsorted(feeds, a) : np.searchsorted(feeds, b)]
        lines = np.diff(np.concatenate([[a - 1], inner, [b]])) - 1
        out[i, :4] = np.log1p(b - a), np.log1p(len(lines)), np.log1p(lines.mean()), (lines < 20).mean()
    for i, (s, x) in enumerate(zip(source, lang, strict=True)):
        if x is not None:
            out[i, 4 + place(x, LANG_PLACES)] = 1
        if s is not None:
            out[i, 4 + LANG_PLACES + place(s, SOURCE_PLACES)] = 1
    return out


@dataclass
class Logistic:
    """Ridge logistic regression on standardised features, fitted by Newton steps."""

    ridge: float = 1.0
    mean: np.ndarray = field(default=None, repr=False)
    scale: np.ndarray = field(default=None, repr=False)
    weights: np.ndarray = field(default=None, repr=False)

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> Logistic:
        weight = np.ones(len(y)) if weight is None else weight
        if not np.isfinite(x).all():
            raise ValueError("a feature is not finite")
        self.mean, self.scale = x.mean(0), np.maximum(x.std(0), 1e-6)
        z = self._ready(x)
        w = np.zeros(z.shape[1])
        penalty = np.full(len(w), self.ridge)
        penalty[-1] = 1e-6
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            slope = z.T @ (weight * (p - y)) + penalty * w
            curve = (z * (weight * (p * (1 - p) + 1e-9))[:, None]).T @ z + np.diag(penalty)
            step = np.linalg.solve(curve, slope)
            w = w - step
            if np.abs(step).max() < 1e-8:
                break
        self.weights = w
        return self

    def _ready(self, x: np.ndarray) -> np.ndarray:
        return np.hstack([np.clip((x - self.mean) / self.scale, -8, 8), np.ones((len(x), 1))])

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self._ready(x) @ self.weights, -30, 30)


@dataclass
class CoTrained:
    """``calibrated``: by view, what its log-odds are worth. ``kept``: pseudo-labels that the content and the metadata view have
    learned from."""

    content: Logistic
    metadata: Logistic
    calibrated: tuple[Logistic, Logistic]
    combined: Logistic
    kept: tuple[int, int] = (0, 0)

    def scores(self, content: np.ndarray, metadata: np.ndarray) -> np.ndarray:
        """Probability of good quality: combined, by content, by metadata."""
        raw = self.content.log_odds(content), self.metadata.log_odds(metadata)
        views = np.stack([c.log_odds(x[:, None]) for c, x in zip(self.calibrated, raw, strict=True)], 1)
        return 1 / (1 + np.exp(-np.stack([self.combined.log_odds(views), views[:, 0], views[:, 1]], 1)))


#: Distinct texts that a view labels for the other one in a round.
EXCHANGE = 200
#: Probability that a view must give a class before it labels a text with it for the other one.
SURE = 0.95
#: What a pseudo-label weighs against a label, and all of them against all labels, at most.
PSEUDO_WEIGHT = 0.25
#: Ridge of either view's regression.
RIDGES = (10.0, 1.0)
#: Groups that the surest of all tasks are cut down in before the last cut.
_SHARDS = 64
_FEATURES = "_key long, content binary, metadata binary"


def quality_features(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang",
) -> DataFrame:
    """One row per row of ``docs``: _id, _key (a hash of the text), and the features of both views as packed 32-bit floats.

    Null texts have the features of empty ones, null sources and languages none. Columns other than those named are ignored,
    whatever their names; an empty table gives no rows.
    """
    text = F.col(text_col)
    plain = docs.select(
        F.col(id_col).alias("_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("_key"), text.alias("_text"),
        F.col(source_col).cast("string").alias("_source"), F.col(lang_col).cast("string").alias("_lang"),
    )

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in tk.pieces(batches, "_text"):
            column = tk.text_array(piece.column("_text"))
            source, lang = (piece.column(c).to_pylist() for c in ("_source", "_lang"))
            views = content_features(column), metadata_features(column, source, lang)
            packed = [pa.array([row.tobytes() for row in v.astype("<f4")], pa.binary()) for v in views]
            names = ["_id", "_key", "content", "metadata"]
            yield pa.RecordBatch.from_arrays([piece.column("_id"), piece.column("_key"), *packed], names=names)

    schema = T.StructType([T.StructField("_id", docs.schema[id_col].dataType)])
    for f in T._parse_datatype_string(_FEATURES).fields:
        schema = schema.add(f)
    return plain.mapInArrow(make, schema)


def unpacked(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    rows = len(column)
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, "<f4").reshape(rows, -1).astype(float) if rows else np.zeros((0, 0))


def surest(
    features: DataFrame, models: list[Logistic], good: int, bad: int, taken: np.ndarray, sure: float = SURE
) -> pa.Table:
    """The documents that either view is surest of: view, rank (log-odds, negative for good ones), _key, content, metadata.

    Of each view, the ``good`` texts with the highest and ``bad`` ones with the lowest log-odds of all rows of ``features``, as
    far as the view gives their class a probability of ``sure``. Of equal texts one counts, that with the surest odds, and ties
    go by the hash of the text. ``taken`` are keys to leave out.
    """
    least = float(np.log(sure / (1 - sure)))
    sent = features.sparkSession.sparkContext.broadcast((models, taken))
    wanted = [(0, 1, good), (0, 0, bad), (1, 1, good), (1, 0, bad)]

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models, taken = sent.value
        names = ["view", "side", "rank", "_key", "content", "metadata"]
        held: list[pa.Table | None] = [None] * len(wanted)
        for batch in batches:
            key = batch.column("_key").to_numpy()
            free = ~np.isin(key, taken)
            if not free.any():
                continue
            batch, key = batch.filter(pa.array(free)), key[free]
            odds = [models[v].log_odds(unpacked(batch.column(c))) for v, c in enumerate(("content", "metadata"))]
            for i, (view, side, n) in enumerate(wanted):
                rank = -odds[view] if side else odds[view]
                order = np.lexsort((key, rank))
                order = order[rank[order] <= -least]
                first = np.sort(np.unique(key[order], return_index=True)[1])[:n]
                at = pa.array(order[first])
                m = len(first)
                own = [pa.array(np.full(m, view, np.int32)), pa.array(np.full(m, side, np.int32)), pa.array(rank).take(at)]
                new = pa.table([*own, *[batch.column(c).take(at) for c in names[3:]]], names)
                both = new if held[i] is None else pa.concat_tables([held[i], new])
                rank, keys = both.column("rank").to_numpy(), both.column("_key").to_numpy()
                order = np.lexsort((keys, rank))
                first = np.sort(np.unique(keys[order], return_index=True)[1])[:n]
                held[i] = both.take(pa.array(order[first]))
        for table in held:
            if table is not None:
                yield from table.combine_chunks().to_batches()

    found = features.mapInArrow(best, f"view int, side int, rank double, {_FEATURES}")
    # of tasks, then of shards: no group has more rows than shards times the number wanted
    row = F.struct("rank", "content", "metadata")
    found = found.groupBy("view", "side", "_key").agg(F.min(row).alias("_row")).select("view", "side", "_key", "_row.*")
    limit = F.when(F.col("side") == 1, good).otherwise(bad)
    for group in (["view", "side", F.pmod("_key", F.lit(_SHARDS))], ["view", "side"]):
        nth = F.row_number().over(Window.partitionBy(*group).orderBy("rank", "_key"))
        found = found.withColumn("_nth", nth).filter(F.col("_nth") <= limit).drop("_nth")
    table = found.toArrow().sort_by([("view", "ascending"), ("side", "ascending"), ("rank", "ascending"), ("_key", "ascending")])
    sent.destroy()
    return table


def log_losses(model: Logistic, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Losses of a view on labels once its log-odds are calibrated on them: how well it tells classes, not how sure it is."""
    odds = model.log_odds(x)[:, None]
    calibrated = Logistic().fit(odds, y).log_odds(odds) if len(y) else odds[:, 0]
    return np.logaddexp(0, (1 - 2 * y) * calibrated)


def pseudo_weights(labels: int, total: int) -> np.ndarray:
    """Weights of labels, 1 each, and of the pseudo-labels after them: less each, and at most that share of the labels together."""
    weight = np.ones(total)
    weight[labels:] = PSEUDO_WEIGHT * min(1.0, labels / max(1, total - labels))
    return weight


def not_worse(before: np.ndarray, after: np.ndarray) -> bool:
    """Whether losses on the same labels have not risen by more than the standard error of their difference."""
    gap = after - before
    return not len(gap) or float(gap.mean()) <= float(gap.std()) / np.sqrt(len(gap))


def not_contradicted(model: Logistic, x: np.ndarray, said: np.ndarray) -> np.ndarray:
    """Pseudo-labels but for those of whose opposite the learning view is as sure as the other one is of them."""
    return (2 * said - 1) * model.log_odds(x) > -np.log(SURE / (1 - SURE))


def train_on_features(
    features: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", label_rows: int = 8_000,
    exchange: int = EXCHANGE, rounds: int = 5,
) -> CoTrained | None:
    """Co-trains on ``quality_features``, best a written table, as ``train_quality`` does."""
    luck = F.xxhash64("_id", F.lit("quality"))
    said = labels.groupBy(F.col(id_col).alias("_id")).agg(F.min(label_col).alias("_low"), F.max(label_col).alias("_high"))
    said = said.filter("_id is not null and _low = _high").select("_id", F.col("_low").cast("double").alias("_label"))
    chosen = F.broadcast(said.filter(F.pmod(luck, F.lit(max(said.count(), 1))) < label_rows))
    row = F.struct("_key", "_label", "content", "metadata")
    known = features.join(chosen, "_id").groupBy("_id").agg(F.min(row).alias("_row"))
    table = known.select(luck.alias("_luck"), "_row.*").toArrow().sort_by([("_luck", "ascending"), ("_key", "ascending")])
    y = table.column("_label").to_numpy()
    fold = np.arange(len(y)) % 4
    learn, guard, rest = fold < 2, fold == 2, fold == 3
    if len(y) < 8 or len(set(y[learn].tolist())) < 2 or len(set(y[rest].tolist())) < 2:
        return None
    free = features.join(chosen.select("_id"), "_id", "left_anti")
    own = [unpacked(table.column(c)) for c in ("content", "metadata")]
    learned = [[(x[learn], y[learn])] for x in own]

    def fitted(v: int) -> Logistic:
        x, said = (np.concatenate(part) for part in zip(*learned[v], strict=True))
        return Logistic(RIDGES[v]).fit(x, said, pseudo_weights(int(learn.sum()), len(said)))

    good = int(round(exchange * y[learn].mean()))
    models, taken = [fitted(0), fitted(1)], np.unique(table.column("_key").to_numpy())
    losses = [log_losses(models[v], own[v][guard], y[guard]) for v in (0, 1)]
    for _ in range(rounds):
        found = surest(free, models, good, exchange - good, taken)
        if not found.num_rows:
            break
        view, said_good = found.column("view").to_numpy(), found.column("side").to_numpy().astype(float)
        before = list(models)
        for v, c in enumerate(("content", "metadata")):
            x, said = unpacked(found.column(c))[view != v], said_good[view != v]
            if len(said):
                new = not_contradicted(before[v], x, said)
                learned[v].append((x[new], said[new]))
                model = fitted(v)
                after = log_losses(model, own[v][guard], y[guard])
                if not_worse(losses[v], after):
                    models[v], losses[v] = model, after
                else:  # wrong labels of a weaker view are not learned
                    learned[v].pop()
        taken = np.union1d(taken, found.column("_key").to_numpy())
    raw = [models[v].log_odds(own[v][rest])[:, None] for v in (0, 1)]
    calibrated = tuple(Logistic().fit(x, y[rest]) for x in raw)
    odds = np.hstack([c.log_odds(x)[:, None] for c, x in zip(calibrated, raw, strict=True)])
    kept = tuple(sum(len(y) for _, y in part[1:]) for part in learned)
    return CoTrained(models[0], models[1], calibrated, Logistic().fit(odds, y[rest]), kept)


def train_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    lang_col: str = "lang", label_col: str = "quality", label_rows: int = 8_000, exchange: int = EXCHANGE, rounds: int = 5,
) -> CoTrained | None:
    """Co-trains on about ``label_rows`` labelled documents, chosen by the hash of their ids, and all the others.

    Half of the labels are learned from, a quarter guards the rounds and a quarter calibrates. In each round, either view labels
    the ``exchange`` distinct texts that it is surest of among all documents whose labels were not chosen, at a probability of
    ``SURE`` or more; these weigh ``PSEUDO_WEIGHT`` of a label, and no more than that share of all labels together. A view does not learn labels of whose opposite it is as sure itself, and keeps what it was taught in a round
    if its calibrated log loss on the guard's labels does not rise by more than its standard error. Ids whose labels are null or disagree count as
    unlabelled. Null ids match no label; of rows that repeat a labelled id, the one with the smallest text hash teaches. Null
    texts have no content, null sources and languages no feature. None if there are fewer than 8 labels or only one class, as
    for empty tables. Columns other than those named are ignored, whatever their names. A very long text is held whole, at some
    30 bytes a byte.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    features = scratch.write(quality_features(docs, id_col, text_col, source_col, lang_col), "features")
    model = train_on_features(features, labels, id_col, label_col, label_rows, exchange, rounds)
    scratch.close()
    return model


def score_features(features: DataFrame, model: CoTrained | None, id_col: str = "doc_id", threshold: float = 0.5) -> DataFrame:
    """As ``score_quality``, from ``quality_features``."""
    sent = features.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            content, metadata = (unpacked(batch.column(c)) for c in ("content", "metadata"))
            p = model.scores(content, metadata) if model else np.ones((batch.num_rows, 3))
            p[content[:, _N_WORDS] == 0] = 0.0
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), *[pa.array(p[:, i]) for i in range(3)], pa.array(p[:, 0] >= threshold)],
                names=["_id", "score", "content_score", "metadata_score", "keep"],
            )

    schema = T.StructType([T.StructField("_id", features.schema["_id"].dataType)])
    for name in ("score", "content_score", "metadata_score"):
        schema = schema.add(name, "double")
    return features.mapInArrow(score, schema.add("keep", "boolean")).withColumnRenamed("_id", id_col)


def score_quality(
    docs: DataFrame, model: CoTrained | None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    lang_col: str = "lang", threshold: float = 0.5,
) -> DataFrame:
    """One row per row of ``docs``: id, score, content_score, metadata_score, keep (score at least ``threshold``).

    Null and empty texts have no content and score 0. Null sources and languages have no feature of their own. Without a
    model, every text that has words scores 1. Repeated rows score alike; an empty table gives no rows.
    """
    return score_features(quality_features(docs, id_col, text_col, source_col, lang_col), model, id_col, threshold)
