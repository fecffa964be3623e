"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import collections
import hashlib
import math
import re

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def substring(docs, window):
    words = [SPACED.findall(t or "") for _, t in docs]
    count = collections.Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (key, _), w in zip(docs, words, strict=True):
        gone = set()
        for i in range(len(w) - window + 1):
            if count[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((key, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def lines(docs, min_words):
    """``docs`` in order; rows that repeat id and text are given once. Runs of all lengths, as long as any is repeated."""
    split = [(k, None if t is None else t.split("\n")) for k, t in docs]
    words = [[len(SPACED.findall(x)) for x in own or ()] for _, own in split]
    gone = {i: set() for i in range(len(docs))}
    alive = [(i, p) for i, (_, own) in enumerate(split) for p in range(len(own or ()))]
    size = 1
    while alive:
        at = collections.defaultdict(list)
        for i, p in alive:
            if p + size <= len(split[i][1]):
                at[tuple(split[i][1][p : p + size])].append((i, p))
        alive = sorted(x for places in at.values() if len(places) > 1 for x in places)
        for places in at.values():
            for i, p in places[1:]:
                if sum(words[i][p : p + size]) >= min_words:
                    gone[i].update(range(p, p + size))
        size += 1
    out = {}
    for i, (k, own) in enumerate(split):
        runs = sum(p - 1 not in gone[i] for p in gone[i])
        text = None if own is None else "\n".join(x for p, x in enumerate(own) if p not in gone[i])
        out[k] = (text, len(own or ()), len(gone[i]), runs)
    return out


def windows(docs, items, size):
    found = collections.defaultdict(set)
    for item, text in items:
        w = ALNUM.findall((text or "").translate(LOWER))
        n = min(size, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            found[tuple(w[i : i + n])].add("" if item is None else str(item))
    lengths = {len(k) for k in found}
    out = []
    for key, text in docs:
        w = ALNUM.findall((text or "").translate(LOWER))
        hit, names = set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in found:
                    hit.update(range(i, i + n))
                    names |= found[tuple(w[i : i + n])]
        out.append((key, len(w), len(hit), sorted(names)))
    return out


def ppm(sample, order, least, unit):
    """A function of texts: code lengths by language, from counts of bytes after contexts in dictionaries."""
    counts = collections.defaultdict(lambda: collections.defaultdict(collections.Counter))
    for lang, text in sample:
        data = text.encode()
        for i in range(len(data)):
            for d in range(min(order, i) + 1):
                counts[lang][data[i - d : i]][data[i]] += 1
    kept = {b""} | {c for by in counts.values() for c, seen in by.items() if seen.total() >= least}

    def bits(by, context, byte):
        seen = by.get(context, {})
        n = sum(seen.values())
        if byte in seen:
            return math.log2((n + len(seen)) / seen[byte])
        shorter = bits(by, context[1:], byte) if context else 8.0
        return shorter + (math.log2((n + len(seen)) / len(seen)) if seen else 0.0)

    def lengths(text):
        data, out, known = text.encode(), {}, {}
        for lang in sorted(counts):
            total = 0
            for i in range(len(data)):
                context = next(data[i - d : i] for d in range(min(order, i), -1, -1) if data[i - d : i] in kept)
                key = (lang, context, data[i])
                if key not in known:
                    known[key] = round(bits(counts[lang], context, data[i]) * unit)
                total += known[key]
            out[lang] = total
        return out

    return lengths


def shingles(text, size):
    w = SPACED.findall((text or "").translate(LOWER))
    if len(w) < size:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1))


def jaccard_components(docs, size, percent):
    sets = [shingles(t, size) for _, t in docs]
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least = {}
    for i, (key, _) in enumerate(docs):
        least.setdefault(root(i), []).append(key)
    name = {r: min((k for k in keys if k is not None), default=None) for r, keys in least.items()}
    return [(key, len(sets[i]), name[root(i)]) for i, (key, _) in enumerate(docs)]


def targets(sizes, weights=(5, 2, 1), total=1.5, most=2.0):
    """Targets by source: shares by weight, excess over a cap shared again until none is left."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, free, out = total * sum(sizes.values()), set(order), {}
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if level * weight[s] > most * sizes[s] + 1e-9}
        if not full:
            out.update({s: level * weight[s] for s in free})
            break
        for s in full:
            out[s] = most * sizes[s]
            left -= out[s]
        free -= full
    return out


def cotrain(luck, key, views, labels, q, exchange, rounds):
    """Two views that teach each other, on dictionaries by id; the regression is the library's."""
    import numpy as np

    ids = sorted(labels, key=lambda i: (luck[i], key[i]))
    learn, guard, rest = ([i for n, i in enumerate(ids) if n % 4 in part] for part in ((0, 1), (2,), (3,)))
    names = list(views)
    taught = {v: [(views[v][i], labels[i]) for i in learn] for v in names}
    n_learned = len(learn)

    def fit(v):
        more = len(taught[v]) - n_learned
        weight = [1.0] * n_learned + [q.PSEUDO_WEIGHT * min(1.0, n_learned / more)] * more if more else [1.0] * n_learned
        x, y = np.array([x for x, _ in taught[v]]), np.array([float(y) for _, y in taught[v]])
        return q.Logistic(q.RIDGES[names.index(v)]).fit(x, y, np.array(weight))

    def odds(model, v, i):
        return float(model.log_odds(views[v][i][None])[0])

    def loss(model, v):
        o, y = np.array([[odds(model, v, i)] for i in guard]), np.array([float(labels[i]) for i in guard])
        shown = q.Logistic().fit(o, y).log_odds(o)
        return np.array([math.log1p(math.exp(-z if yes else z)) for z, yes in zip(shown.tolist(), y.tolist(), strict=True)])

    models = {v: fit(v) for v in names}
    losses = {v: loss(models[v], v) for v in names}
    good = int(round(exchange * sum(labels[i] for i in learn) / n_learned))
    gone = {key[i] for i in ids}
    least = math.log(q.SURE / (1 - q.SURE))
    for _ in range(rounds):
        said = {v: [] for v in names}
        for v in names:
            for side, wanted in ((1, good), (0, exchange - good)):
                best = {}
                for i in luck:
                    if i not in labels and key[i] not in gone:
                        rank = -odds(models[v], v, i) if side else odds(models[v], v, i)
                        if rank <= -least and (key[i] not in best or rank < best[key[i]][0]):
                            best[key[i]] = (rank, i)
                said[v] += [(i, side) for k, (rank, i) in sorted(best.items(), key=lambda kv: (kv[1][0], kv[0]))[:wanted]]
        if not any(said.values()):
            break
        old = dict(models)
        for v in names:
            other = next(x for x in names if x != v)
            sure = [(i, s) for i, s in said[other] if (odds(old[v], v, i) if s else -odds(old[v], v, i)) > -least]
            if not said[other]:
                continue
            before = list(taught[v])
            taught[v] = before + [(views[v][i], s) for i, s in sure]
            model = fit(v)
            gap = loss(model, v) - losses[v]
            if gap.mean() <= gap.std() / math.sqrt(len(gap)):
                models[v], losses[v] = model, loss(model, v)
            else:
                taught[v] = before
        gone |= {key[i] for part in said.values() for i, _ in part}
    said = np.array([float(labels[i]) for i in rest])
    worth = {v: q.Logistic().fit(np.array([[odds(models[v], v, i)] for i in rest]), said) for v in names}
    both = {i: np.array([float(worth[v].log_odds(np.array([[odds(models[v], v, i)]]))[0]) for v in names]) for i in luck}
    last = q.Logistic().fit(np.array([both[i] for i in rest]), said)
    scores = {i: 1 / (1 + math.exp(-float(last.log_odds(x[None])[0]))) for i, x in both.items()}
    return {"scores": scores, "kept": tuple(len(taught[v]) - n_learned for v in names)}
