"""Sharding, whitening and the Merkle manifest against plain versions."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import queries
from millrace.llm.merkle import block_levels, folded, leaf_digest, merkle_manifest, proof_digest
from millrace.llm.ranks import byte_digits, id_digits, radix_ranks
from millrace.llm.sharding import SlotMap, SlotMaps, rebalanced, shard_documents, shard_sizes, slot_loads, write_shards
from millrace.llm.whitening import Moments, fit_whitening, identity_error, whiten, whole_numbers
from millrace.plans.staging import Scratch

SMALL = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def documents():
    """Null ids, languages and texts, repeated ids, repeated rows, an id that a third of the rows have, a long text."""
    r = random.Random(3)
    out = [(i * r.choice([1, 1, 300, 1 << 40]) * r.choice([1, 1, 1, -1]), f"text {i} ß", r.choice(["de", "en", "é", "", None]), i) for i in range(120)]
    out += [(7, f"hot {i}", "en", None) for i in range(60)] + [(8, "same", "en", 1)] * 40
    out += [(None, "a", "de", 1), (None, None, "de", 1), (None, "a", None, 2), (9, None, "lone", None), (10, "x" * 200_000, "en", 5), (11, "", "en", 5)]
    return out


SCHEMA = "doc_id long, text string, lang string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(documents(), SCHEMA).repartition(3)
    clashing = ["shard", "slot", "rank", "_g", "_rank", "leaf", "size", "_slot", "_d0_0", "proof", "whitened"]
    return df.withColumns({c: F.lit("clash") for c in clashing}).cache()


# ---- ranks

@pytest.mark.parametrize("most", [1, 5, 1 << 16])
def test_ranks_are_those_of_a_sort(spark, most):
    r = random.Random(1)
    special = [None, -(1 << 63), (1 << 63) - 1, 0, -1, 1 << 16, (1 << 32) + 5]
    ids = special + [r.randrange(-(1 << 40), 1 << 40) for _ in range(80)] + list(range(80))
    ids = list(dict.fromkeys(ids))
    rows = [(k, f"g{0 if i % 3 else i % 9}") for i, k in enumerate(ids)]
    df = spark.createDataFrame(rows, "k long, g string").repartition(3)
    digits = id_digits(F.col("k"))
    got = radix_ranks(df, ["g"], [digits[:2], digits[2:4], digits[4:]], ["k"], Scratch(spark, "test"), most).collect()
    want = {}
    for g in {g for _, g in rows}:
        own = sorted((k for k, x in rows if x == g), key=lambda k: (k is not None, k or 0))
        want |= {(g, k): i for i, k in enumerate(own)}
    assert {(x.g, x.k): x._rank for x in got} == want and len(got) == len(rows)


def test_byte_digits_order_as_bytes(spark):
    texts = ["", "a", "ab", "aé", "b", "é", "a\x00", "\U0001f600", "￿"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", byte_digits(F.col("t"), 1).alias("a"), byte_digits(F.col("t"), 3).alias("b"), byte_digits(F.col("t"), 5).alias("c"))
    assert [r.t for r in sorted(df.collect(), key=lambda r: (r.a, r.b, r.c))] == sorted(texts, key=lambda t: t.encode())


# ---- sharding

def test_a_further_shard_takes_slots_only_into_itself():
    m = SlotMap.even(1, 1000)
    for n in range(2, 60):
        new = m.grown()
        assert {new.owners[i] for i in m.moved(new)} <= {n - 1} and max(new.counts()) - min(new.counts()) <= 1
        assert new == SlotMap.even(n, 1000)
        m = new
    with pytest.raises(ValueError):
        SlotMap(3, (0, 1, 5))


def test_rebalancing_evens_bytes():
    r = random.Random(2)
    sizes = {i: int(r.paretovariate(1.2) * 1000) for i in range(1024) if i % 5}
    old = SlotMap.even(16, 1024)
    new = rebalanced(old, sizes, 0.01)
    load = collections.Counter()
    for slot, size in sizes.items():
        load[new.owners[slot]] += size
    limit, largest = 1.01 * sum(sizes.values()) / 16, max(sizes.values())
    assert all(v <= max(limit, largest) for v in load.values())
    assert all(sizes.get(i) for i in old.moved(new))
    assert rebalanced(new, sizes, 0.01) == new
    assert rebalanced(old, {}) == old
    hot = {0: 10**9} | {i: 10 for i in range(1, 64)}
    new = rebalanced(SlotMap.even(4, 64), hot)
    assert [i for i, s in enumerate(new.owners) if s == new.owners[0]] == [0]


def test_slot_maps_are_versions(spark):
    maps = SlotMaps(spark, Scratch(spark, "maps").folder)
    assert maps.version() == 0
    first = SlotMap.even(5, 64)
    assert maps.commit(first) == 1 and maps.commit(first.grown()) == 2
    assert maps.load(1) == first and maps.load() == first.grown() and maps.version() == 2


def plain_shards(rows, slot_map):
    out = []
    for k, text, *_ in rows:
        h = hashlib.md5(("" if k is None else str(k)).encode()).hexdigest()
        slot = int(h[:8], 16) % len(slot_map.owners)
        data = (text or "").encode()
        out.append((k, len(data) + 16, zlib.crc32(data), slot, slot_map.owners[slot], h))
    return out


@pytest.mark.parametrize("most", [None, 3])
def test_shard_documents(docs, most):
    old = SlotMap.even(8, 64)
    rows = shard_documents(docs, old, old.grown(), most=most).collect()
    want = plain_shards(documents(), old)
    assert collections.Counter((r.doc_id, r.size, r.text_crc32, r.virtual_slot, r.shard) for r in rows) == collections.Counter(w[:5] for w in want)
    hashes = {w[0]: w[5] for w in want}
    by, loads = collections.defaultdict(list), collections.defaultdict(lambda: [0, 0])
    for r in rows:
        by[r.shard].append((r.slot, r.virtual_slot, hashes[r.doc_id][8:]))
        loads[r.virtual_slot][0] += 1
        loads[r.virtual_slot][1] += r.size
        assert r.next_shard == old.grown().owners[r.virtual_slot]
    for own in by.values():
        own.sort()
        assert [x[0] for x in own] == list(range(len(own))) and [x[1:] for x in own] == sorted(x[1:] for x in own)
    assert all([r.slot_rows, r.slot_bytes] == loads[r.virtual_slot] for r in rows)
    assert {r.virtual_slot: [r.slot_rows, r.slot_bytes] for r in slot_loads(docs, 64).collect()} == loads


def test_sharding_edges(docs):
    old = SlotMap.even(3, 16)
    assert shard_documents(docs.limit(0), old).count() == 0
    one = shard_documents(docs.filter("doc_id = 9"), old).collect()
    assert [(r.size, r.text_crc32, r.slot, r.next_shard) for r in one] == [(16, 0, 0, None)]
    sizes = shard_sizes(shard_documents(docs, old)).collect()
    assert sum(r.rows for r in sizes) == len(documents())


def test_written_shards_hold_all_rows(spark, docs):
    slot_map, path = SlotMap.even(4, 64), Scratch(spark, "shards").folder
    back = write_shards(docs, slot_map, path, file_bytes=1000)
    rows = back.select("doc_id", "text", "shard", F.input_file_name().alias("file")).collect()
    assert collections.Counter((r.doc_id, r.text) for r in rows) == collections.Counter((d[0], d[1]) for d in documents())
    shard = {w[0]: w[4] for w in plain_shards(documents(), slot_map)}
    assert all(int(r.shard) == shard[r.doc_id] for r in rows)
    # the rows that share an id are dealt to more than one file
    assert len({r.file for r in rows if r.doc_id == 7}) > 1


# ---- whitening

def vectors(r, n, d):
    base = np.array([[r.gauss(0, 1 + j) for j in range(d)] for _ in range(n)])
    base[:, 1] += 2 * base[:, 0]
    return base.astype(np.float32)


def test_whitening_is_that_of_numpy(spark):
    r = random.Random(9)
    v = vectors(r, 300, 6)
    rows = [(i, x.tolist(), "clash") for i, x in enumerate(v)] + [(1000 + i, v[0].tolist(), "clash") for i in range(150)]
    bad = [(-1, None, "c"), (-2, [], "c"), (-3, [1.0] * 5 + [None], "c"), (-4, [float("nan")] + [0.0] * 5, "c"), (-5, [float("inf")] + [0.0] * 5, "c"), (-6, [1.0] * 5, "c"), (-7, [1e30] * 6, "c")]
    extra = [(None, v[1].tolist(), "c"), (3, v[3].tolist(), "c")]
    df = spark.createDataFrame(rows + bad + extra, "vec_id long, embedding array<float>, whitened string").repartition(5)
    model = fit_whitening(df, components=4)
    good = [(k, x) for k, x, _ in rows + extra]
    x = np.floor(64 * np.array([x for _, x in good], np.float32).astype(float)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(0)
    assert model.n == n and [int(a) + n * 1_000_000 for a in model.sums] == s.tolist()
    centred = x - s / n
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1], u[:, ::-1]
    assert np.allclose(model.eigenvalues, e[:4], rtol=1e-12) and np.allclose(model.explained, e[:4] / e.sum(), rtol=1e-10)
    assert np.allclose(np.abs(model.components), np.abs(u[:, :4]), atol=1e-9)
    white = whiten(df, model)
    got = collections.Counter((r.vec_id, int(r.deviation), tuple(round(abs(w), 6) for w in r.whitened)) for r in white.collect())
    far = [sum(int(n * a - b) ** 2 for a, b in zip(row.tolist(), s.tolist(), strict=True)) for row in x]
    z = np.abs(centred @ u[:, :4] / np.sqrt(e[:4]))
    assert got == collections.Counter((k, f, tuple(np.round(w, 6).tolist())) for (k, _), f, w in zip(good, far, z, strict=True))
    assert identity_error(white) < 1e-9


def test_whitening_edges(spark):
    schema = "vec_id long, embedding array<float>"
    empty = spark.createDataFrame([], schema)
    assert fit_whitening(empty) is None and whiten(empty, None).count() == 0 and identity_error(whiten(empty, None)) == 0.0
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], schema)
    model = fit_whitening(same)
    assert model.n == 5 and not len(model.eigenvalues)
    assert [r.whitened for r in whiten(same, model).collect()] == [[]] * 5 and identity_error(whiten(same, model)) == 0.0
    line = spark.createDataFrame([(i, [float(i), 3.0]) for i in range(9)], schema)
    model = fit_whitening(line)
    assert len(model.eigenvalues) == 1 and identity_error(whiten(line, model)) < 1e-12
    wide = spark.createDataFrame([(i, [float(i) * 1e13, float(i * i)]) for i in range(4)], "vec_id long, embedding array<double>")
    model = fit_whitening(wide)
    far = {r.vec_id: r.deviation for r in whiten(wide, model).collect()}
    x = [[int(64e13) * i, 64 * i * i] for i in range(4)]
    total = [sum(c) for c in zip(*x, strict=True)]
    assert far == {i: sum((4 * a - b) ** 2 for a, b in zip(x[i], total, strict=True)) for i in range(4)}


def test_moments_merge_as_if_computed_at_once():
    r = np.random.default_rng(4)
    y = (r.normal(size=(500, 7)) * 1000).astype(np.int64) + 10**9
    whole = Moments.of(y)
    parts = [Moments.of(p) for p in np.array_split(y, 9)]
    while len(parts) > 1:
        parts = [parts[i].merged(parts[i + 1]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    assert parts[0].n == 500 and (parts[0].sums == whole.sums).all()
    assert np.allclose(parts[0].mean, whole.mean, rtol=1e-15)
    assert np.abs(parts[0].scatter - whole.scatter).max() < 1e-13 * np.abs(whole.scatter).max()
    big = np.full((3, 1), (1 << 53) - 1)
    assert Moments.of(big).sums.tolist() == [3 * ((1 << 53) - 1)]


def test_whole_numbers_round_down():
    import pyarrow as pa

    column = pa.array([[-0.01, 0.5], None, [], [1.0], [None, 1.0]], pa.list_(pa.float32()))
    usable, found = whole_numbers(column, 64, 1_000_000)
    assert usable.tolist() == [True, False, False, True, False]
    assert [(at.tolist(), y.tolist()) for at, y in found] == [([3], [[64]]), ([0], [[-1, 32]])]


def test_whitening_query(spark):
    rows = queries.op12_whiten_embeddings(spark, SMALL).collect()
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    assert len(rows) == len(table) * 32 and {r.component for r in rows} == set(range(1, 33)) and {r.n for r in rows} == {len(table)}
    white = np.zeros((len(table), 32))
    place = {r.vec_id: i for i, r in enumerate(table)}
    for r in rows:
        white[place[r.vec_id], r.component - 1] = r.whitened
    assert np.abs(np.cov(white.T, bias=True) - np.eye(32)).max() < 1e-9 and rows[0].identity_error < 1e-9


# ---- Merkle

def plain_field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_tree(leaves, fanout):
    """All levels, from the leaves to the root."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + fanout])) for i in range(0, len(levels[-1]), fanout)])
    return levels


def plain_proof(levels, at, fanout):
    out = []
    for level in levels[:-1]:
        first = at - at % fanout
        out.append((at % fanout, [x for i, x in enumerate(level[first : first + fanout]) if i != at % fanout]))
        at //= fanout
    return out


def plain_manifest(rows, fanout):
    by = collections.defaultdict(list)
    for k, text, lang, n in rows:
        by[lang].append((k is not None, k or 0, sha("".join(map(plain_field, (k, lang, n, text)))), k))
    names = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = {g: plain_tree([leaf for *_, leaf, _ in sorted(by[g])], fanout) for g in names}
    top = plain_tree([trees[g][-1][0] for g in names], fanout)
    out = []
    for i, g in enumerate(names):
        above = plain_proof(top, i, fanout)
        for rank, (_, _, leaf, k) in enumerate(sorted(by[g])):
            out.append((k, g, leaf, rank, trees[g][-1][0], top[-1][0], plain_proof(trees[g], rank, fanout) + above))
    return out


def shown(r):
    return (r.doc_id, r.lang, r.leaf, r.rank, r.subroot, r.root, [(s.place, s.siblings) for s in r.proof])


@pytest.mark.parametrize(("fanout", "most", "block"), [(2, None, 256), (2, 4, 4), (3, 50, 9), (16, None, 256)])
def test_merkle_manifest(docs, monkeypatch, fanout, most, block):
    monkeypatch.setattr("millrace.llm.merkle.BLOCK_NODES", block)
    leaf = leaf_digest([F.col(c) for c in ("doc_id", "lang", "n_chars", "text")])
    made = merkle_manifest(docs.withColumn("leaf", leaf), carry=["n_chars"], fanout=fanout, most=most)
    got = made.withColumns({"back": folded(F.col("leaf"), F.col("proof")), "sha": proof_digest(F.col("proof"))}).collect()
    assert sorted(map(repr, map(shown, got))) == sorted(map(repr, plain_manifest(documents(), fanout)))
    for r in got:
        assert r.back == r.root and r.sha == sha("".join(x for s in r.proof for x in s.siblings))


def test_merkle_edges(spark, docs):
    df = docs.withColumn("leaf", F.sha2(F.coalesce("text", F.lit("")), 256))
    assert merkle_manifest(df.limit(0)).count() == 0
    (one,) = merkle_manifest(df.filter("doc_id = 9")).collect()
    assert one.leaf == one.subroot == one.root and one.proof == [] and one.lang == "lone"
    many = spark.range(700).select(F.col("id").alias("doc_id"), F.concat(F.lit("language-"), F.col("id")).alias("lang"), F.sha2(F.col("id").cast("string"), 256).alias("leaf"))
    got = merkle_manifest(many, most=50).collect()
    names = sorted((f"language-{i}" for i in range(700)), key=str.encode)
    top = plain_tree([sha(n.removeprefix("language-")) for n in names], 2)
    assert len(got) == 700 and {r.root for r in got} == {top[-1][0]}
    assert all([(s.place, s.siblings) for s in r.proof] == plain_proof(top, names.index(r.lang), 2) for r in got)


def test_merkle_block_levels_end_with_lone_nodes():
    assert [len(x) for x in block_levels(["a", "b", "c"], 2, 4)] == [3, 2, 1, 1, 1]
    assert block_levels(["a"], 2, 1)[-1] == [sha("a")] and block_levels(["a"], 2, 0) == [["a"]]


def test_merkle_query_finds_what_was_tampered(spark):
    rows = queries.op13_merkle_manifest(spark, SMALL).collect()
    chars = {r.doc_id: r.n_chars for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "n_chars").collect()}
    assert len(rows) == len(chars)
    for r in rows:
        tampered = zlib.crc32(str(r.doc_id).encode()) % 7 == 0 and chars[r.doc_id] is not None
        assert r.verified is not tampered


def test_heights(spark):
    for n in (1, 3, 257):
        df = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("x").alias("lang"), F.sha2(F.col("id").cast("string"), 256).alias("leaf"))
        rows = merkle_manifest(df).collect()
        levels = plain_tree([sha(str(i)) for i in range(n)], 2)
        assert {r.root for r in rows} == {levels[-1][0]} and {len(r.proof) for r in rows} == {math.ceil(math.log2(n))}
