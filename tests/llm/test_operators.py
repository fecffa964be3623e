import collections
import json
import random
import zlib

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import chat, language_id, ngram_join
from millrace.llm import quality as q
from millrace.llm import substring_dedup as substring_module
from millrace.llm import textkernel as tk
from millrace.llm.decontaminate import find_windows, remove_windows
from millrace.llm.exact_dedup import exact_dedup
from millrace.llm.language_id import held_out, identify_language, learn, training_sample
from millrace.llm.line_dedup import line_dedup
from millrace.llm.mixing import mix_sources, mixed_documents, source_targets
from millrace.llm.substring_dedup import SuffixAutomaton, substring_dedup
from millrace.llm.url_filter import filter_urls

SCHEMA = "doc_id long, text string, lang string, source string, _k1 string, n string"
SMALL = "/root/testdata/sf0.001"


def sample():
    """Texts with copies, near copies, shared passages and lines, long and periodic texts, nulls, ties and repeated rows."""
    r = random.Random(5)
    vocabulary = [f"w{i}é" if i % 7 == 0 else f"w{i}" for i in range(400)]

    def words(n):
        return [r.choice(vocabulary) for _ in range(n)]

    passage, line = words(40), " ".join(words(6))
    docs = []
    for i in range(30):
        w = words(r.randint(20, 120))
        if i % 3 == 0:
            w[10:10] = passage[: r.randint(30, 40)]
        docs.append((i, " ".join(w) if i % 4 else line + "\n" + " ".join(w[:20]) + "\n" + " ".join(w[20:])))
    base = words(200)
    for i in range(30, 44):
        w = list(base)
        for _ in range(r.randint(0, 6)):
            w[r.randrange(len(w))] = r.choice(vocabulary)
        docs.append((i, " ".join(w)))
    docs += [
        (50, docs[1][1]), (51, docs[1][1]), (52, docs[1][1].upper()), (53, None), (54, ""), (55, " \n\t "), (56, "a " * 300), (57, "a b " * 150),
        (58, "one two three"), (59, "One two  three"), (60, "x\ny\nx\ny\nx\ny\nz w v"), (61, line), (62, f"\n\n{line}\n{line}\n\n"), (63, "ß" * 9000),
        (None, docs[2][1]), (None, None), (64, " ".join(words(4000))), (65, None),
    ]
    docs += [docs[3], docs[3]]
    return [(k, t, "xx" if k is None else "yy", "s%d" % (zlib.crc32(str(k).encode()) % 4) if k != 5 else None, "clash", "clash") for k, t in docs]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(sample(), SCHEMA).repartition(3).cache()


def pairs():
    return [(d[0], d[1]) for d in sample()]


def got(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


def test_exact_dedup(spark, docs):
    rows = exact_dedup(docs, keep="largest", fan_in=2, run_rows=10).collect()
    groups = collections.defaultdict(list)
    for k, t in pairs():
        groups[t or ""].append(k)
    assert len(rows) == len(pairs())
    by = collections.Counter((r.text_sha256, r.keep_id, r.group_size) for r in rows)
    best = {t: max((k for k in ks if k is not None), default=None) for t, ks in groups.items()}
    assert by == collections.Counter({(brute.sha(t), best[t], len(ks)): len(ks) for t, ks in groups.items()})
    kept = collections.Counter(r.text_sha256 for r in rows if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len(groups)
    assert exact_dedup(docs.limit(0)).count() == 0
    smallest = {r.text_sha256: r.keep_id for r in exact_dedup(docs).collect()}
    assert smallest[brute.sha(pairs()[1][1])] == 1


def test_substring_dedup(docs):
    for window in (8, 35):
        want = sorted(map(repr, brute.substring(pairs(), window)))
        assert got(substring_dedup(docs, window=window, gram=3 if window == 8 else 12)) == want
    assert substring_dedup(docs.limit(0)).count() == 0


def test_substring_dedup_splits_hot_anchors(docs, monkeypatch):
    monkeypatch.setattr("millrace.llm.substring_dedup.SHARD_CONTENTS", 1)
    monkeypatch.setattr("millrace.llm.substring_dedup.LIST_BYTES", 0)
    assert got(substring_dedup(docs, window=8, gram=3)) == sorted(map(repr, brute.substring(pairs(), 8)))


def test_substring_dedup_keeps_no_hot_window_in_one_group(spark, monkeypatch):
    limit, passage, real = 10, " ".join(f"p{i}" for i in range(12)), substring_module._judge

    def watched(window):
        judge = real(window)

        def run(batches):
            held = collections.Counter()

            def seen():
                for b in batches:
                    held.update(zip(*(b.column(c).to_pylist() for c in ("anchor", "part") if c in b.schema.names), strict=True))
                    yield b

            yield from judge(seen())
            assert max(held.values(), default=0) <= limit, held

        return run

    monkeypatch.setattr(substring_module, "SHARD_CONTENTS", limit)
    monkeypatch.setattr(substring_module, "_judge", watched)
    texts = [(i, f"a{i} b{i} c{i} {passage} d{i} e{i}") for i in range(60)] + [(60, "p0 p1 p2 p3 p4 p5 p6 p7 p8 p9 p10"), (61, passage)]
    texts += [texts[0], (62, f"{passage} once only here")]
    for most in (0, 1 << 24):
        monkeypatch.setattr(substring_module, "WINDOW_BYTES", most)
        rows = substring_dedup(spark.createDataFrame(texts, "doc_id long, text string"), window=8, gram=3)
        assert got(rows) == sorted(map(repr, brute.substring(texts, 8)))


def test_suffix_automaton_counts_all_substrings():
    r = random.Random(1)
    texts = [[r.randrange(3) for _ in range(r.randint(0, 30))] for _ in range(6)]
    automaton = SuffixAutomaton()
    for t in texts:
        automaton.add(t)
    automaton.settle()
    for size in (1, 2, 5, 9):
        count = collections.Counter(tuple(t[i : i + size]) for t in texts for i in range(len(t) - size + 1))
        for t in texts:
            want = [i for i in range(len(t) - size + 1) if count[tuple(t[i : i + size])] > 1]
            assert automaton.repeated(t, size) == want


def line_samples():
    """Few kinds of lines, many of them blank or of one word, in an order that makes runs of all lengths repeat."""
    r = random.Random(11)
    kinds = ["", "", " ", "a", "b", "c d", "e f g", "\t"]
    texts = ["\n".join(r.choice(kinds) for _ in range(r.randint(0, 14))) for _ in range(60)]
    texts += ["Home\n\nAbout\n\nBlog\n\nContact", "x\nHome\n\nAbout\n\nBlog\n\nContact\ny", "A long sentence\n\nEnd", "q\nA long sentence\n\nEnd\nz"]
    texts += ["\n" * 40 + "one\n" + "\n" * 25 + "two three", "u\n" + "\n" * 40 + "one\n" + "\n" * 25 + "two three\nv", "a\nb\nc", "k\na\nb\nc", None, ""]
    return [(i, t) for i, t in enumerate(texts)]


def test_line_dedup(spark, docs):
    # one order for all: by id, null last; rows that repeat id and text are one document
    unique = sorted(set(pairs()), key=lambda d: (d[0] is None, d[0] or 0, d[1] is not None))
    want = brute.lines([((k, t), t) for k, t in unique], 3)
    clashing = docs.withColumns({c: F.lit(c) for c in ("_c1", "_c2", "spans", "_spans", "_lines", "_row", "_k2", "rank", "place", "pos", "a", "b")})
    rows = line_dedup(clashing.withColumn("before", F.col("text")).withColumn("n_runs", F.lit("old"))).collect()
    assert len(rows) == len(pairs()) and rows[0]["_k1"] == "clash" and {rows[0][c] for c in ("_c1", "_lines", "_row")} == {"_c1", "_lines", "_row"}
    for r in rows:
        assert (r.text, r.n_lines, r.n_removed, r.n_runs) == want[r.doc_id, r.before]
    assert line_dedup(docs.limit(0)).count() == 0


def test_lines_of_maximal_runs_go(spark):
    some = line_samples()
    df = spark.createDataFrame(some, "doc_id long, text string")
    for words in (0, 1, 3, 4, 9):
        want = {k: v for k, v in brute.lines(some, words).items()}
        got = {r.doc_id: (r.text, r.n_lines, r.n_removed, r.n_runs) for r in line_dedup(df, min_words=words).collect()}
        assert got == want, words


def test_targets_match_repeated_sharing(spark):
    r = random.Random(3)
    for trial in range(3):
        sizes = {f"s{i}": r.choice([0, 5, 100, 10_000]) for i in range(7)} | ({None: 50} if trial else {})
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        want = brute.targets(sizes)
        for row in source_targets(df).collect():
            assert row.target == pytest.approx(want[row.source], rel=1e-9, abs=1e-6)


def test_mixing(docs):
    rows = mix_sources(docs, bucket_rows=3).collect()
    assert len(rows) == len(pairs())
    sizes, taken, target = collections.Counter(), collections.Counter(), {}
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.copies <= 2 and r.taken == r.copies * r["size"] and r.source_size >= r["size"]
    want = brute.targets(sizes)
    longest = max(r["size"] for r in rows)
    for s in sizes:
        assert target[s] == pytest.approx(want[s]) and abs(taken[s] - target[s]) <= longest
    again = mix_sources(docs.repartition(5), bucket_rows=3)
    assert got(again.drop("rate")) == sorted(repr(tuple(v for k, v in r.asDict().items() if k != "rate")) for r in rows)
    assert mix_sources(docs.limit(0)).count() == 0
    mixed = mixed_documents(docs)
    assert mixed.columns == [*docs.columns, "copy_no"]
    assert mixed.count() == sum(r.copies for r in mix_sources(docs).collect())


ITEMS = [(1, "w1 w2 w3"), (2, None), (None, "one TWO"), (3, ""), (4, "s p q r t u v w x y z a"), (4, "b! c? d")]


def test_decontamination(spark, docs):
    items = [*ITEMS, (7, " ".join(pairs()[6][1].split()[3:15])), (8, pairs()[7][1][:90])]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = sorted(map(repr, brute.windows(pairs(), items, 10)))
    assert got(find_windows(docs, benchmark)) == want
    assert got(find_windows(docs, benchmark, block_windows=1)) == want
    assert all(r.n_hit == 0 for r in find_windows(docs, benchmark.limit(0)).collect())
    cleaned = remove_windows(docs, benchmark)
    assert cleaned.count() == len(pairs()) and all(r.n_hit == 0 for r in find_windows(cleaned, benchmark).collect())
    hit = {r.doc_id for r in find_windows(docs, benchmark).collect() if r.n_hit}
    clean = {r.doc_id: r.text for r in cleaned.collect() if r.doc_id not in hit}
    assert all(clean[k] == t for k, t in pairs() if k in clean and k is not None)


def test_cuts_do_not_depend_on_blocks(spark, docs):
    long = [f"l{i}" for i in range(15)]
    items = [(1, " ".join(long[6:9])), (2, " ".join(long)), (3, "m1 m2 m3 m4 m5 m6 m7 m8 m9 m10"), (4, "m5 m6 m7 m8 m9 m10 m11 m12 m13 m14"), (5, "in side")]
    texts = ["before " + " ".join(long) + " after", "x " + " ".join(f"m{i}" for i in range(1, 15)) + " y", "in in side side, in side.", "clean", None, ""]
    texts += [texts[0], "m1 m2 m3 m4 m5 in side m6 m7 m8 m9 m10"]  # the second is joined up by a cut
    rows = [(i % 6, t, "k", None, "clash", "clash") for i, t in enumerate(texts)]
    both = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    benchmark = spark.createDataFrame([*items, *[(9 + i, " ".join(pairs()[j][1].split()[3:15])) for i, j in enumerate((1, 2, 6))]], "item_id long, text string")
    cut = remove_windows(both, benchmark, block_windows=1)
    assert cut.columns == both.columns and got(cut) == got(remove_windows(both, benchmark))
    left = {r.text for r in cut.filter("lang = 'k'").collect()}
    assert left == {"before \n after", "x \n y", "\n, \n.", "clean", None, "", "\n"}
    assert got(remove_windows(both.filter("text = 'clean'"), benchmark, block_windows=1)) == got(both.filter("text = 'clean'"))


def test_ngram_join(docs):
    want = sorted(map(repr, brute.jaccard_components(pairs(), 5, 75)))
    assert got(ngram_join.ngram_join(docs)) == want
    kept = ngram_join.drop_near_copies(docs)
    parts = len({w for w in want})
    names = [(k, c) for k, _, c in brute.jaccard_components(pairs(), 5, 75)]
    unique = {(k, t) for (k, t), (_, c) in zip(pairs(), names, strict=True) if k is not None and k == c}
    assert {(r.doc_id, r.text) for r in kept.collect() if r.doc_id is not None} == unique and parts
    assert kept.columns == docs.columns and kept.filter("doc_id = 3").count() == 1
    assert ngram_join.ngram_join(docs.limit(0)).count() == 0


def test_parity_sketches_lose_no_link():
    luck = np.random.default_rng(7)
    for _ in range(300):
        n, gone, new = int(luck.integers(1, 400)), int(luck.integers(0, 60)), int(luck.integers(0, 60))
        x = np.unique(luck.integers(0, 2**63, n, dtype=np.uint64))
        y = np.unique(np.append(x[min(gone, len(x) - 1) :], luck.integers(0, 2**63, new, dtype=np.uint64)))
        a, b = ngram_join.parity_sketch(x), ngram_join.parity_sketch(y)
        assert np.bitwise_count(a ^ b).sum() <= len(np.setxor1d(x, y))
        both = len(np.intersect1d(x, y))
        if 100 * both >= 75 * (len(x) + len(y) - both):
            assert ngram_join._near_enough(len(x), len(y), a, b, 75)


def test_ngram_join_in_small_tiles(docs, monkeypatch):
    monkeypatch.setattr(ngram_join, "TILE", 3)
    monkeypatch.setattr(ngram_join, "ROUNDS", 0)
    assert got(ngram_join.ngram_join(docs)) == sorted(map(repr, brute.jaccard_components(pairs(), 5, 75)))


def test_divide_skip():
    r = random.Random(2)
    for _ in range(200):
        lists = [sorted(r.sample(range(30), r.randint(0, 20))) for _ in range(r.randint(1, 25))]
        least = r.randint(1, len(lists))
        count = collections.Counter(x for each in lists for x in each)
        assert ngram_join.divide_skip(lists, least) == {k: v for k, v in count.items() if v >= least}


def test_word_spans_do_not_depend_on_pieces(monkeypatch):
    import numpy as np

    data = np.frombuffer(" ".join(f"word{i}" for i in range(500)).encode() + b" " + b"y" * 300, np.uint8)
    whole = tk.words_of(data, np.array([0, 700, len(data)]))
    monkeypatch.setattr(tk, "SPAN_BYTES", 64)
    assert (tk.words_of(data, np.array([0, 700, len(data)])).hashes == whole.hashes).all()


def test_language_id(spark, docs):
    real = spark.read.parquet(f"{SMALL}/documents.parquet")
    trees = learn(training_sample(real, "doc_id", "text", "lang", 400))
    found = identify_language(real, trees).withColumn("held", held_out(F.col("doc_id"))).filter("held")
    assert found.filter("lang_pred = lang").count() >= 0.95 * found.count() > 0
    edge = {(r.doc_id, r.text): r for r in identify_language(docs, trees).collect()}
    assert {edge[k, t].lang_pred for k, t in ((53, None), (54, ""), (55, " \n\t "))} == {"und"}
    assert edge[63, "ß" * 9000].lang_pred in trees.languages and all(0 <= r.lang_score <= 1 for r in edge.values())
    assert identify_language(spark.createDataFrame([(1, "12 34!")], "doc_id long, text string"), trees).first().lang_pred == "und"
    nothing = learn(training_sample(docs.limit(0), "doc_id", "text", "lang", 9))
    assert {r.lang_pred for r in identify_language(docs, nothing).collect()} == {"und"}
    assert identify_language(docs.limit(0), trees).count() == 0


def test_code_lengths_match_brute_force(spark, monkeypatch):
    real = [(r.lang, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").limit(24).collect()]
    short = [("en", "abcdefg"[:n]) for n in range(7)] + [("xx", "abc"), ("xx", None), (None, "abc"), ("yy", "")]
    for order, least in ((4, 3), (2, 1), (0, 8)):
        sample = [(x, t[:3000] if t else t) for x, t in real] + short
        trees = learn(spark.createDataFrame(sample, "_lang string, _text string"), order=order, least=least)
        lengths = brute.ppm([(x, t) for x, t in sample if x and t], order, least, language_id.UNIT)
        texts = ["", "a", "ab", "abc", "né\nx", "日本 text", real[0][1][:2000], "", real[5][1][-2500:], "z" * 3000]
        want = [[v for _, v in sorted(lengths(t).items())] for t in texts]
        for span in (1 << 20, 7, 1):
            monkeypatch.setattr(language_id, "SPAN_BYTES", span)
            some = texts if span > 1 else texts[:6]
            assert trees.languages == ["de", "en", "es", "fr", "xx"] and trees.lengths(*tk.buffers(pa.array(some))).tolist() == want[: len(some)]


def test_language_samples_of_very_short_texts(spark):
    for text in ("abcdefg"[:n] for n in range(7)):
        trees = learn(spark.createDataFrame([("en", text), ("en", "hello there")], "_lang string, _text string"), least=1)
        assert trees.languages == ["en"]


def test_the_memory_of_tables_changes_no_code_length(spark):
    real = spark.read.parquet(f"{SMALL}/documents.parquet")
    sample = real.filter("lang is not null and text is not null").select(F.col("lang").alias("_lang"), F.substring("text", 1, 3000).alias("_text"))
    texts = tk.buffers(pa.array([r.text for r in real.filter("text is not null").limit(60).collect()] + ["", "é", "zz"]))
    for order, least in ((4, 8), (5, 2)):
        whole = learn(sample, order=order, least=least, table_bytes=1 << 40)
        want = whole.lengths(*texts)
        assert whole.tables().depth == order
        depths = set()
        for table_bytes in (0, 100_000, 3_000_000, 20_000_000):
            trees = learn(sample, order=order, least=least, table_bytes=table_bytes)
            assert np.array_equal(trees.lengths(*texts), want) and np.array_equal(trees.names, whole.names)
            depths.add(trees.tables().depth)
        assert len(depths) > 2 and min(depths) == 0


def test_a_language_whose_documents_share_an_id_is_learned(spark):
    for one in range(12):
        rows = [(one, f"the cat number {i} sat there", "en") for i in range(300)] + [(i, f"der hund {i}", "de") for i in range(100, 130)]
        df = spark.createDataFrame([*rows, *[(one, "same", "fr")] * 300], "doc_id long, text string, lang string")
        got = collections.Counter(r._lang for r in training_sample(df, "doc_id", "text", "lang", 9).collect())
        if zlib.crc32(str(one).encode()) % 3 != 1:
            assert got == {"en": 9, "de": 9, "fr": 1}
        else:
            assert got == {"de": 9}


def test_quality_of_very_long_words(spark):
    rows = [(i, "x" * 70_000 if i % 10 == 0 else f"word {i} and more words {i % 7}", "s", "en") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(40)], "doc_id long, quality int")
    scored = q.score_quality(df, q.train_quality(df, labels)).collect()
    assert len(scored) == 60 and all(0 <= x <= 1 for r in scored for x in (r.score, r.content_score, r.metadata_score))
    assert any(r.keep for r in scored)
    with pytest.raises(ValueError, match="not finite"):
        q.Logistic().fit(np.array([[1.0], [np.inf]]), np.array([0.0, 1.0]))


def cotraining_task(n=900, labelled=200, seed=4):
    """Documents whose words and sources tell their class, each by itself and not always."""
    r = random.Random(seed)
    rows, truth = [], {}
    for i in range(n):
        good = r.random() < 0.6
        own, other = ("g", "b") if good else ("b", "g")
        words = [f"{own if r.random() < 0.72 else other}{r.randrange(60)}" for _ in range(r.randint(12, 40))]
        source = f"{own if r.random() < 0.93 else other}s{r.randrange(3)}"
        truth[i] = int(good)
        rows.append((i, " ".join(words), source, "en"))
    return rows, truth, {i: truth[i] for i in range(labelled)}


def ranked(scores, truth):
    """The share of pairs of a good and a bad document that the scores order rightly."""
    order = sorted(scores, key=scores.get)
    good = [n for n, i in enumerate(order) if truth[i]]
    return (sum(good) - len(good) * (len(good) - 1) / 2) / (len(good) * (len(order) - len(good)))


def test_cotraining_teaches_both_views(spark):
    gains, kept = [], []
    for seed in (0, 1, 2):
        rows, truth, labels = cotraining_task(labelled=120, seed=seed)
        df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
        said = spark.createDataFrame(list(labels.items()), "doc_id long, quality int")
        right = {}
        for rounds in (0, 5):
            model = q.train_quality(df, said, exchange=60, rounds=rounds)
            right[rounds] = ranked({r.doc_id: r.content_score for r in q.score_quality(df, model).collect() if r.doc_id not in labels}, truth)
            kept += [model.kept] if rounds else []
            assert rounds or model.kept == (0, 0)
        gains.append(right[5] - right[0])
    # few labels show few words; what sources tell about other documents shows more of them
    assert sum(gains) > 0 and all(any(k[v] for k in kept) for v in (0, 1))


def test_the_whole_of_cotraining_against_brute_force(spark):
    rows, _, labels = cotraining_task(n=300, labelled=90, seed=8)
    rows += [(1000 + i, *rows[i + 50][1:]) for i in range(20)]  # copies
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").repartition(5)
    said = spark.createDataFrame([*labels.items(), (5, 1 - labels[5])], "doc_id long, quality int")
    features = q.quality_features(df)
    model = q.train_on_features(features, said, exchange=30, rounds=3)
    table = features.withColumn("luck", F.xxhash64("_id", F.lit("quality"))).toArrow()
    known = {k: v for k, v in labels.items() if k != 5}
    want = brute.cotrain(
        dict(zip(*(table.column(c).to_pylist() for c in ("_id", "luck")), strict=True)), dict(zip(*(table.column(c).to_pylist() for c in ("_id", "_key")), strict=True)),
        {v: dict(zip(table.column("_id").to_pylist(), q.unpacked(table.column(v)), strict=True)) for v in ("content", "metadata")}, known, q, 30, 3,
    )
    got = {r.doc_id: r.score for r in q.score_features(features, model).collect()}
    assert model.kept == want["kept"] and min(model.kept) > 0
    assert got.keys() == want["scores"].keys() and all(abs(got[k] - want["scores"][k]) < 1e-6 for k in got)


def test_quality(spark, docs):
    real, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = q.train_quality(real, labels.filter(~held_out(F.col("doc_id"))))
    held = q.score_quality(real, model).join(labels.filter(held_out(F.col("doc_id"))), "doc_id")
    n = held.count()
    assert held.filter("keep = (quality = 1)").count() >= 0.9 * n > 0
    assert held.filter("quality = 1 and not keep").count() <= 0.03 * n
    edge = q.score_quality(docs, model).collect()
    assert q.score_quality(docs.limit(0), model).count() == 0
    assert len({q.place(x, 64) for x in ("s12", "s21", "ab", "ba")}) == 4
    assert len(edge) == len(pairs()) and all(0 <= r.score <= 1 for r in edge)
    assert q.train_quality(docs, labels.limit(0)) is None
    assert all(r.keep or r.score == 0 for r in q.score_quality(docs, None).collect())


def test_surest_documents_against_a_full_sort(spark):
    real = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "source", "lang")
    features = q.quality_features(real.unionByName(real).repartition(7))
    table = features.toArrow()
    views = [q.unpacked(table.column(c)) for c in ("content", "metadata")]
    keys = table.column("_key").to_numpy()
    random_labels = np.random.default_rng(3).integers(0, 2, len(keys)).astype(float)
    models = [q.Logistic(5.0).fit(x, random_labels) for x in views]
    taken = np.unique(keys)[::9]
    got = q.surest(features, models, 12, 7, taken, sure=0.55).to_pylist()
    for v in (0, 1):
        odds = models[v].log_odds(views[v])
        for side, n in ((1, 12), (0, 7)):
            best = {}
            for key, o in zip(keys.tolist(), odds.tolist(), strict=True):
                if key not in set(taken.tolist()):
                    best[key] = min(best.get(key, 99.0), -o if side else o)
            least = np.log(0.55 / 0.45)
            want = sorted((rank, key) for key, rank in best.items() if rank <= -least)[:n]
            have = [(r["rank"], r["_key"]) for r in got if r["view"] == v and r["side"] == side]
            assert [k for _, k in have] == [k for _, k in want]
            assert np.allclose([r for r, _ in have], [r for r, _ in want])


def test_hashed_words_against_counting():
    texts = ["a b a", "", "one", None, "b a  b\tc \n a", "é é"]
    got = q.content_features(pa.array(texts))
    assert got.shape == (6, q._STATISTICS + 2 * q.WORD_PLACES) and not got[1].any() and not got[3].any()
    for i, text in enumerate(texts):
        words = (text or "").split()
        for size, lo in ((1, q._STATISTICS), (2, q._STATISTICS + q.WORD_PLACES)):
            grams = collections.Counter(tuple(words[j : j + size]) for j in range(len(words) - size + 1))
            part = got[i, lo : lo + q.WORD_PLACES]
            assert np.isclose((part**2).sum(), 1.0 if grams else 0.0)
            if size == 1 and len(grams) == np.count_nonzero(part):
                shares = sorted(n / len(words) for n in grams.values())
                assert np.allclose(sorted(part[part > 0] ** 2), shares)
    assert np.array_equal(q.hashed_shares(tk.words_of_column(pa.array(["b a"])), 1), q.hashed_shares(tk.words_of_column(pa.array(["a b"])), 1))


def test_url_filters(spark):
    day = "date'2024-01-{:02d}'".format
    events = [
        ("a", "host", "x.com", "block", "add", 2), ("a", "host", "x.com", "block", "remove", 5), ("a", "host", "x.com", "block", "add", 9),
        ("b", "domain", "y.org", "block", "add", 1), ("b", "prefix", "w.y.org/ok", "allow", "add", 3), (None, "host", "x.com", "block", "add", 4),
        ("c", "host", "z.de", None, "add", 1), ("a", "host", "same.com", "block", "add", 3), ("a", "host", "same.com", "block", "remove", 3),
    ]
    listed = spark.createDataFrame(events, "list string, kind string, value string, verdict string, action string, d int")
    listed = listed.withColumn("since", F.expr("date_add(date'2023-12-31', d)")).drop("d")
    asked = [
        ("http://x.com/a", 1, "none", 0), ("http://X.com:80/a", 2, "block", 1), ("http://u@x.com", 4, "block", 2), ("http://x.com", 5, "block", 1),
        ("http://x.com", 9, "block", 2), ("http://w.y.org/ok/1?q", 2, "block", 1), ("http://w.y.org/ok/1?q", 3, "allow", 2),
        ("http://w.y.org/okay", 3, "block", 1), ("http://z.de/", 5, "none", 0), ("nothing", 5, "none", 0), (None, 5, "none", 0),
        ("http://x.com/a", None, "none", 0), ("http://same.com", 3, "none", 0), ("http://x.com", 5, "block", 1),
    ]
    captures = spark.createDataFrame([(i, u, d) for i, (u, d, _, _) in enumerate(asked)], "id int, url string, d int")
    captures = captures.withColumn("fetched", F.expr("date_add(date'2023-12-31', d)")).withColumns({c: F.lit("clash") for c in ("rule", "_url", "_n", "row", "at", "best")})
    rows = filter_urls(captures, listed).orderBy("id").collect()
    assert {rows[0][c] for c in ("_url", "_n", "row", "at", "best")} == {"clash"}
    assert [(r.verdict, r.n_active) for r in rows] == [(v, n) for _, _, v, n in asked]
    assert rows[6].rule == "prefix:w.y.org/ok" and day
    assert filter_urls(captures, listed.limit(0)).filter("verdict <> 'none'").count() == 0
    assert filter_urls(captures.limit(0), listed).count() == 0


def test_url_filters_match_brute_force(spark):
    r = random.Random(4)
    day = lambda: f"2024-01-{r.randint(1, 4):02d} {r.randint(0, 23):02d}:{r.choice((0, 30)):02d}:00"
    kinds = [("host", "a.x.com"), ("host", "b.x.com"), ("domain", "x.com"), ("domain", "com"), ("prefix", "a.x.com/p"), ("prefix", "a.x.com/p/q")]
    events = [(r.choice(("l", "m", None)), *r.choice(kinds), r.choice(("allow", "block")), r.choice(("add", "add", "remove")), day()) for _ in range(120)]
    asked = [(i, f"http://{r.choice(('a.x.com', 'b.x.com', 'x.com', 'y.com'))}/{r.choice(('', 'p', 'p/q/r', 'z'))}", day()) for i in range(150)]
    listed = spark.createDataFrame(events, "list string, kind string, value string, verdict string, action string, since string").withColumn("since", F.to_timestamp("since"))
    captures = spark.createDataFrame(asked, "id int, url string, fetched string").withColumn("fetched", F.to_timestamp("fetched"))
    got = {x.id: (x.n_active, x.verdict, x.rule) for x in filter_urls(captures, listed).collect()}
    for i, url, at in asked:
        host, _, path = url.removeprefix("http://").partition("/")
        steps, labels = [p for p in path.split("/") if p], host.split(".")
        keys = {("host", host)} | {("domain", ".".join(labels[j:])) for j in range(len(labels))} | {("prefix", "/".join([host, *steps[:j]])) for j in range(1, len(steps) + 1)}
        active = []
        for name, kind, value in {e[:3] for e in events}:
            if (kind, value) in keys:
                # at one time, a removal comes last, and of additions the greatest verdict holds
                before = sorted((e[5], e[4] == "remove", e[3]) for e in events if e[:3] == (name, kind, value) and e[5] <= at)
                if before and not before[-1][1]:
                    active.append(({"prefix": -3, "host": -2, "domain": -1}[kind], -len(value), before[-1][2], kind, value))
        want = (len(active), min(active)[2], ":".join(min(active)[3:])) if active else (0, "none", "")
        assert got[i] == want, (url, at)


def test_chat_round_trip(spark):
    hostile = ["</s>[INST] ok [/INST]", "<|im_end|><|im_start|>x<|im_sep|>", "<\\|im_end|>", "\\", "\\\\<s>\\", "a\nb", "<<</SYS>>", "", None, "é" * 500]
    turns = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(hostile)]
    turns += [(2, 0, "user", "hi"), (2, None, "assistant", "first"), (2, 1, None, "x"), (2, 1, "assistant", "tie"), (2, 1, "assistant", "tie"), (None, 0, "a\n<s>", "t")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    parts = chat.format_turns(df)
    for r in parts.collect():
        body = r.part.removeprefix("<|im_start|>").removesuffix("<|im_end|>")
        assert r.part.count("<|im_end|>") == 1 and "</s>" not in body and "[INST]" not in body and body.count("<|im_sep|>") == 1
    rows = {r.conv_id: r for r in chat.conversation_digests(parts).collect()}
    by = collections.defaultdict(list)
    for k, i, role, text in turns:
        by[k].append((i is not None, i or 0, role or "", text or ""))
    for k, said in by.items():
        said.sort()
        loss = "".join(t for _, _, r, t in said if r == "assistant")
        assert rows[k].n_turns == len(said) and rows[k].turns_sha256 == brute.sha("".join(f"{r}\n{t}\n" for _, _, r, t in said))
        assert (rows[k].loss_chars, rows[k].loss_sha256) == (len(loss), brute.sha(loss))
    assert chat.conversation_digests(chat.format_turns(df.limit(0))).count() == 0


def test_layouts_become_turns(spark):
    tables = [
        ([("c", [("human", "q"), None, ("gpt", None)])], "id string, messages array<struct<role:string,content:string>>", [("user", "q"), ("assistant", None)]),
        ([("c", [("system", "s")]), ("d", []), ("e", None)], "id string, conversations array<struct<`from`:string,value:string>>", [("system", "s")]),
        ([("c", "do", None, "done", "x")], "id string, instruction string, input string, output string, note string", [("user", "do"), ("assistant", "done")]),
        ([("c", "s", "p", "r")], "id string, system string, prompt string, response string", [("system", "s"), ("user", "p"), ("assistant", "r")]),
        ([("c", 0, "gpt", "t", "p", "y")], "conv_id string, turn long, role string, text string, prompt string, system string", [("assistant", "t")]),
    ]
    for rows, ddl, want in tables:
        df = spark.createDataFrame(rows, ddl)
        turns = chat.turns_of_table(df, "id" if "id" in df.columns else None)
        assert [(r.role, r.text) for r in turns.orderBy("turn").collect()] == want and turns.columns == ["conv_id", "turn", "role", "text"]
        assert {r.conv_id for r in turns.collect()} == {"c"} and chat.turns_of_table(df.limit(0), "id").count() == 0
        said = chat.turns_of_table(df, "id" if "id" in df.columns else None, rename=False)
        written = {"user": {"user", "human"}, "assistant": {"assistant", "gpt"}, "system": {"system"}}
        assert all(r.role in written[w] for r, (w, _) in zip(said.orderBy("turn").collect(), want, strict=True))
    kept = chat.turns_of_table(spark.createDataFrame([(1, 0, "model", "t")], "conv_id int, turn int, role string, text string"), rename=False)
    (row,) = chat.conversation_digests(chat.format_turns(kept)).collect()
    assert row.turns_sha256 == brute.sha("model\nt\n") and row.loss_chars == 0
    with pytest.raises(ValueError, match="no layout"):
        chat.turns_of_table(spark.createDataFrame([(1, "x")], "id int, body string"), "id")
    records = [
        {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": None}], "meta": {"id": 1}},
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        {"instruction": "do", "input": None, "output": 3}, {"prompt": "p", "response": "r", "system": "s"}, {"question": "x", "answer": "y"},
        {"conv_id": 4, "turn": 0, "role": "user", "text": "t"}, {"messages": []}, {"unknown": 1}, [1],
        {"messages": [{"role": "user", "content": "q"}, 7]},
    ]
    rows = [(i, json.dumps(r)) for i, r in enumerate(records)] + [(10, None), (11, "{")]
    df = chat.turns_of_json(spark.createDataFrame(rows, "id long, json string"), "id", "json")
    said = collections.defaultdict(list)
    for r in df.orderBy("conv_id", "turn").collect():
        said[r.conv_id].append((r.layout, r.role, r.text))
    assert said[0] == [("messages", "user", "q"), ("messages", "assistant", "")]
    assert said[1] == [("conversations", "user", "q"), ("conversations", "assistant", "a")]
    assert said[2] == [("instruction", "user", "do"), ("instruction", "assistant", "3")]
    assert said[3] == [("prompt", "system", "s"), ("prompt", "user", "p"), ("prompt", "assistant", "r")]
    assert said[4][1] == ("question", "assistant", "y") and said[5] == [("rows", "user", "t")]
    assert said[9] == [("messages", "user", "q"), ("messages", None, "7")]
    assert [said[i] for i in (6, 7, 8, 10, 11)] == [[("empty", None, None)]] + [[(None, None, None)]] * 4
