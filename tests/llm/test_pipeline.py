import collections

import brute
import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F
from test_operators import SCHEMA, sample

import corpus_pipeline as pipeline
from millrace.llm import queries


def test_stages_hold_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    benchmark = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    for name, stage in pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        out = stage(spark, docs, SMALL).cache()
        after = {r.doc_id: r.text for r in out.collect()}
        assert set(after) <= set(before)
        if name == "language_id":
            assert all(after[k] == before[k] for k in after) and len(after) >= 0.95 * len(before)
        elif name == "line_dedup":
            want = {k: v[0] for k, v in brute.lines(sorted(before.items()), 3).items() if not v[2] or v[0].split()}
            assert after == want
        elif name == "ngram_join":
            assert after == {k: before[k] for k, _, c in brute.jaccard_components(list(before.items()), 5, 75) if k == c}
        elif name == "decontaminate":
            hit = {k for k, _, n, _ in brute.windows(before.items(), benchmark, 10) if n}
            assert {k: t for k, t in after.items() if k not in hit} == {k: t for k, t in before.items() if k not in hit}
            assert not any(n for _, _, n, _ in brute.windows(after.items(), benchmark, 10))
        if name != "mix_sources":
            assert out.columns == columns and out.filter("n_chars <> length(text)").count() == 0
        else:
            assert out.columns == [*columns, "copy_no"] and out.count() > len(after)
        docs = out


NAMES = ("row", "_row", "had_words", "lang_pred", "lang_score", "n_removed", "n_lines", "_k2", "spans", "_copies", "size", "taken", "least", "id")


@pytest.mark.parametrize("name", [n for n, _ in pipeline.STAGES])
def test_stages_with_nulls_ties_repeats_and_clashing_names(spark, name):
    stage = dict(pipeline.STAGES)[name]
    some = [*sample(), (3, "another text of the same id", None, None, "clash", "clash")]
    docs = spark.createDataFrame(some, SCHEMA).withColumn("n_chars", F.length("text")).withColumns({c: F.lit(c) for c in NAMES})
    if name == "language_id":  # it learns from what it is given
        real = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang", "source").filter("doc_id < 100")
        docs = docs.unionByName(real, allowMissingColumns=True).fillna({c: c for c in NAMES})
    out = stage(spark, docs, SMALL)
    columns = [*docs.columns, "copy_no"] if name == "mix_sources" else docs.columns
    assert out.columns == columns
    got = out.collect()
    assert all(r[c] == c for r in got for c in NAMES) and all(r.n_chars == len(r.text) for r in got if name == "decontaminate" and r.text is not None)
    before = collections.Counter((r.doc_id, r.text) for r in docs.collect())
    after = collections.Counter((r.doc_id, r.text) for r in got)
    if name == "language_id":
        assert all(after[k] in (0, n) for k, n in before.items()) and not any(t in (None, "", " \n\t ") for _, t in after)
    elif name == "ngram_join":
        assert set(after.values()) == {1} and after[53, None] == after[54, ""] == 1 and after[3, sample()[3][1]] == 1
    elif name == "mix_sources":
        assert sum(after.values()) == len({(r.doc_id, r.text, r.copy_no) for r in got})
    else:
        assert after[53, None] == 1 and after[54, ""] == 1 and len(got) <= len(some)
    assert stage(spark, docs.limit(0), SMALL).collect() == []


def test_same_rows_as_sql(spark, duck):
    for name, sql in queries.oracle_sql().items():
        assert rows(queries.queries()[name](spark, SMALL).toPandas()) == rows(duck.sql(sql).df()), name
