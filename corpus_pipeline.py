"""The corpus pipeline: documents of known languages, without repeated lines, near copies and benchmark text, mixed to target.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it and reads it again for the next one. All but
the last return the columns of their input, whatever their names, with n_chars, if there is one, counted anew. An empty table
goes through every stage as an empty table. What a stage does with nulls, ties and repeated rows is said at the stage; more is
at the operator that it calls.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import table
from millrace.llm.decontaminate import remove_windows
from millrace.llm.language_id import identify_language, learn, training_sample
from millrace.llm.line_dedup import line_dedup
from millrace.llm.mixing import mixed_documents
from millrace.llm.ngram_join import drop_near_copies
from millrace.plans.staging import Scratch

#: A word as decontamination sees it.
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
#: Documents whose best language has less than this share of the weight are rejected.
LEAST_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised. Those without letters, and those that two languages code alike, go.

    Null and empty texts have no letters. Null languages and ids teach nothing but are judged; repeated rows are judged alike.
    """
    trees = learn(training_sample(docs, "doc_id", "text", "lang", rows=400))
    found = identify_language(docs.select(_beside_text(docs), "text"), trees)
    return _restored(found.filter((F.col("lang_pred") != "und") & (F.col("lang_score") >= LEAST_SCORE)), docs.columns)


def _beside_text(docs: DataFrame) -> Column:
    """All columns but the text as one, so that no name of theirs can clash."""
    return F.struct(*[c for c in docs.columns if c != "text"]).alias("row")


def _restored(docs: DataFrame, columns: list[str]) -> DataFrame:
    return docs.select(*[F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in columns])


def _recounted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    n_chars = F.length("text").cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return docs.select(*[n_chars if c == "n_chars" else F.col(c) for c in docs.columns])


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of line runs; one that loses all its words goes.

    Null texts and texts that never had words stay. Of ties, documents of one id, the first by text hash keeps its lines; rows
    that repeat id and text keep and lose the same lines.
    """
    kept = line_dedup(docs.select(_beside_text(docs), "doc_id", "text"))
    left = F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return _recounted(_restored(kept.filter((F.col("n_removed") == 0) | left), docs.columns))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that 5-word shingles link at a Jaccard similarity of 0.75: the one with the smallest id.

    Null ids come last; ties in id go by text hash, and one of rows that repeat id and text stays. Documents without words, null
    texts among them, link with nothing: those of one id and text are one document.
    """
    return drop_near_copies(docs, size=5, percent=75)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 10-word windows of the benchmark; one that loses all its words goes.

    Null texts and texts that never had words stay. Repeated rows are cut alike; ids, null or tied, make no difference.
    """
    words = F.coalesce(F.col("text").rlike(_WORD), F.lit(False))
    cut = remove_windows(docs.select(_beside_text(docs), "text", words.alias("had_words")), table(spark, sf_dir, "benchmark"))
    return _recounted(_restored(cut.filter(~F.col("had_words") | words), docs.columns))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in as many copies as the source weights give them, numbered by copy_no.

    A null source is one of its own; null texts have no words. Ties inside a source and size go by a hash of the id; rows that
    repeat id and text get the copies of all of them together.
    """
    return mixed_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", dedup_lines),
    ("ngram_join", near_copies),
    ("decontaminate", decontaminate),
    ("mix_sources", mix),
]

#: Language models, similarity search and iterated balancing have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    last = None
    for name, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
        if last is not None:
            scratch.release(last)
        last = docs
    return docs
