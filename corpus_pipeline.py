"""A training corpus from ``documents`` in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last
return the columns of ``documents``.  ``run`` writes every stage's result below
``spark.checkpoint.dir`` and hands the written table to the next.

1. ``quality``: documents that the factorisation machine rejects go (score below 0.5);
2. ``near_copies``: of each component of the Jaccard join one document stays;
3. ``passages``: repeated passages of 35 words or more are cut out of the texts, the rest is left as it is;
4. ``mixture``: sources are sampled to their target weights, a document as often as it was drawn;
5. ``tokens``: texts are encoded by byte-level BPE; the decoded text is returned beside the ids.

The columns of ``documents`` that a stage does not work on travel in one struct, so any names may occur.
Rows are never merged unless a stage says so: NULL or repeated ids are rows of their own.

There is no SQL for the whole, as SQL cannot express the classifier or the merges; the
stages are tested against brute-force versions on their own inputs (tests/llm).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingsmith.llm import bpe, common, jaccard_join, mixing, quality_fm, queries, substring_dedup

#: Documents with a score below this go.
LEAST_QUALITY = 0.5

ORACLE_SQL = None


def _apart(docs: DataFrame, *used: str) -> DataFrame:
    """The columns that a stage works on, and the others in the struct ``row``."""
    return docs.select(common.others(docs, *used).alias("row"), *used)


def _back(done: DataFrame, columns: list[str], *used: str) -> DataFrame:
    return done.select(*(F.col(c) if c in used else F.col("row").getField(c).alias(c) for c in columns))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with a score of LEAST_QUALITY or more.

    NULL and empty texts are scored like any text; repeated rows get equal scores; a doc_id without a label or NULL only
    takes no part in the fit.  No rows, or no labels of a class: see ``quality_fm``.
    """
    labels = common.table(spark, sf_dir, "labels").select("doc_id", "quality")
    used = ("doc_id", "text", "n_chars")
    rows = _apart(docs, *used)
    model = quality_fm.fit(rows.drop("row"), labels)
    scored = quality_fm.score(rows, model, score="score", keep_text=True)
    return _back(scored.filter(F.col("score") >= LEAST_QUALITY), docs.columns, *used)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component: that of the smallest doc_id (NULL last), one of equal rows.

    Texts without words (NULL, empty) link with nothing and all stay.
    """
    used = ("doc_id", "text")
    return _back(jaccard_join.representatives(_apart(docs, *used)), docs.columns, *used)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their repeated spans; ``n_chars`` is counted anew where something was cut.

    A text without repeats stays as it is, NULL too; equal texts of 35 words or more lose all their words.
    """
    used = ("text", "n_chars")
    kept = substring_dedup.remove_repeats(_apart(docs, *used), layout=True)
    counted = F.when(F.col("n_removed") > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return _back(kept.withColumn("n_chars", counted), docs.columns, *used)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as it was drawn, 0 to 3 times.  Texts without words have size 0; NULL is a source."""
    used = ("doc_id", "source", "text")
    drawn = mixing.sample(_apart(docs, *used), mixing.size_of("text"))
    return _back(mixing.emit(drawn), docs.columns, *used)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, lang, source, n_tokens, ids`` and the decoded ``text``; NULL text has no tokens and decodes to ''."""
    path = queries.tokenizer_file("byte_bpe_50k.tiktoken")
    coded = bpe.decode(bpe.encode(docs.select("doc_id", "lang", "source", "text"), path), path)
    return coded.select("doc_id", "lang", "source", "n_tokens", "ids", F.col("decoded").cast("string").alias("text"))


STAGES = [("quality", quality), ("near_copies", near_copies), ("passages", passages), ("mixture", mixture),
          ("tokens", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    stages, before = common.Stages(spark, "pipeline"), None
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stages.put(stage(spark, docs, sf_dir), name)
        if before:                           # nothing reads it any more
            stages.drop(before)
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)
