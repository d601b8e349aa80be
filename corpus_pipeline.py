"""The corpus pipeline: documents in, ids of clean documents out, one written stage after another."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm import decontaminate, language, ngram_join, pieces, secret_scan
from roadpulse.session import scratch_path


# Columns that stages look at; all others are kept under names of their own meanwhile, whatever they are called.
CORE = ("doc_id", "text", "lang", "source", "n_chars")


def _aside(docs: DataFrame) -> tuple[DataFrame, Callable[..., DataFrame]]:
    """(``docs`` with its other columns out of the way, function that puts them back and sets the named ones anew)."""
    names = docs.columns
    held = [c if c in CORE else f"__kept_{i}" for i, c in enumerate(names)]

    def back(found: DataFrame, **new: Column) -> DataFrame:
        return found.select(*[new.get(h, F.col(h)).alias(c) for h, c in zip(held, names)])

    return docs.toDF(*held), back


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language, with ``lang`` as found; those without any letter go."""
    own, back = _aside(docs)
    found = language.identify(own, language.train(own)).filter(F.col("lang_pred") != language.UNKNOWN)
    return back(found, lang=F.col("lang_pred"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies."""
    own, back = _aside(docs)
    return back(ngram_join.one_per_class(own))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    own, back = _aside(docs)
    return back(decontaminate.without_items(own, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every secret masked and ``n_chars`` brought up to date."""
    own, back = _aside(docs)
    found = secret_scan.find_secrets(own)
    text = secret_scan.masked(F.col("text"), F.col("secret_spans"))
    changed = F.size("secret_spans") > 0
    return back(found, text=text, n_chars=F.when(changed, F.length(text).cast("bigint")).otherwise(F.col("n_chars")))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids; the text that the ids stand for takes the place of ``text``.

    ``n_tokens``, ``token_ids`` and ``ids_sha256`` take the place of columns so named in whatever case.
    """
    added = ("n_tokens", "token_ids", "ids_sha256")
    names = [c for c in docs.columns if c.lower() not in added]
    own, _ = _aside(docs)
    held = [h for c, h in zip(docs.columns, own.columns) if c in names]
    found = pieces.encode_pieces(own.select(*held))
    return found.select(*[F.col("decoded" if h == "text" else h).alias(c) for h, c in zip(held, names)], *added)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secrets),
    ("sentencepiece", sentencepiece),
]

# Learning a language model and segmenting by the vocabulary have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written and read again as the next one's."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        out = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
