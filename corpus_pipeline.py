"""A corpus pipeline: quality rules, near-duplicates, decontamination, secrets, mixing.

Each stage takes (spark, docs, sf_dir), works on all documents it is given and returns a DataFrame;
all but the last return the columns of `documents`. Between stages the rows are written as Parquet
to the shared folder and read again. Documents with a null or empty text are rejected by the first
stage; documents without an id are no one's duplicate and stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyframes.llm import decontaminate, jaccard, mixing, rules, secrets
from skyframes.llm.queries import TARGETS, labelled_domains, table
from skyframes.llm.tables import stored

#: no SQL: expectation-maximisation, a random field and a classifier take part
ORACLE_SQL = None


def _apart(docs: DataFrame) -> DataFrame:
    """docs with names for its columns, but for id and text, that no operator gives its results."""
    return docs.withColumnsRenamed({c: f"_own_{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")})


def _back(out: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of docs out of what an operator made of `_apart(docs)`."""
    return out.select(*[F.col(c if c in ("doc_id", "text") else f"_own_{i}").alias(c) for i, c in enumerate(docs.columns)])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    return _back(rules.judged(_apart(docs)).filter("kept"), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The least document of each group of linked ones (five words, similarity 0.8).

    Equal texts of one id stay once, with the least of their other columns; different texts of one id all stay.
    """
    groups = stored(jaccard.linked(docs.select("doc_id", "text"), k=5, percent=80).filter("doc_id is not null"), "groups")
    gone = stored(groups.filter("doc_id != component_id").select("doc_id").distinct(), "duplicates")
    again = stored(groups.groupBy("doc_id").count().filter("count > 1").select("doc_id"), "repeated-ids")
    left = docs.join(gone, "doc_id", "left_anti")
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    least = F.min(F.struct(*[F.col(f"`{c}`") for c in others])).alias("_least")
    once = left.join(again, "doc_id", "left_semi").groupBy("doc_id", "text").agg(least)
    once = once.select("doc_id", "text", *[F.col(f"_least.`{c}`").alias(c) for c in others])
    return left.join(again, "doc_id", "left_anti").unionByName(once).select(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    out = decontaminate.decontaminated(_apart(docs), table(spark, sf_dir, "benchmark"))
    return _back(out.filter(~F.col("contaminated")), docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark."""
    out = secrets.scanned(_apart(docs), secrets.fit(docs.select("doc_id", "text")))
    text = secrets.redacted(F.col("text"), F.col("spans"))
    chars = f"_own_{docs.columns.index('n_chars')}"
    out = out.withColumn(chars, F.when(F.size("spans") > 0, F.length(text).cast("long")).otherwise(F.col(chars)))
    return _back(out.withColumn("text", text), docs)


def mixing_rates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their domain posteriors and the rate at which to use them."""
    out = mixing.mixed_to(docs.select("doc_id", "text", "source"), labelled_domains(table(spark, sf_dir, "labels")), TARGETS)
    return out.select("doc_id", "source", "n_tokens", "domain", "posterior", "rate")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scan", secret_scan),
    ("mixing", mixing_rates),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
