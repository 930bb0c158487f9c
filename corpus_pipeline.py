"""From raw documents to a training mix: five stages, each over all that the one before kept.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which :func:`run`
writes and reads again for the next. All but the last return the columns of ``documents``.

The last has a row for each chosen document, with ``copies``, how often the mix has it:
a consumer repeats the row so many times, or weights it. Further columns of the documents
are carried through under any name; of these, ``copies`` and ``taken`` are replaced by the last.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm import toxicity
from barlake.llm.decontamination import decontaminate
from barlake.llm.jaccard import keep_one
from barlake.llm.mixing import pareto_mix
from barlake.llm.storage import read, written
from barlake.llm.suffixes import remove_repeated_substrings

#: A document with this score or a higher one is rejected.
TOXIC = 0.7
#: A document of which a larger share of words is in test items is rejected; from
#: others the spans are cut out.
COVERAGE = 0.5


#: The columns that stages know; others they only carry.
DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


def _carrying(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The stage, with further columns under names that no operator uses while it works."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        aside = {c: f"_carried{i}" for i, c in enumerate(docs.columns) if c.lower() not in DOCUMENT}
        out = stage(spark, docs.withColumnsRenamed(aside), sf_dir)
        added = {c.lower() for c in out.columns}
        out = out.drop(*[kept for c, kept in aside.items() if c.lower() in added])
        return out.withColumnsRenamed({kept: c for c, kept in aside.items()})

    return run


def _with_text(docs: DataFrame, text: str, columns: list[str]) -> DataFrame:
    """The documents' columns with another text and its length."""
    new = docs.withColumn("text", F.col(text))
    return new.withColumn("n_chars", F.length("text").cast("long")).select(*columns)


@_carrying
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 1: documents that the factorization machine takes for toxic go."""
    labels = read(spark, sf_dir, "labels").filter(toxicity.learnt_from(F.col("doc_id")))
    scored = toxicity.score(docs, toxicity.fit(docs, labels), name="_score")
    return scored.filter(F.col("_score") < TOXIC).select(*docs.columns)


@_carrying
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 2: one document of each group of 0.8 similar five-word shingles stays."""
    return keep_one(docs, n=5, percent=80)


@_carrying
def drop_repeated_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 3: bytes of 200-byte strings that occur twice are cut out of the texts."""
    kept = remove_repeated_substrings(docs, length=200, as_text=True)
    # A null text stays null.
    kept = kept.withColumn("_kept", F.when(F.col("text").isNotNull(), F.col("_kept")))
    return _with_text(kept, "_kept", docs.columns)


@_carrying
def drop_contamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 4: spans that are in test items are cut out, documents made up of them go."""
    found = decontaminate(docs, read(spark, sf_dir, "benchmark"), window=10)
    clean = found.filter(F.col("_hits") <= COVERAGE * F.col("_words"))
    return _with_text(clean, "_kept", docs.columns)


@_carrying
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 5: documents by how often the mix takes them (``copies``, 1 at least).

    One row stands for all copies; ``taken`` is their words. Weigh or repeat rows by ``copies``.
    """
    rows = written(docs.withColumn("_row", F.monotonically_increasing_id()), "mix")
    taken = pareto_mix(rows, carry=["_row"]).select("_row", "copies", "taken")
    return rows.join(taken.filter("copies > 0"), "_row").drop("_row")


STAGES = [
    ("toxicity", drop_toxic),
    ("jaccard", drop_near_duplicates),
    ("suffixes", drop_repeated_substrings),
    ("decontamination", drop_contamination),
    ("mixing", mix),
]

#: The factorization machine and the hash-ordered sample have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
