"""From raw documents to a mixed corpus: language, near-duplicates, decontamination, personal data, mixing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.llm import decontam, langid, mixing, nearcopies, pii
from inkwell.llm.common import table
from inkwell.llm.sampling import remainder
from inkwell.staging import scratch

#: How much likelier than an even chance a language has to be; less is no language of the corpus.
ABOVE_CHANCE = 1.2


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or of no language that the network knows, go. If there was none to learn from, all with a letter stay."""
    net = langid.fit(docs, learn=remainder("doc_id", 4) != 2)
    if net is None:
        return docs.where(docs["text"].rlike(r"\p{L}"))
    judged = langid.identify(docs.select(F.struct(*docs.columns).alias("row"), "text"), net)
    least = min(1.0, ABOVE_CHANCE / len(net.classes))
    return judged.where((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= least)).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every component of documents alike in four fifths of their runs of five words, the one with the smallest doc_id stays, once.

    SimHash fingerprints of five words propose pairs through their pivot tables;
    what lies beyond their four bits is found by an exact join.
    """
    return nearcopies.representatives(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked in every text; n_chars follows."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for, numbered in `copy`."""
    return mixing.mix(docs, number="copy")


STAGES = [
    ("language ID", language),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("PII", personal_data),
    ("mixing sources to target weights", mix),
]

#: SQL can express neither the network nor the trees; tests/llm/test_pipeline.py holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to documents, each on the stored result of the one before; of what they store, the end result alone remains."""
    with scratch(spark) as keep:
        docs = table(spark, sf_dir, "documents")
        for _, stage in STAGES[:-1]:
            with scratch(spark) as inner:
                docs = inner(stage(spark, docs, sf_dir))
        return keep(STAGES[-1][1](spark, docs, sf_dir))
