"""From raw documents to packed training sequences: five stages, each a table in the shared folder.

Every stage is one operator on all that the stage before it kept, written as Parquet and
read again, so a lost executor costs a stage's missing tasks and no more:

1. quality rules drop rejected documents,
2. SimHash near-duplicates keep one document of each group,
3. personal data becomes format-preserving pseudonyms,
4. sources are mixed to their target weights: a document's row appears once for each whole
   copy taken, and once with the words of its selected blocks,
5. best-fit packing gives every piece of every text its sequence and offset.

``n_chars``, where present, follows the text that stages 3 and 4 change.  ``ORACLE_SQL`` is
None: fingerprints, permutations and packing are beyond SQL; the tests hold each stage and
the whole run against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import mixing, packing, pii, quality_rules, simhash
from tidewatch.session import scratch_path
from tidewatch.sources.tables import read_table

ORACLE_SQL = None


def _counted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.length("text").cast(kind))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first(docs)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(pii.pseudonymised(docs, spans=None))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(mixing.mixed(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [("quality_rules", quality), ("simhash_near_dedup", near_duplicates), ("pii", private_data),
          ("source_mixing", mix), ("best_fit_packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the ``documents`` table."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
