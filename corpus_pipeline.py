"""A training-data pipeline over ``documents``, from the operators of ``attrix.llm``.

Each stage reads its predecessor's rows as Parquet. All but the last return the
columns of ``documents``:

1. *toxicity*: drops the documents predicted toxic (score >= 0.7), fitted on
   those labels of the training fold whose documents are in the input;
2. *near_duplicates*: of the rows that the n-gram Jaccard join links, the first in
   the order of the stage's input files stays;
3. *decontamination*: drops documents that hold a benchmark item;
4. *packing*: packs what is left into sequences of 1,024 tokens.

Documents without words are no one's duplicate (of wholly equal rows one stays),
hold no benchmark item, and are packed with their end id. The second and third stage decide each row by its own
text, so rows with a null ``doc_id``, or with one that others have too, are rows
like others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attrix.llm.common import ship, stored, table
from attrix.llm.decontaminate import decontaminate
from attrix.llm.encoding import vocabulary_path
from attrix.llm.packing import pack
from attrix.llm.shingle_join import shingle_components
from attrix.llm.toxicity import TRAIN_FOLD, fit, score


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    model = fit(docs, table(spark, sf_dir, "labels"), TRAIN_FOLD)
    return score(docs, model).where("predicted = 0").select(*docs.columns)


#: names a row of the stage's input: partition and place in it, the same at every read of the same files
ROW = "__pipeline_row"


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    rows = docs.withColumn(ROW, F.monotonically_increasing_id())
    found = shingle_components(rows, id_col=ROW)
    words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    first = rows.where(words).join(found.where(f"component_id <> {ROW}").select(ROW), ROW, "left_anti")
    # no words, no group: of wholly equal rows one stays
    return first.select(*docs.columns).unionByName(docs.where(~words).distinct())


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return pack(docs, vocabulary_path("byte_bpe_50k.json"), end_id=0).drop("ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: fitted models and tokenizers have no SQL form; tests/llm holds the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
