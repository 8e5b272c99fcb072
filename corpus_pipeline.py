"""A training-data pipeline of operators from ``tallystar.llm``, each stage written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallystar.llm import line_dedup, mixing, ngram_join, packing, quality_classifier
from tallystar.llm.tables import table
from tallystar.sources.scratch import pin

#: Each takes (spark, docs, sf_dir); all but the last return the columns of documents.
STAGES = [
    ("quality classifier", quality_classifier.stage),
    ("line dedup", line_dedup.stage),
    ("n-gram Jaccard join", ngram_join.stage),
    ("mixing sources", mixing.stage),
    ("best-fit packing", packing.stage),
]

#: SQL cannot express the classifier and the token ids.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, over all documents; a row per packed piece (``packing.pack``).

    Null and empty texts are scored by their counts, which are 0, and, if kept, packed as one id; as sets without words they link with
    nothing. Texts of any length are read whole, and cut only by packing, into pieces of a sequence. Of rows equal in doc_id and text one
    stays; rows that share an id but not the text are judged one by one and stay or go together in the join. A null id is
    an id. A null source is the source ''. Extra columns, whatever their names, go along unread until packing. Without labels all
    documents have quality 0.5 and are kept. An empty table gives an empty result.
    """
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = pin(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
