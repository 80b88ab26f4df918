"""The corpus pipeline: five stages over documents, each written as Parquet and reread as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tenantgraph.llm.line_dedup import drop_repeated_lines
from tenantgraph.llm.mixing import mixed
from tenantgraph.llm.packing import pack
from tenantgraph.llm.quality_rules import quality_rules
from tenantgraph.llm.shared import mark, release, stash
from tenantgraph.llm.simhash import drop_near_copies


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    names = [f"__tg_{i}" for i in range(len(docs.columns))]
    own = docs.toDF(*names)
    judged = quality_rules(own, id_col=names[docs.columns.index("doc_id")], text_col=names[docs.columns.index("text")], keep=tuple(n for n in names if n != names[docs.columns.index("doc_id")]))
    return judged.where("kept").select(*names).toDF(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that more than a tenth of a source's documents hold go from the texts; every document stays."""
    return drop_repeated_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return drop_near_copies(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their source takes them."""
    return mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences."""
    return pack(docs)


STAGES = [("quality rules", quality), ("line dedup", lines), ("SimHash near-dedup", near_copies), ("mixing sources", mixing), ("best-fit packing", packing)]

#: Packing needs a tokenizer, which SQL lacks; the pipeline is tested against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another. What a stage has written for itself goes when its result is written; the last one's result is lazy
    and reads its tables, which llm.shared.release() removes afterwards."""
    docs, begin = spark.read.parquet(f"{sf_dir}/documents.parquet"), mark(spark)
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stash(docs, f"pipeline-{i}")
            release(spark, begin, but=1)
    return docs
