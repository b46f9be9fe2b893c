"""Text corpora."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_text_dir(
    spark: SparkSession, path: str, glob: str = "*", encoding: str = "ISO-8859-1"
) -> DataFrame:
    """Every file of a directory as one document: ``doc_id`` (file name), ``text``.

    A missing directory fails when the plan is built. Files of no bytes are
    not listed, as Spark's file sources skip them.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return files.select(
        F.element_at(F.split(F.col("path"), "/"), -1).alias("doc_id"),
        F.decode("content", encoding).alias("text"),
    )


def read_text_lines(
    spark: SparkSession, path: str, glob: str = "*", encoding: str = "ISO-8859-1"
) -> tuple[DataFrame, DataFrame]:
    """The lines of every file (``file``, ``text``) and the files themselves (``file``, ``doc_id``).

    Unlike ``read_text_dir`` this splits a large file over tasks; only one line
    has to fit into a row. The encoding must be one in which the bytes of line
    ends stand for nothing else, as in ISO-8859-1 and UTF-8. The list of files
    reads no contents.
    """
    name = F.col("_metadata.file_path").alias("file")
    listed = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    files = listed.select(name, F.element_at(F.split(F.col("path"), "/"), -1).alias("doc_id"))
    lines = spark.read.option("pathGlobFilter", glob).text(path)
    return lines.select(name, F.decode(F.col("value").cast("binary"), encoding).alias("text")), files
