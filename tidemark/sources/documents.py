"""Document collections exported as JSON."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.documents import with_document_times
from tidemark.functions.timestamps import wall_micros
from tidemark.names import col
from tidemark.operators.filters import documents_changed_since
from tidemark.sources.footers import AT


def read_documents(
    spark: SparkSession, path: str, json_array: bool = False, doc: str = "doc", one_line: bool = False
) -> DataFrame:
    """One VARIANT per document.

    JSON lines split freely. With ``json_array`` each file holds an array of
    documents, or each line does with ``one_line``, and every element gives a
    row. A file whose array spans lines is parsed by one task, so such exports
    should be chunked.
    """
    whole_files = json_array and not one_line
    read = spark.read.option("singleVariantColumn", doc).option("multiLine", whole_files).json(path)
    if not json_array:
        return read
    elements = F.try_variant_get(col(doc), "$", "array<variant>")
    return read.select(F.explode(F.coalesce(elements, F.array(col(doc)))).alias(doc))


def as_documents(df: DataFrame, doc: str = "doc") -> DataFrame:
    """One VARIANT per row of a connector that gives columns; a single variant column stays as it is."""
    if [f.dataType.typeName() for f in df.schema.fields] == ["variant"]:
        return df.select(col(df.columns[0]).alias(doc))
    return df.select(F.to_variant_object(F.struct(*[col(c) for c in df.columns])).alias(doc))


def read_changed_documents(
    spark: SparkSession, path: str, mark, inserted: str | None, updated: str | None, json_array: bool = False, doc: str = "doc"
) -> DataFrame:
    """Documents inserted or updated after the mark, by fields named in the spec."""
    return documents_changed_since(read_documents(spark, path, json_array, doc), mark, doc, inserted, updated)


def stage_documents(docs: DataFrame, path: str, inserted: str | None, updated: str | None, doc: str = "doc") -> DataFrame:
    """Documents with their newest time beside them, as a number that the Parquet scan can filter by.

    Texts are parsed here, once; whoever reads changes from the stage later decodes
    only the row groups that hold some.
    """
    fields = [field for field in dict.fromkeys((inserted, updated)) if field]
    times = {f"__time_{at}": field for at, field in enumerate(fields)}
    read = [col(name) for name in times]
    newest = F.greatest(*read) if len(read) > 1 else read[0] if read else F.lit(None).cast("timestamp_ntz")
    rows = with_document_times(docs, doc, times).withColumn(AT, wall_micros(newest)).drop(*times)
    rows.write.parquet(path)
    return docs.sparkSession.read.schema(rows.schema).parquet(path)


def staged_documents_since(staged: DataFrame, mark: datetime) -> DataFrame:
    """Documents of a stage inserted or updated after the mark."""
    return staged.filter(col(AT) > F.lit((mark - datetime(1970, 1, 1)) // timedelta(microseconds=1))).drop(AT)
