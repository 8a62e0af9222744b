"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake.session import scratch_path

#: Rows of one result batch sent back to the JVM.
OUT_ROWS = 50_000

#: White space between words, as in the word rule [^\x20\x09-\x0D]+.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def body(text: str | Column) -> Column:
    """A text column as UTF-8 bytes; null is the empty text."""
    col = F.col(text) if isinstance(text, str) else text
    return F.coalesce(col, F.lit("")).cast("binary")


def id_and_body(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns an operator needs, under fixed names, so other
    columns of the input never clash with working columns."""
    return docs.select(F.col(id_col).alias("doc_id"), body(text_col).alias("body"))


def map_bodies(df: DataFrame, schema: str, make: Callable[[], Callable[[list, list], list]]) -> DataFrame:
    """Per-document Python over (doc_id, body): ``make()`` is called once a task
    and returns a function from the two lists of a batch to a list of columns."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for b in batches:
            cols = work(b.column(0).to_pylist(), b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(cols, arrow, strict=True)], schema=arrow)

    return df.mapInArrow(run, schema)


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Cut the lineage with a written table in the shared folder."""
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
