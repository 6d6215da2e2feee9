"""Helpers shared by the operators: frames of whole texts, tables written on the way, and batches in tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from netwatch.session import work_dir

# Texts that a task holds as Python objects at one time.
SLICE_BYTES = 2 << 20


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# Removes the shuffle files of a query when it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved(frame: DataFrame, label: str) -> DataFrame:
    """The frame, written to the shared folder and read back, so that nothing before it runs again.

    The table is all that later steps need, so the shuffle files behind it go once it is written.
    """
    spark = frame.sparkSession
    path = work_dir(spark, label)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        frame.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(frame.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Removes the folders of tables that ``saved`` wrote. Nothing may read them any more."""
    for frame in frames:
        context = frame.sparkSession.sparkContext
        for folder in {name.rpartition("/")[0] for name in frame.inputFiles()}:
            path = context._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def remainder(number: Column, modulus: int) -> Column:
    """crc32 of a number written in decimal, modulo ``modulus``; NULL counts as empty text."""
    return F.crc32(F.coalesce(number.cast("string"), F.lit(""))) % modulus


def texts(docs: DataFrame, *others: str, text: str = "text") -> DataFrame:
    """Only the named columns, with the text as bytes in the last one, called ``_text``."""
    return docs.select(*others, F.col(text).cast("binary").alias("_text"))


def sliced(batch: pa.RecordBatch, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Runs of rows with about ``limit`` bytes in their last column, and that column's values."""
    values = batch.column(batch.num_columns - 1)
    start, size, held = 0, 0, []
    for i in range(batch.num_rows):
        value = values[i].as_py()
        held.append(value)
        size += len(value or b"")
        if size >= limit:
            yield batch.slice(start, len(held)), held
            start, size, held = i + 1, 0, []
    if held:
        yield batch.slice(start, len(held)), held


def numbered_names(frame: DataFrame) -> DataFrame:
    """The frame with its columns called ``_c0``, ``_c1`` and so on, so that none clashes with another."""
    return frame.toDF(*(f"_c{i}" for i in range(len(frame.columns))))


def where(
    docs: DataFrame, judge: Callable[[DataFrame, list[str], str], DataFrame], condition: str, text: str
) -> DataFrame:
    """The rows, with all their columns, that fulfil a condition on what ``judge`` adds to them."""
    own = numbered_names(docs)
    found = judge(own, own.columns, f"_c{docs.columns.index(text)}")
    return found.filter(condition).select(*own.columns).toDF(*docs.columns)


def per_text(
    docs: DataFrame,
    keep: list[str],
    schema: str,
    make: Callable[[], Callable[[list], dict[str, list]]],
    text: str = "text",
    limit: int = SLICE_BYTES,
) -> DataFrame:
    """The kept columns of each row, and what a function made once per task finds in its text (bytes or None).

    The function takes a list of texts, about ``limit`` bytes, and returns a list per new column of ``schema``. A kept column with
    the name of a new one is left out.
    """
    added = StructType.fromDDL(schema)
    keep = [name for name in keep if name not in added.names]
    frame = texts(docs, *(F.col(name).alias(f"_c{i}") for i, name in enumerate(keep)), text=text)
    out = frame.drop("_text").schema
    for field in added:
        out = out.add(f"_new_{field.name}", field.dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part, values in sliced(batch, limit):
                found = work(values)
                arrays = part.columns[:-1] + [pa.array(found[f.name], to_arrow_type(f.dataType)) for f in added]
                yield pa.RecordBatch.from_arrays(arrays, names=out.names)

    return frame.mapInArrow(run, out).toDF(*keep, *added.names)
