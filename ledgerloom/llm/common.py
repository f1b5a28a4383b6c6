"""What the corpus operators share: the shared work folder and Arrow plumbing."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.shared import drop_folder, forget, new_folder, on_one_machine, shared_root, written  # noqa: F401  the operators take them from here


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_kept(df: DataFrame, id_col: str, text_col: str, keep: tuple[str, ...]) -> DataFrame:
    """(id, text) where id also carries the columns to keep, as (own, kept)."""
    kept = F.struct(*[F.col(c) for c in keep]) if keep else F.lit(None).cast("int")
    return df.select(F.struct(F.col(id_col).alias("own"), kept.alias("kept")).alias("id"), F.col(text_col).cast("string").alias("text"))


def id_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns an operator works on, so that other columns cannot clash."""
    return df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))


def pieces(batch: pa.RecordBatch, most: int) -> Iterator[tuple[pa.Array, list]]:
    """Runs of rows of about `most` characters; a longer text stands alone."""
    texts, start, size = batch.column(1), 0, 0
    lengths = texts.offsets.to_numpy() if hasattr(texts, "offsets") else None
    for i in range(batch.num_rows):
        size += 64 + int(lengths[i + 1] - lengths[i]) if lengths is not None else len(texts[i].as_py() or "")
        if size >= most or i == batch.num_rows - 1:
            yield batch.column(0).slice(start, i + 1 - start), texts.slice(start, i + 1 - start).to_pylist()
            start, size = i + 1, 0


def held_out(id_col) -> F.Column:
    """Whether crc32 of the id as text leaves 2 when divided by 4; false for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def unit(h: F.Column) -> F.Column:
    """A 64-bit hash as a number from 0 to 1, in its order."""
    return h.cast("double") / float(1 << 64) + 0.5


def share(spark: SparkSession, value) -> Callable:
    """Broadcast a value of known size, classes of this package included; the result reads it in a worker."""
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: cloudpickle.loads(sent.value)
