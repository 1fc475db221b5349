"""Shared helpers: the word rule, the shared work folder, written intermediate tables, Arrow batches."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from finmarts.sources.workdir import shuffles_released

#: A word is a run of characters that are neither a space nor one of the control characters tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"

#: Lower-cases A-Z alone, whatever the locale.
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def words_of(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8; ``bytes.split`` cuts at exactly the six characters of the rule."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def lower_words_of(text: str | None) -> list[bytes]:
    """As `words_of`, with A-Z in lower case (``bytes.lower`` touches no other character)."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; one of our own only where none is set and the session is local."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = f"{tempfile.gettempdir()}/finmarts-{spark.sparkContext.applicationId}"
    os.makedirs(folder, exist_ok=True)
    return folder


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet to the shared folder and read it back.

    Several later branches then read the same rows without running what made
    them again, and a lost executor costs only the tasks it held. The shuffles
    behind it are given up once it is written.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    with shuffles_released(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def batches(rows: dict[str, list], schema: pa.Schema, size: int = 2000) -> Iterator[pa.RecordBatch]:
    """Columns as record batches of at most ``size`` rows."""
    total = len(next(iter(rows.values())))
    for at in range(0, total, size):
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows[f.name][at : at + size], type=f.type) for f in schema], schema=schema
        )


def held_out(doc_id: str, modulus: int, remainder: int):
    """True where crc32 of the id's text has this remainder; null ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus == remainder
