"""Parquet tables whose content is switched at once: a manifest names the folders in force.

A table's folder holds ``_state=<number>-<id>/<column>=<value>/`` folders and numbered manifests. A writer puts what it
changes into a version folder of its own and then adds the next manifest, which names for each partition value the
version that holds it. Manifests appear by one rename and are never changed, so a reader sees the table as it was
before or after a write, never in between, and a writer that dies changes nothing. Two writers can't both add the same
number: the later one fails and may run again.

The manifest also names the folders of other tables that a table was made from, and `changed` tells which of them have
been replaced since, so that a table can follow the changes of those below it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from finmarts.sources import files
from finmarts.sources.workdir import shuffles_released

#: Starts with an underscore, so that no column of a table is likely to have the name.
VERSION = "_state"
MANIFESTS = "_manifests"
#: Ids and amounts make up most of a table, which this codec writes in fewer bytes than Spark's default does.
CODEC = "zstd"
#: Manifests that stay readable when a later one is added.
KEPT = 3


@dataclass(frozen=True)
class Manifest:
    """One state of a table: per partition value (a number; 0 where a table isn't split) its version folder."""

    number: int
    schema: StructType
    by: str | None
    folders: Mapping[int, str]
    #: The folders of the tables it was made from, as they were then.
    sources: Mapping[str, Mapping[int, str]] = field(default_factory=dict)
    marks: Mapping[str, str] = field(default_factory=dict)

    def text(self) -> str:
        sources = {name: _text_keys(folders) for name, folders in self.sources.items()}
        return json.dumps({
            "number": self.number, "schema": self.schema.jsonValue(), "by": self.by,
            "folders": _text_keys(self.folders), "sources": sources, "marks": dict(self.marks),
        })


def _text_keys(folders: Mapping[int, str]) -> dict[str, str]:
    return {str(k): v for k, v in sorted(folders.items())}


def _number_keys(folders: Mapping[str, str]) -> dict[int, str]:
    return {int(k): v for k, v in folders.items()}


Sources = Mapping[str, Mapping[int, str]]


class ConcurrentWrite(RuntimeError):
    """Another writer has added the manifest that this one was about to add."""


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n.split(".")[0]) for n in files.names(spark, f"{path}/{MANIFESTS}") if n[0].isdigit())


def manifest(spark: SparkSession, path: str, number: int | None = None) -> Manifest | None:
    """The newest manifest of the table at ``path``, or the one asked for; None if nothing was ever written there."""
    if number is None:
        numbers = _numbers(spark, path)
        if not numbers:
            return None
        number = numbers[-1]
    found = json.loads(files.read_text(spark, f"{path}/{MANIFESTS}/{number:08d}.json"))
    sources = {name: _number_keys(folders) for name, folders in found["sources"].items()}
    schema = StructType.fromJson(found["schema"])
    return Manifest(number, schema, found["by"], _number_keys(found["folders"]), sources, found["marks"])


def read(spark: SparkSession, path: str, state: Manifest | None = None) -> DataFrame:
    """The table as one manifest has it, the newest by default, with its partition column; folders are named, not listed."""
    state = state or manifest(spark, path)
    if state is None:
        raise FileNotFoundError(f"no table at {path}")
    split = [StructField(state.by, IntegerType())] if state.by else []
    if not state.folders:
        return spark.createDataFrame([], StructType([*state.schema.fields, *split]))
    schema = StructType([*state.schema.fields, StructField(VERSION, StringType()), *split])
    if state.by:
        folders = [f"{path}/{v}/{state.by}={k}" for k, v in sorted(state.folders.items())]
    else:
        folders = [f"{path}/{v}" for v in state.folders.values()]
    return spark.read.schema(schema).option("basePath", path).parquet(*folders).drop(VERSION)


def write_folder(df: DataFrame, path: str, by: str | None, base: Manifest | None) -> tuple[str, list[int]]:
    """Write rows into a version folder of its own, not yet in force; its name and the partition values it holds."""
    spark = df.sparkSession
    if base is None and (foreign := [n for n in files.names(spark, path) if n[0] not in "._"]):
        raise FileExistsError(f"{path} holds files that no manifest names, such as {foreign[0]}")
    folder = f"{VERSION}={(base.number if base else 0) + 1:08d}-{uuid.uuid4().hex[:12]}"
    writer = df.write.partitionBy(by) if by else df.write
    with shuffles_released(spark):
        writer.parquet(f"{path}/{folder}", compression=CODEC)
    if not by:
        return folder, [0]
    found = files.names(spark, f"{path}/{folder}")
    return folder, [int(n.split("=")[1]) for n in found if n.startswith(f"{by}=")]


def commit(
    spark: SparkSession,
    path: str,
    schema: StructType,
    by: str | None,
    folders: Mapping[int, str],
    base: Manifest | None,
    sources: Sources | None = None,
    marks: Mapping[str, str] | None = None,
) -> Manifest:
    """Put a new state in force, on top of the one it was made from."""
    plain = StructType([StructField(f.name, f.dataType, True) for f in schema.fields if f.name != by])
    state = Manifest((base.number if base else 0) + 1, plain, by, dict(folders), sources or {}, marks or {})
    if not files.write_new_text(spark, f"{path}/{MANIFESTS}/{state.number:08d}.json", state.text()):
        raise ConcurrentWrite(f"{path}: state {state.number} was written by another run")
    _clear(spark, path, state.number)
    return state


def _clear(spark: SparkSession, path: str, number: int) -> None:
    """Drop manifests beyond those kept, and version folders that none of the kept names and no running writer makes."""
    numbers = _numbers(spark, path)
    gone = numbers[:-KEPT]
    for n in gone:
        files.delete(spark, f"{path}/{MANIFESTS}/{n:08d}.json")
    used = {v for n in numbers[-KEPT:] for v in manifest(spark, path, n).folders.values()}
    for name in files.names(spark, path):
        # a folder made for a state that was added long ago, but not in use, is a dead writer's or an old one
        if name.startswith(f"{VERSION}=") and name not in used and int(name.split("=")[1].split("-")[0]) <= number - KEPT + 1:
            files.delete(spark, f"{path}/{name}")


def replace(
    df: DataFrame, path: str, by: str | None = None, sources: Sources | None = None, marks: Mapping[str, str] | None = None
) -> Manifest:
    """Full rebuild: the rows, with their partition column, become the whole table."""
    base = manifest(df.sparkSession, path)
    folder, values = write_folder(df, path, by, base)
    return commit(df.sparkSession, path, df.schema, by, {v: folder for v in values}, base, sources, marks)


def replace_partitions(
    df: DataFrame,
    path: str,
    affected: Iterable[int],
    base: Manifest,
    sources: Sources | None = None,
    marks: Mapping[str, str] | None = None,
) -> Manifest:
    """The rows become the whole content of the ``affected`` partitions; others keep their files."""
    folder, values = write_folder(df, path, base.by, base)
    if extra := set(values) - set(affected):
        raise ValueError(f"rows outside the partitions to be replaced: {sorted(extra)[:5]}")
    kept = {k: v for k, v in base.folders.items() if k not in set(affected)}
    schema = StructType([f for f in df.schema.fields if f.name != base.by])
    return commit(
        df.sparkSession, path, schema, base.by, kept | {v: folder for v in values}, base,
        base.sources if sources is None else sources, base.marks if marks is None else marks,
    )


def changed(before: Mapping[int, str], after: Mapping[int, str]) -> list[int]:
    """Partition values whose content may differ between two states of a table, given by their folders."""
    return sorted(k for k in {*before, *after} if before.get(k) != after.get(k))


def at_partitions(table: DataFrame, by: str, values: Iterable[int]) -> DataFrame:
    return table.where(F.col(by).isin([int(v) for v in values]))
