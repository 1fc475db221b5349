"""Data checks: required columns, unique keys, accepted values and row conditions."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DateType, IntegralType

from finmarts.operators.latest import LOAD_ORDER, Keep, first_of_few


@dataclass(frozen=True)
class Checks:
    """Expectations on one table."""

    not_null: Sequence[str] = ()
    unique: Sequence[str] = ()
    accepted: Mapping[str, Sequence] = field(default_factory=dict)
    conditions: Mapping[str, str] = field(default_factory=dict)


#: A table that rows are joined to from the left, and the columns of the same names that they meet by.
Lookup = tuple[DataFrame, Sequence[str]]


def run_checks(df: DataFrame, table: str, checks: Checks, lookups: Sequence[Lookup] = ()) -> DataFrame:
    """One row per check with the number of failing rows (for ``unique``: repeated values).

    The table is planned and read once. Row checks are counted inside each task; where keys are to be unique, the
    counts travel with the partial counts of the key values. Nulls pass the accepted-values and condition checks and
    are no repeated value. The table is checked as if it were joined to the ``lookups``, none of whose other columns is
    checked.
    """
    names, conditions = _row_checks(checks)
    rows, times = _with_matches(df, lookups)
    weighed = rows.withColumns({c: times for c in ["_times"] if lookups})
    return _counted(weighed, table, checks.unique, names, conditions, "_times" if lookups else None)


@dataclass(frozen=True)
class Newest:
    """A clean table that keeps the newest live row of each ``key``.

    ``clean`` makes it, given the step that keeps rows and columns to pass on. ``lookups`` are tables it is joined to
    from the left on columns of the same names, none of which is checked.
    """

    clean: Callable[[Keep, Sequence[Column]], DataFrame]
    key: str
    lookups: Sequence[Lookup] = ()


def run_newest_checks(
    lines: Newest, table: str, checks: Checks, header: Newest | None = None, of_header: Sequence[str] = ()
) -> DataFrame:
    """`run_checks` of a table made from clean lines and, by an inner join on its key, their ``header``.

    The key of the lines is the one column to be unique; the columns ``of_header`` are checked as the header has them.
    Cleaning and row checks look at one row at a time, so they run before keep-latest, whose shuffle then moves the key,
    the load columns and a bit for each row check instead of the columns to be checked. Rows stay where it has put them
    to have their keys counted, or go on to their header as keys and bits. Of a join to a lookup only the number of its
    rows tells in a check.
    """
    names, conditions = _row_checks(checks)
    bits = {n: 1 << i for i, n in enumerate(conditions)}
    of = {n: column in of_header for _, column, n in names}
    own = {n: c for n, c in conditions.items() if not of[n]}
    kept = _newest_failures(lines, own, bits, checks.unique, [header.key] if header else [])
    if header:
        above = _newest_failures(header, {n: c for n, c in conditions.items() if of[n]}, bits, [header.key])
        kept = kept.join(above.toDF(*[c if c == header.key else f"{c}_above" for c in above.columns]), header.key)
        failed = F.col("_failed").bitwiseOR(F.col("_failed_above"))
        times = [F.col(c) for c in kept.columns if c.startswith("_times")]
        kept = kept.select(*checks.unique, failed.alias("_failed"), *([reduce(Column.__mul__, times).alias("_times")] if times else []))
    weight = "_times" if "_times" in kept.columns else None
    found = {n: F.col("_failed").bitwiseAND(F.lit(bit).cast("long")) != 0 for n, bit in bits.items()}
    return _counted(kept, table, checks.unique, names, found, weight)


def _newest_failures(
    table: Newest, conditions: Mapping[str, Column], bits: Mapping[str, int], keys: Sequence[str], also: Sequence[str] = ()
) -> DataFrame:
    """The newest rows of a clean table: ``keys``, ``also``, failed row checks as bits and, with lookups, how often it occurs."""
    rows = table.clean(_every_live, [F.col(table.key).alias("_kept_by"), *[F.col(c) for c in LOAD_ORDER]])
    none = F.lit(0).cast("long")
    failed = reduce(Column.bitwiseOR, [F.when(c, F.lit(bits[n]).cast("long")).otherwise(none) for n, c in conditions.items()], none)
    # a key of the same type before and after cleaning travels once
    same = rows.schema[table.key].dataType == rows.schema["_kept_by"].dataType
    shown = list(dict.fromkeys([*keys, *also]))
    kept_by = table.key if same and table.key in shown else "_kept_by"
    rows, times = _with_matches(rows, table.lookups)
    weight = [times.alias("_times")] if table.lookups else []
    moved = rows.select(*shown, *([] if kept_by in shown else [kept_by]), failed.alias("_failed"), *weight, *LOAD_ORDER)
    return first_of_few(moved, [kept_by]).select(*shown, "_failed", *(["_times"] if table.lookups else []))


def _with_matches(rows: DataFrame, lookups: Sequence[Lookup]) -> tuple[DataFrame, Column]:
    """Rows, and how many rows left joins to the lookups make of each.

    Any key leaves such a join one row, found or not, unless the lookup holds it more than once. Only those keys are
    met here: none, as long as keep-latest has made the lookup unique.
    """
    times = F.lit(1).cast("long")
    for i, (lookup, on) in enumerate(lookups):
        counted = lookup.groupBy(*on).agg(F.count(F.lit(1)).alias(f"_matches{i}"))
        rows = rows.join(F.broadcast(counted.where(F.col(f"_matches{i}") > 1)), list(on), "left")
        times = times * F.coalesce(f"_matches{i}", F.lit(1).cast("long"))
    return rows, times


def _every_live(stg: DataFrame, _: Sequence[str]) -> DataFrame:
    return stg.where(F.col("_is_deleted") == 0)


def _row_checks(checks: Checks) -> tuple[list[tuple[str, str, str]], dict[str, Column]]:
    """(kind, column, counter) of every check of single rows, and the counters' conditions."""
    failing = [("not_null", c, F.col(c).isNull()) for c in checks.not_null]
    failing += [("accepted_values", c, ~F.col(c).isin(list(v))) for c, v in checks.accepted.items()]
    failing += [("expression_is_true", name, ~F.expr(e)) for name, e in checks.conditions.items()]
    names = [(kind, column, f"_c{i}") for i, (kind, column, _) in enumerate(failing)]
    return names, {f"_c{i}": condition for i, (_, _, condition) in enumerate(failing)}


def _counted(
    df: DataFrame,
    table: str,
    unique: Sequence[str],
    names: list[tuple[str, str, str]],
    conditions: Mapping[str, Column],
    weight: str | None = None,
) -> DataFrame:
    """The report of a table, of which a row stands for as many as its ``weight`` says, if it has one."""
    if not unique:
        return _report(df.agg(*[F.count_if(c).alias(n) for n, c in conditions.items()]), table, names)
    flags = {n: F.when(c, F.col(weight) if weight else 1).otherwise(0) for n, c in conditions.items()}
    # a weight counts for every key
    weighed = [F.col(weight).alias("_weight")] if weight else []
    counts = [(F.sum("_weight") if weight else F.count(F.lit(1))).alias("_rows"), *[F.sum(n).alias(n) for n in flags]]
    if len(unique) == 1 and isinstance(df.schema[unique[0]].dataType, (IntegralType, DateType)):
        # grouped by the column as it is: a table that lies by its key is not moved again
        rows = df.select(F.col(unique[0]).alias("_value"), *weighed, *[f.alias(n) for n, f in flags.items()])
        values = rows.groupBy("_value").agg(*counts).withColumn("_key", F.lit(0))
    else:
        # a row for each key, of which the first brings the row checks
        each = [
            F.struct(
                F.lit(i).alias("_key"), F.col(column).cast("string").alias("_value"), *weighed,
                *[(flag if i == 0 else F.lit(0)).alias(n) for n, flag in flags.items()],
            )
            for i, column in enumerate(unique)
        ]
        rows = df.select(F.inline(F.array(*each)))
        values = rows.groupBy("_key", "_value").agg(*counts)
    totals = values.agg(
        *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in flags], *[_repeated(i) for i in range(len(unique))]
    )
    return _report(totals, table, [*names, *[("unique", c, f"_u{i}") for i, c in enumerate(unique)]])


def _repeated(i: int) -> Column:
    repeated = (F.col("_key") == i) & F.col("_value").isNotNull() & (F.col("_rows") > 1)
    return F.count_if(repeated).alias(f"_u{i}")


def _report(totals: DataFrame, table: str, names: list[tuple[str, str, str]]) -> DataFrame:
    """Turn one row of counters into one row per check."""
    rows = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(kind).alias("check_name"),
            F.lit(column).alias("column_name"),
            F.col(counter).cast("long").alias("failing_rows"),
        )
        for kind, column, counter in names
    ]
    return totals.select(F.inline(F.array(*rows)))
