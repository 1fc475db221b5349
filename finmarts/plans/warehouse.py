"""The ERP lineage as named tables, computed lazily or published to parquet.

``Warehouse(spark, source, as_of)`` gives every table as an attribute. Nothing runs
until a table is used. The monthly ledger aggregate, which several reports share, is
kept by Spark after its first use; ``release`` gives it up. ``publish`` writes tables
layer by layer; layers above read what lies below the same path, and what already
exists there is refreshed by the keys, months and years that have changed.
"""

from __future__ import annotations

import copy
import datetime as dt
import os
import uuid
from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from finmarts.functions.calendar import CalendarRange, dim_date
from finmarts.functions.rules import day
from finmarts.operators.checks import Lookup, Newest, run_checks, run_newest_checks
from finmarts.operators.latest import LOAD_ORDER, latest_live
from finmarts.operators.lookups import lookup_side
from finmarts.operators.keyed import BUCKET, bucketed, merge_arrivals, unseen
from finmarts.operators.ranges import Ranges, in_ranges, noted, ranges_of
from finmarts.operators.upsert import newest_date, recent_rows, upsert_table
from finmarts.plans import balance, cashflow, dims, facts, kpi, monthly, ods, pnl, receivables, refresh, sales
from finmarts.plans.expectations import EXPECTATIONS
from finmarts.sources.readers import Source
from finmarts.sources import files, versions
from finmarts.sources.sinks import MONTH, UNDATED, YEAR, arranged, laid_out_by, partition_of, write_table
from finmarts.sources.workdir import shuffles_released

ODS = [
    "ods_company", "ods_accounts", "ods_clients", "ods_managers", "ods_products", "ods_suppliers", "ods_warehouses",
    "ods_purchase_orders", "ods_purchase_order_lines", "ods_sales_orders", "ods_sales_order_lines", "ods_invoices",
    "ods_inventory_movements", "ods_marketing_spend", "ods_gl_postings",
]
DIMS = [
    "dim_account", "dim_client", "dim_company", "dim_manager", "dim_product", "dim_supplier", "dim_warehouse",
    "dim_channel", "dim_scenario", "dim_date",
]
FACTS = ["fct_gl_entry", "fct_invoice", "fct_marketing_spend", "fct_purchase_order_line", "fct_sales_order_line"]
MONTHLY = ["int_pnl_monthly", "int_balance_monthly", "int_sales_monthly"]
MARTS = [
    "dm_pnl_periodic", "dm_balance_monthly", "dm_cashflow_monthly", "dm_exec_kpi_monthly",
    "dm_sales_marketing_periodic", "dm_working_capital_monthly", "dm_ar_ap_aging_snapshot",
]
TABLES = [*ODS, *DIMS, *FACTS, *MONTHLY, *MARTS]

#: Table -> (date the files are split by, split, sort order inside the files).
LAYOUT: dict[str, tuple[str | None, str, Sequence[str]]] = {
    "ods_purchase_orders": ("po_date", MONTH, ["po_date", "supplier_id", "po_id"]),
    "ods_purchase_order_lines": (None, MONTH, ["po_id", "po_line_id"]),
    "ods_sales_orders": ("order_date", MONTH, ["order_date", "client_id", "order_id"]),
    "ods_sales_order_lines": (None, MONTH, ["order_id", "order_line_id"]),
    "ods_invoices": ("invoice_date", MONTH, ["invoice_date", "invoice_type", "counterparty_id", "invoice_id"]),
    "ods_inventory_movements": ("move_date", MONTH, ["move_date", "warehouse_id", "product_id", "move_id"]),
    "ods_marketing_spend": ("spend_date", MONTH, ["spend_date", "platform", "spend_id"]),
    "ods_gl_postings": ("posting_date", MONTH, ["posting_date", "account_id", "gl_id"]),
    "ods_products": (None, MONTH, ["category", "product_id"]),
    "dim_product": (None, MONTH, ["category", "product_id"]),
    "int_pnl_monthly": ("period", YEAR, ["period", "account_id", "scenario_id"]),
    "int_balance_monthly": ("period", YEAR, ["period", "account_id", "scenario_id"]),
    "int_sales_monthly": ("period", YEAR, ["period", "client_id", "product_id"]),
    "dm_pnl_periodic": ("period_start", YEAR, ["period_type", "period_start", "scenario_id"]),
    "dm_balance_monthly": ("period", YEAR, ["period", "scenario_id"]),
    "dm_cashflow_monthly": ("period", YEAR, ["period", "scenario_id"]),
    "dm_exec_kpi_monthly": ("period", YEAR, ["period", "scenario_id"]),
    "dm_sales_marketing_periodic": (
        "period_start", YEAR, ["period_type", "period_start", "client_segment", "product_category"],
    ),
    "dm_working_capital_monthly": ("period", YEAR, ["period", "invoice_type", "counterparty_segment"]),
    "dm_ar_ap_aging_snapshot": (None, MONTH, ["invoice_type", "aging_bucket", "counterparty_id", "invoice_id"]),
}

#: Fact -> (key, date the files are split by, sort order inside the files).
FACT_LAYOUT = {
    "fct_gl_entry": ("gl_id", "posting_date", ["posting_date", "account_id", "scenario_id", "gl_id"]),
    "fct_invoice": ("invoice_id", "invoice_date", ["invoice_date", "invoice_type", "counterparty_id", "invoice_id"]),
    "fct_marketing_spend": ("spend_id", "spend_date", ["spend_date", "platform", "campaign_id", "spend_id"]),
    "fct_purchase_order_line": ("po_line_id", "po_date", ["po_date", "supplier_id", "product_id", "po_line_id"]),
    "fct_sales_order_line": ("order_line_id", "order_date", ["order_date", "client_id", "product_id", "order_line_id"]),
}

#: Fact -> the clean table that gives its dates, and the lines below it with the key they share.
DRIVERS = {
    "fct_gl_entry": ("ods_gl_postings", None, None),
    "fct_invoice": ("ods_invoices", None, None),
    "fct_marketing_spend": ("ods_marketing_spend", None, None),
    "fct_purchase_order_line": ("ods_purchase_orders", "ods_purchase_order_lines", "po_id"),
    "fct_sales_order_line": ("ods_sales_orders", "ods_sales_order_lines", "order_id"),
}
#: Lines -> (header, key, date of the header). Lines are laid out by the month of their header.
HEADERS = {
    "ods_purchase_order_lines": ("ods_purchase_orders", "po_id", "po_date"),
    "ods_sales_order_lines": ("ods_sales_orders", "order_id", "order_date"),
}
#: Clean table -> (its staging table, key, dimension made from it row by row). These are kept by key.
KEYED = {
    "ods_accounts": ("stg_accounts", "account_id", "dim_account"),
    "ods_clients": ("stg_clients", "client_id", "dim_client"),
    "ods_managers": ("stg_managers", "manager_id", "dim_manager"),
    "ods_products": ("stg_products", "product_id", "dim_product"),
    "ods_suppliers": ("stg_suppliers", "supplier_id", "dim_supplier"),
    "ods_warehouses": ("stg_warehouses", "warehouse_id", "dim_warehouse"),
}
#: Clean table that can be large -> (its staging table, key, how it is cleaned).
CLEANED = {
    "ods_purchase_orders": ("stg_purchase_orders", "po_id", ods.purchase_orders),
    "ods_purchase_order_lines": ("stg_purchase_order_lines", "po_line_id", ods.purchase_order_lines),
    "ods_sales_orders": ("stg_sales_orders", "order_id", ods.sales_orders),
    "ods_sales_order_lines": ("stg_sales_order_lines", "order_line_id", ods.sales_order_lines),
    "ods_invoices": ("stg_invoices", "invoice_id", ods.invoices),
    "ods_inventory_movements": ("stg_inventory_movements", "move_id", ods.inventory_movements),
    "ods_marketing_spend": ("stg_marketing_spend", "spend_id", ods.marketing_spend),
    "ods_gl_postings": ("stg_gl_postings", "gl_id", ods.gl_postings),
}
#: Fact -> (the clean tables it is made from, lines before header; what it checks of the header).
#: The other columns it checks are those of the lines, as they are there.
CHECKED_BELOW: dict[str, tuple[Sequence[str], Sequence[str]]] = {
    "fct_gl_entry": (["ods_gl_postings"], []),
    "fct_invoice": (["ods_invoices"], []),
    "fct_marketing_spend": (["ods_marketing_spend"], []),
    "fct_purchase_order_line": (["ods_purchase_order_lines", "ods_purchase_orders"], ["po_date", "supplier_id"]),
    "fct_sales_order_line": (["ods_sales_order_lines", "ods_sales_orders"], ["order_date", "client_id"]),
}
#: What the checks of the reports on receivables and payables need of an invoice.
INVOICE_FIGURES = [
    "invoice_date", "invoice_type", "counterparty_type", "counterparty_id", "amount", "outstanding", "days_overdue",
]
KEYED_DIMS = {dim: (table, key) for table, (_, key, dim) in KEYED.items()}
#: Aggregate -> facts it is made from; they are brought up to date by year.
AGGREGATES = {
    "int_pnl_monthly": ["fct_gl_entry"],
    "int_balance_monthly": ["fct_gl_entry"],
    "int_sales_monthly": ["fct_sales_order_line"],
    "dm_pnl_periodic": ["fct_gl_entry"],
    "dm_sales_marketing_periodic": ["fct_sales_order_line", "fct_marketing_spend"],
}


class Warehouse:
    def __init__(
        self, spark: SparkSession, source: Source, as_of: dt.date, calendar: CalendarRange = CalendarRange()
    ) -> None:
        self.spark = spark
        self.source = source
        self.as_of = as_of
        self.calendar = calendar

    def table(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise KeyError(name)
        return getattr(self, name)

    def checks(self, name: str) -> DataFrame:
        """Results of the data checks declared for a table."""
        if name in CLEANED and name not in self.__dict__:
            return run_newest_checks(self._newest(name), name, EXPECTATIONS[name])
        below, of_header = CHECKED_BELOW.get(name, ([], []))
        if below and not {name, *below} & set(self.__dict__):
            lines, *headers = [self._newest(table, self._joined_to(table)) for table in below]
            return run_newest_checks(lines, name, EXPECTATIONS[name], *headers, of_header=of_header)
        if name not in self.__dict__ and (mart := self._mart_to_check(name)):
            rows, lookups = mart
            return run_checks(rows, name, EXPECTATIONS[name], lookups)
        return run_checks(self.table(name), name, EXPECTATIONS[name])

    def _mart_to_check(self, name: str) -> tuple[DataFrame, Sequence[Lookup]] | None:
        """A mart whose checks share a pass over a fact with other marts' checks, and what it is joined to besides."""
        if name == "dm_pnl_periodic" and "fct_gl_entry" not in self._published:
            return pnl.periodic(self.gl_daily, "total_signed"), []
        if {"ods_invoices", "fct_invoice"} & self._published:
            return None
        if name == "dm_working_capital_monthly":
            clients, suppliers = self._lookup("dim_client"), self._lookup("dim_supplier")
            return receivables.working_capital_monthly(facts.invoice(self._invoices, clients, suppliers, self.calendar)), []
        if name == "dm_ar_ap_aging_snapshot":
            # what is checked of an open invoice is in the clean table, where rows lie by their key
            return receivables.open_invoices(self._invoices), self._joined_to("ods_invoices")
        return None

    @cached_property
    def _invoices(self) -> DataFrame:
        """Clean invoices, of which loads that tie in every load column are told apart by their figures.

        Whichever of the figures a report's checks read, the newest rows are then found from the same columns, so that
        Spark moves the invoices once for both reports.
        """
        return ods.invoices(
            self.source("stg_invoices"), lambda stg, keys: latest_live(stg, keys, [*LOAD_ORDER, *INVOICE_FIGURES])
        )

    def _newest(self, name: str, lookups: Sequence[Lookup] = ()) -> Newest:
        staging, key, clean = CLEANED[name]
        below = [self.ods_accounts] if name == "ods_gl_postings" else []
        return Newest(lambda *how: clean(self.source(staging), *below, *how), key, lookups)

    def _joined_to(self, name: str) -> list[Lookup]:
        """What facts join a clean table to from the left, and the columns it meets by."""
        if name == "ods_invoices":
            return [(facts.counterparties(self.dim_client, self.dim_supplier), ["counterparty_type", "counterparty_id"])]
        if name in HEADERS:
            return [(self.dim_product, ["product_id"])]
        if name == "ods_purchase_orders":
            return [(self.dim_supplier, ["supplier_id"])]
        return [(self.dim_client, ["client_id"])] if name == "ods_sales_orders" else []

    def publish(self, path: str, tables: Sequence[str] = TABLES, incremental: bool = True) -> None:
        """Write tables below ``path`` in layer order and use the written ones from then on.

        Tables that an earlier call has published there and this one doesn't write are read from there too. With
        ``incremental`` facts are upserted, keyed tables merge what has arrived, and aggregates follow the months of
        the facts that have changed; the result is the same as of a full build, if nothing older than the lookback
        has changed. Read a published table with `finmarts.sources.versions.read`.
        """
        wanted = sorted(tables, key=TABLES.index)
        for name in TABLES:
            if name not in wanted and (state := versions.manifest(self.spark, os.path.join(path, name))):
                self._use(name, os.path.join(path, name), state)
        for name in wanted:
            target = os.path.join(path, name)
            old = versions.manifest(self.spark, target) if incremental else None
            self._use(name, target, self._write(name, path, target, old))

    def _write(self, name: str, path: str, target: str, old: versions.Manifest | None) -> versions.Manifest:
        loaded = F.unix_timestamp()
        if name in FACT_LAYOUT:
            key, date, sort = FACT_LAYOUT[name]
            if old is None:
                return write_table(self.table(name).withColumn("_loaded_at_ts", loaded), target, date, sort)
            return upsert_table(self._recent(name, target, old, date).withColumn("_loaded_at_ts", loaded), target, key, date, sort)
        if name in KEYED:
            self._merge_staging(name, path)
        if name in KEYED or name in KEYED_DIMS:
            return self._write_keyed(name, target, old)
        if name in HEADERS and HEADERS[name][0] in self._published:
            return self._write_lines(name, path, target, old)
        if name == "ods_gl_postings" and "ods_accounts" in self._published:
            return self._write_postings(name, target)
        below = {fact: self._states[fact].folders for fact in AGGREGATES.get(name, []) if fact in self._published}
        complete = bool(below) and set(below) == set(AGGREGATES[name])
        if complete and old is not None and set(old.sources) == set(below):
            return self._write_years(name, target, old, below)
        date, split, sort = LAYOUT.get(name, (None, MONTH, [self.table(name).columns[0]]))
        rows = self.table(name).withColumn("_loaded_at_ts", loaded)
        return write_table(rows, target, date, sort, split, below if complete else None)

    def _use(self, name: str, path: str, state: versions.Manifest) -> None:
        self._files[name] = versions.read(self.spark, path, state).drop("_loaded_at_ts")
        self._states[name] = state
        self.__dict__[name] = self._files[name].drop(MONTH, YEAR, BUCKET)
        self._published.add(name)

    def _with(self, **tables: DataFrame) -> Warehouse:
        """This warehouse with other rows in some tables; what it has made from them is made again."""
        other = copy.copy(self)
        for name in [n for n in other.__dict__ if n in TABLES and n not in self._published] + ["gl_monthly", "gl_daily", "_invoices"]:
            other.__dict__.pop(name, None)
        other.__dict__.update(tables)
        return other

    def _recent(self, name: str, target: str, old: versions.Manifest, date: str) -> DataFrame:
        """A fact to refresh ``target`` with; read from the recent months of its clean tables where those are published.

        Lines are pruned by the month of their header if they were laid out by the headers that are in force.
        """
        driver, lines, _ = DRIVERS[name]
        if driver not in self._published:
            return self.table(name)
        newest = newest_date(versions.read(self.spark, target, old), date)
        recent = {driver: recent_rows(self._files[driver], newest, date).drop(MONTH)}
        if lines in self._published and self._states[lines].sources.get(driver) == self._states[driver].folders:
            recent[lines] = recent_rows(self._files[lines], newest, None).drop(MONTH)
        other = self._with(**recent)
        other.__dict__.pop(name, None)
        return other.table(name)

    def _merge_staging(self, name: str, path: str) -> None:
        """Bring the store of newest staging rows up to date and clean its rows instead of the whole history."""
        staging, key, _ = KEYED[name]
        store = os.path.join(path, "stores", staging)
        arrived = unseen(self.source(staging), versions.manifest(self.spark, store))
        self._states[staging] = state = merge_arrivals(arrived, store, key)
        rows = versions.read(self.spark, store, state)
        self._files[staging] = rows
        clean, source = copy.copy(self), self.source
        clean.__dict__.pop(name, None)
        clean.source = lambda table: rows.drop(BUCKET) if table == staging else source(table)
        self.__dict__[name] = clean.table(name)

    def _write_keyed(self, name: str, target: str, old: versions.Manifest | None) -> versions.Manifest:
        """A table with one row per key, by bucket; only buckets that have changed below are written again.

        All are if the date that some columns depend on is another one.
        """
        below, key = (KEYED[name][0], KEYED[name][1]) if name in KEYED else KEYED_DIMS[name]
        if name in KEYED_DIMS and below not in self._published:
            rows = self.table(name).withColumn("_loaded_at_ts", F.unix_timestamp())
            return write_table(rows, target, None, [key])
        state = self._states[below]
        buckets = int(state.marks["buckets"])
        marks = {"buckets": str(buckets), "as_of": str(self.as_of)}
        sources = {below: state.folders}
        rows = self.table(name).withColumn("_loaded_at_ts", F.unix_timestamp())
        if old is None or old.by != BUCKET or dict(old.marks) != marks or set(old.sources) != {below}:
            return versions.replace(bucketed(rows, key, buckets), target, BUCKET, sources, marks)
        reached = versions.changed(old.sources[below], state.folders)
        if not reached:
            return old
        some = versions.at_partitions(self._files[below], BUCKET, reached).drop(BUCKET)
        if name in KEYED:
            other = copy.copy(self)
            other.__dict__.pop(name, None)
            other.source = lambda _: some
        else:
            other = self._with(**{below: some})
            other.__dict__.pop(name, None)
        rows = other.table(name).withColumn("_loaded_at_ts", F.unix_timestamp())
        return versions.replace_partitions(bucketed(rows, key, buckets), target, reached, old, sources, marks)

    def _write_lines(self, name: str, path: str, target: str, old: versions.Manifest | None) -> versions.Manifest:
        """Order lines, laid out by the month of their header.

        The state notes sums over ranges of the line key, taken before the rows are read. A refresh makes again what lies
        in ranges whose staging rows have changed and moves lines whose header has changed its month; where that is most
        of the table, or it can't be told, all lines are made again.
        """
        header, key, _ = HEADERS[name]
        staging, line_key, _ = CLEANED[name]
        stg = self.source(staging)
        before = noted(old.marks) if old is not None else None
        now = ranges_of(stg.where(F.col("_is_deleted") == 0), line_key, before)
        sources = {header: self._states[header].folders}
        if before is not None and before.width == now.width and set(old.sources) == {header}:
            state = self._refresh_lines(name, path, target, old, before, now)
            if state is not None:
                return state
        rows = self._with_months(name, self.table(name))
        return versions.replace(laid_out_by(rows, MONTH, LAYOUT[name][2]), target, MONTH, sources, now.marks())

    def _with_months(self, name: str, lines: DataFrame) -> DataFrame:
        """Lines with the month of their header, as they are written."""
        header, key, date = HEADERS[name]
        months = self.table(header).select(key, partition_of(MONTH, F.col(date)).alias(MONTH))
        rows = lines.withColumn("_loaded_at_ts", F.unix_timestamp()).join(months, key, "left")
        return rows.withColumn(MONTH, F.coalesce(MONTH, F.lit(UNDATED)))

    def _refresh_lines(
        self, name: str, path: str, target: str, old: versions.Manifest, before: Ranges, now: Ranges
    ) -> versions.Manifest | None:
        """The lines of `_write_lines` from those published before; None if they are to be made again whole."""
        header, key, _ = HEADERS[name]
        staging, line_key, clean = CLEANED[name]
        state, at = self._states[header], os.path.join(path, header)
        was = dict(old.sources[header])
        sources, marks = {header: state.folders}, now.marks()
        reached = now.changed(before)
        if 2 * len(reached) > len(before.sums):
            return None
        if {f.name: f.dataType for f in old.schema.fields if f.name != "_loaded_at_ts"} != {
            f.name: f.dataType for f in self.table(name).schema.fields
        }:
            return None
        if not set(was.values()) <= set(files.names(self.spark, at)):
            return None  # the headers they were laid out by are gone
        base = versions.read(self.spark, target, old)
        moved = self._moved_headers(name, at, was, state).persist()
        staged = f"{target}/_batch-{uuid.uuid4().hex}"
        try:
            with shuffles_released(self.spark):
                months = {m for pair in moved.select("_from", "_to").distinct().collect() for m in pair}
                if reached:
                    within = in_ranges(line_key, now.width, reached)
                    fresh = self._with_months(name, clean(self.source(staging).where(within)))
                    fresh.write.parquet(staged, compression=versions.CODEC)
                    fresh = self.spark.read.schema(fresh.schema).parquet(staged).select(*base.columns)
                    # bounded by the number of calendar months
                    months |= {r[MONTH] for r in base.where(within).select(MONTH).union(fresh.select(MONTH)).distinct().collect()}
            if not months:
                return old if was == dict(state.folders) and not reached else versions.commit(
                    self.spark, target, old.schema, MONTH, old.folders, old, sources, marks
                )
            rows = versions.at_partitions(base, MONTH, sorted(months))
            if reached:
                rows = rows.where(~within)
            rows = rows.join(moved.select(key, "_to"), key, "left").withColumn(MONTH, F.coalesce("_to", MONTH)).select(*base.columns)
            rows = rows.unionByName(fresh) if reached else rows
            return versions.replace_partitions(laid_out_by(rows, MONTH, LAYOUT[name][2]), target, months, old, sources, marks)
        finally:
            moved.unpersist()
            files.delete(self.spark, staged)

    def _moved_headers(self, name: str, at: str, was: dict[int, str], state: versions.Manifest) -> DataFrame:
        """Keys of headers that now lie in another month than in an earlier state, new ones and gone ones too.

        Lines without a header lie where those without a date do.
        """
        _, key, _ = HEADERS[name]
        months = versions.changed(was, state.folders)

        def of(folders: dict[int, str], month: str) -> DataFrame:
            some = versions.Manifest(state.number, state.schema, MONTH, {m: folders[m] for m in months if m in folders})
            return versions.read(self.spark, at, some).where(F.col(key).isNotNull()).select(key, F.col(MONTH).alias(month))

        both = of(was, "_from").join(of(dict(state.folders), "_to"), key, "full_outer")
        both = both.select(key, *[F.coalesce(c, F.lit(UNDATED)).alias(c) for c in ("_from", "_to")])
        return both.where(F.col("_from") != F.col("_to"))

    def _write_postings(self, name: str, target: str) -> versions.Manifest:
        """Ledger postings, laid out by month before they get the columns of their account.

        A published chart of accounts is as small as its files, so Spark sends it to the postings, which stay where
        they are. The shuffle by month then moves what was posted and not what is derived from it.
        """
        date, split, sort = LAYOUT[name]

        def by_month(stg: DataFrame, keys: Sequence[str]) -> DataFrame:
            newest = latest_live(stg, keys)
            return newest.withColumn(split, partition_of(split, day(date))).hint("rebalance", F.col(split))

        rows = ods.gl_postings(self.source("stg_gl_postings"), self.ods_accounts, by_month, [F.col(split)])
        rows = rows.withColumn("_loaded_at_ts", F.unix_timestamp())
        return versions.replace(rows.sortWithinPartitions(split, *sort), target, split)

    def _write_years(
        self, name: str, target: str, old: versions.Manifest, below: dict[str, dict[int, str]]
    ) -> versions.Manifest:
        """An aggregate, of which the years are made again that changed months of its facts reach."""
        months = sorted({m for fact, folders in below.items() for m in versions.changed(old.sources[fact], folders)})
        if not months:
            return old
        periodic = name.startswith("dm_")
        years = refresh.years_of_periods(months) if periodic else refresh.years_of(months)
        read = refresh.months_of_periods(years) if periodic else refresh.months_of(years)
        facts_ = {fact: refresh.between_months(self._files[fact], MONTH, read).drop(MONTH) for fact in below}
        other = self._with(**facts_)
        other.__dict__.pop(name, None)
        date, split, sort = LAYOUT[name]
        rows = other.table(name).where(partition_of(YEAR, F.col(date)).isin(years)).withColumn("_loaded_at_ts", F.unix_timestamp())
        state = versions.replace_partitions(arranged(rows, date, sort, split), target, years, old, below)
        other.release()
        return state

    @cached_property
    def _files(self) -> dict[str, DataFrame]:
        return {}

    @cached_property
    def _states(self) -> dict[str, versions.Manifest]:
        return {}

    @cached_property
    def _published(self) -> set[str]:
        return set()

    def _lookup(self, name: str) -> DataFrame:
        """A table as the unique side of a join; a written one needs no reshaping."""
        df = self.table(name)
        return df if name in self._published else lookup_side(df)

    # --- clean layer ---------------------------------------------------------------

    @cached_property
    def ods_company(self) -> DataFrame:
        return ods.company(self.source("stg_company"))

    @cached_property
    def ods_accounts(self) -> DataFrame:
        return ods.accounts(self.source("stg_accounts"))

    @cached_property
    def ods_clients(self) -> DataFrame:
        return ods.clients(self.source("stg_clients"), self.as_of)

    @cached_property
    def ods_managers(self) -> DataFrame:
        return ods.managers(self.source("stg_managers"), self.as_of)

    @cached_property
    def ods_products(self) -> DataFrame:
        return ods.products(self.source("stg_products"))

    @cached_property
    def ods_suppliers(self) -> DataFrame:
        return ods.suppliers(self.source("stg_suppliers"))

    @cached_property
    def ods_warehouses(self) -> DataFrame:
        return ods.warehouses(self.source("stg_warehouses"))

    @cached_property
    def ods_purchase_orders(self) -> DataFrame:
        return ods.purchase_orders(self.source("stg_purchase_orders"))

    @cached_property
    def ods_purchase_order_lines(self) -> DataFrame:
        return ods.purchase_order_lines(self.source("stg_purchase_order_lines"))

    @cached_property
    def ods_sales_orders(self) -> DataFrame:
        return ods.sales_orders(self.source("stg_sales_orders"))

    @cached_property
    def ods_sales_order_lines(self) -> DataFrame:
        return ods.sales_order_lines(self.source("stg_sales_order_lines"))

    @cached_property
    def ods_invoices(self) -> DataFrame:
        return ods.invoices(self.source("stg_invoices"))

    @cached_property
    def ods_inventory_movements(self) -> DataFrame:
        return ods.inventory_movements(self.source("stg_inventory_movements"))

    @cached_property
    def ods_marketing_spend(self) -> DataFrame:
        return ods.marketing_spend(self.source("stg_marketing_spend"))

    @cached_property
    def ods_gl_postings(self) -> DataFrame:
        return ods.gl_postings(self.source("stg_gl_postings"), self.ods_accounts)

    # --- dimensions ----------------------------------------------------------------

    @cached_property
    def dim_account(self) -> DataFrame:
        return dims.account(self.ods_accounts)

    @cached_property
    def dim_client(self) -> DataFrame:
        return dims.client(self.ods_clients)

    @cached_property
    def dim_company(self) -> DataFrame:
        return dims.company(self.ods_company)

    @cached_property
    def dim_manager(self) -> DataFrame:
        return dims.manager(self.ods_managers)

    @cached_property
    def dim_product(self) -> DataFrame:
        return dims.product(self.ods_products)

    @cached_property
    def dim_supplier(self) -> DataFrame:
        return dims.supplier(self.ods_suppliers)

    @cached_property
    def dim_warehouse(self) -> DataFrame:
        return dims.warehouse(self.ods_warehouses)

    @cached_property
    def dim_channel(self) -> DataFrame:
        return dims.channel(self.spark)

    @cached_property
    def dim_scenario(self) -> DataFrame:
        return dims.scenario(self.spark)

    @cached_property
    def dim_date(self) -> DataFrame:
        return dim_date(self.spark, self.calendar)

    # --- facts ---------------------------------------------------------------------

    @cached_property
    def fct_gl_entry(self) -> DataFrame:
        return facts.gl_entry(self.ods_gl_postings, self.calendar)

    @cached_property
    def fct_invoice(self) -> DataFrame:
        return facts.invoice(
            self.ods_invoices, self._lookup("dim_client"), self._lookup("dim_supplier"), self.calendar
        )

    @cached_property
    def fct_marketing_spend(self) -> DataFrame:
        return facts.marketing_spend(self.ods_marketing_spend, self.calendar)

    @cached_property
    def fct_purchase_order_line(self) -> DataFrame:
        return facts.purchase_order_line(
            self.ods_purchase_order_lines,
            self.ods_purchase_orders,
            self._lookup("dim_supplier"),
            self._lookup("dim_product"),
            self.calendar,
        )

    @cached_property
    def fct_sales_order_line(self) -> DataFrame:
        return facts.sales_order_line(
            self.ods_sales_order_lines,
            self.ods_sales_orders,
            self._lookup("dim_client"),
            self._lookup("dim_product"),
            self.calendar,
        )

    # --- monthly aggregates --------------------------------------------------------

    @cached_property
    def gl_daily(self) -> DataFrame:
        return monthly.gl_daily(self.fct_gl_entry).persist()

    @cached_property
    def gl_monthly(self) -> DataFrame:
        if "gl_daily" in self.__dict__:
            return monthly.gl_months_of_days(self.gl_daily)
        return monthly.gl_monthly(self.fct_gl_entry).persist()

    def release(self) -> None:
        """Give up the ledger aggregates that were used."""
        for name in ("gl_monthly", "gl_daily"):
            if name in self.__dict__:
                self.__dict__.pop(name).unpersist()

    @cached_property
    def int_pnl_monthly(self) -> DataFrame:
        return monthly.pnl(self.gl_monthly)

    @cached_property
    def int_balance_monthly(self) -> DataFrame:
        return monthly.balance(self.gl_monthly)

    @cached_property
    def int_sales_monthly(self) -> DataFrame:
        return monthly.sales(self.fct_sales_order_line)

    # --- marts ---------------------------------------------------------------------

    @cached_property
    def dm_pnl_periodic(self) -> DataFrame:
        return pnl.periodic(self.fct_gl_entry)

    @cached_property
    def dm_balance_monthly(self) -> DataFrame:
        return balance.monthly(self.int_balance_monthly)

    @cached_property
    def dm_cashflow_monthly(self) -> DataFrame:
        return cashflow.monthly(self.int_pnl_monthly, self.int_balance_monthly)

    @cached_property
    def dm_exec_kpi_monthly(self) -> DataFrame:
        months = pnl.monthly(self.int_pnl_monthly)
        return kpi.monthly(months, self.dm_balance_monthly, self.dm_cashflow_monthly)

    @cached_property
    def dm_sales_marketing_periodic(self) -> DataFrame:
        return sales.periodic(self.fct_sales_order_line, self.fct_marketing_spend, self.calendar)

    @cached_property
    def dm_working_capital_monthly(self) -> DataFrame:
        return receivables.working_capital_monthly(self.fct_invoice)

    @cached_property
    def dm_ar_ap_aging_snapshot(self) -> DataFrame:
        return receivables.aging_snapshot(self.fct_invoice, self.as_of)
