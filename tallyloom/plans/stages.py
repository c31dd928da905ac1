"""The stages of an onboarding run over stored state: catalog, profile, then the merges.

Every stage reads the last snapshots, computes its actions once, and writes new snapshots;
running it again with the same input changes nothing.
"""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom import fixed_values as fixed, schemas
from tallyloom.functions.specs import parse_board_spec, parse_glue_spec, unpivot_properties
from tallyloom.operators import catalog, checks, extract, merge, profile, quarantine, sheets, tracking
from tallyloom.operators.scale import keep_keys, lookup
from tallyloom.schemas import SHEET_KEYS
from tallyloom.session import stage_table
from tallyloom.sources.files import source_status
from tallyloom.sources.grid import first_sheet, named_sheet
from tallyloom.sources.registry import sources_of
from tallyloom.sources.store import Store, transactional

CATALOG_STAGE, PROFILE_STAGE = "catalog", "profile"
ITEM_ACTIONS = ["insert", "repair", "skip", "fail"]
PROPERTY_ACTIONS = ["insert", "skip", "blocked", "fail"]
FIELD_ACTIONS = ["insert", "skip", "conflict", "fail"]
THRESHOLD_ACTIONS = ["update", "skip", "blocked"]
HEADER_PARENT = "header"
# Stands for a source in counters that all supplier books share.
ALL_BOOKS = "*"

TABLES = {
    "inventory_item": schemas.ITEMS,
    "item_property": schemas.PROPERTIES,
    "batch_field": schemas.FIELDS,
    "quarantine": schemas.QUARANTINE,
    "tracker": schemas.TRACKER,
}
# Changes of a table replace rows by these.
KEYS = {
    "inventory_item": ["item_id"],
    "item_property": ["item_id", "property_name"],
    "batch_field": ["item_id", "field_key"],
    "quarantine": quarantine.KEY,
    "tracker": ["stage", "file_key"],
}
BY_SOURCE = ["source_id"]


@dataclass(frozen=True)
class LedgerKind:
    """What distinguishes one kind of ledger from another."""

    seed_type: str
    item_stage: str
    spec_stage: str
    select_sheets: Callable[[DataFrame], DataFrame]
    parent_key: Callable[[], Column]
    name: Callable[[Column], Column]
    parse: Callable[[Column], Column]
    properties: tuple[str, ...]
    base_uom: str | None
    check_variants: bool
    no_item_header: str
    no_items: str
    no_spec_header: str
    no_name: str
    no_specs: str
    blocked: str
    parse_error: str


BOARDS = LedgerKind(
    seed_type=fixed.BOARD_SEED,
    item_stage=fixed.STAGE_ITEMS,
    spec_stage=fixed.STAGE_SPECS,
    select_sheets=extract.valid_tabs,
    # Any number of board books may be registered, so a tab is named with its book.
    parent_key=lambda: F.concat_ws("/", "source_id", "sheet"),
    name=extract.board_name,
    parse=parse_board_spec,
    properties=fixed.BOARD_PROPERTIES,
    base_uom=fixed.BOARD_UOM,
    check_variants=True,
    no_item_header=fixed.MSG_NO_ITEM_HEADER,
    no_items=fixed.MSG_NO_ITEMS,
    no_spec_header=fixed.MSG_NO_SPEC_HEADER,
    no_name=fixed.MSG_NO_NAME,
    no_specs=fixed.MSG_NO_SPECS,
    blocked=fixed.MSG_BLOCKED,
    parse_error=fixed.MSG_CANONICAL,
)
GLUE = LedgerKind(
    seed_type=fixed.GLUE_SEED,
    item_stage=fixed.STAGE_GLUE_ITEMS,
    spec_stage=fixed.STAGE_GLUE_SPECS,
    select_sheets=first_sheet,
    parent_key=lambda: F.col("source_id"),
    name=extract.glue_name,
    parse=parse_glue_spec,
    properties=fixed.GLUE_PROPERTIES,
    base_uom=None,
    check_variants=False,
    no_item_header=fixed.MSG_NO_GLUE_HEADER,
    no_items=fixed.MSG_NO_GLUE_NAME,
    no_spec_header=fixed.MSG_NO_GLUE_HEADER,
    no_name=fixed.MSG_NO_GLUE_NAME,
    no_specs=fixed.MSG_NO_GLUE_SPECS,
    blocked=fixed.MSG_GLUE_BLOCKED,
    parse_error="%s",
)


class Onboarding:
    """One run: registry, grid and stored state at one point in time.

    ``sheet_list(source_id, sheet, sheet_idx)`` names the sheets of all books, also those
    without any row, which the grid cannot show.
    The grid holds registered sources only. One run at a time may write to a store.

    What a stage writes becomes visible when it ends, all of it or, if it is killed, none;
    only the per-source copies are written as they come. A stage that is run again with the
    same ``run_id`` adds nothing to the logs a second time.
    """

    def __init__(
        self,
        store: Store,
        registry: DataFrame,
        grid: DataFrame,
        listing: DataFrame,
        run_ts: Column,
        folder_key: str = "",
        read_errors: DataFrame | None = None,
        sheet_list: DataFrame | None = None,
        run_id: str | None = None,
    ):
        self.store = store
        self.registry = registry
        self.grid = grid
        # Staged: hashing reads all content, and every stage needs the result.
        self.statuses = stage_table(source_status(registry, listing, folder_key, read_errors), "statuses")
        self.sheet_list = sheet_list
        self.ts = run_ts
        self.run_id = run_id
        with store.transaction():
            for name, ddl in TABLES.items():
                store.ensure(name, ddl)

    def table(self, name: str) -> DataFrame:
        return self.store.read(name, TABLES[name])

    def _change(self, name: str, rows: DataFrame, removed: DataFrame | None = None) -> None:
        self.store.change(name, TABLES[name], KEYS[name], rows, removed)

    def _track(self, script: str, files: DataFrame, mark: Callable[[DataFrame], DataFrame]) -> None:
        """The tracker's rows of ``files`` after ``mark``; the others are not read again."""
        tracker = tracking.of_stage(self.table("tracker"), script)
        self._change("tracker", mark(tracker.join(files.select("file_key"), "file_key", "left_semi").select(*tracker.columns)))

    def _log(self, name: str, rows: DataFrame, fmt: str, script: str) -> None:
        self.store.append(name, rows, fmt, f"{self.run_id}-{script}" if self.run_id else None)

    # --- catalog and profile ---------------------------------------------------------

    def _work(self, stage: str, prior: DataFrame, force: bool) -> tuple[DataFrame, DataFrame]:
        """Sources to process now with their status, and the source ids kept from before."""
        tracker = tracking.of_stage(self.table("tracker"), stage)
        files = self.statuses.withColumnRenamed("status", "file_status")
        flagged = tracking.with_state(files, tracker, force)
        now, kept = tracking.carry_forward(flagged, prior.select("source_id").distinct())
        return stage_table(now, f"{stage}-work"), stage_table(kept, f"{stage}-kept")

    def _rows_of(self, work: DataFrame, kept: DataFrame) -> DataFrame:
        """Grid rows to process; a run over everything takes the grid as it is, without a join."""
        if kept.isEmpty() and work.filter(F.col("file_status") != "ok").isEmpty():
            return self.grid
        readable = work.filter(F.col("file_status") == "ok").select("source_id")
        return keep_keys(self.grid, stage_table(readable, "readable"), ["source_id"], ["row_num"])

    def _listed(self, work: DataFrame) -> DataFrame | None:
        """Listed sheets of the readable sources of this run."""
        if self.sheet_list is None:
            return None
        readable = work.filter(F.col("file_status") == "ok").select("source_id")
        return self.sheet_list.select(*SHEET_KEYS).join(readable, "source_id", "left_semi")

    def _replace(self, name: str, ddl: str, fresh: DataFrame, kept: DataFrame) -> None:
        """Results of this run take the place of their sources'; those of sources that are gone go."""
        prior = self.store.read(name, ddl).select("source_id").distinct()
        gone = prior.join(kept.select("source_id"), "source_id", "left_anti")
        self.store.change(name, ddl, BY_SOURCE, fresh.select(*schemas.column_names(ddl)), gone)

    def _mark_processed(self, stage: str, work: DataFrame, keep_loaded: bool) -> None:
        done = work.filter(F.col("file_status") == "ok")
        self._track(stage, done, lambda tracker: tracking.mark_processed(tracker, stage, done, self.ts, keep_loaded))

    def _outcomes(self, work: DataFrame, kept: DataFrame) -> DataFrame:
        ok = F.col("file_status") == "ok"
        processed = work.select("source_id", F.when(ok, "processed").otherwise(F.col("file_status")).alias("outcome"))
        return catalog.outcome_counts(
            processed.unionByName(kept.select("source_id", F.lit("skipped").alias("outcome")))
        )

    @transactional
    def catalog(self, force: bool = False) -> DataFrame:
        """Catalog new and changed sources; unchanged ones keep their entries."""
        prior = self.store.read("source_catalog", schemas.SOURCE_CATALOG)
        work, kept = self._work(CATALOG_STAGE, prior, force)
        fresh = catalog.sheet_catalog(self._rows_of(work, kept))
        listed = self._listed(work)
        fresh = stage_table(fresh if listed is None else catalog.with_blank_sheets(fresh, listed), "sheet-catalog")
        statuses = work.drop("status").withColumnRenamed("file_status", "status")
        self._replace("sheet_catalog", schemas.SHEET_CATALOG, fresh, kept)
        self._replace(
            "source_catalog", schemas.SOURCE_CATALOG, catalog.source_catalog(statuses, fresh), kept
        )
        self.store.write_per_source("processed_catalog", fresh, work)
        self._mark_processed(CATALOG_STAGE, work, keep_loaded=False)
        return self._outcomes(work, kept)

    @transactional
    def profile(self, force: bool = False) -> DataFrame:
        """Profile new and changed sources; a source already loaded keeps that status."""
        prior = self.store.read("source_report", schemas.SOURCE_REPORT)
        work, kept = self._work(PROFILE_STAGE, prior, force)
        rows, listed = self._rows_of(work, kept), self._listed(work)
        if listed is not None:
            listed = listed.unionByName(rows.select(*SHEET_KEYS)).distinct()
        fresh = profile.Profile(rows, sheets=listed)
        reports = stage_table(fresh.sheets, "sheet-report")
        statuses = work.drop("status").withColumnRenamed("file_status", "status")
        self._replace("source_report", schemas.SOURCE_REPORT, profile.profiled_sources(statuses, reports), kept)
        self._replace("sheet_report", schemas.SHEET_REPORT, reports, kept)
        self._replace("column_report", schemas.COLUMN_REPORT, fresh.columns, kept)
        self._replace("issues", schemas.ISSUES, fresh.issues, kept)
        self.store.write_per_source("processed_profile", reports, work)
        self._mark_processed(PROFILE_STAGE, work, keep_loaded=True)
        return self._outcomes(work, kept)

    # --- ledgers: items and their properties -----------------------------------------

    def _pending(self, script: str) -> DataFrame:
        return quarantine.failures_of(self.table("quarantine"), script).filter(
            F.col("parent_key") != HEADER_PARENT
        )

    def _ledger(self, kind: LedgerKind) -> DataFrame:
        """Grid rows of the kind's sheets, with their key."""
        books = sources_of(self.registry, kind.seed_type).select("source_id")
        rows = keep_keys(self.grid, books, ["source_id"], ["row_num"])
        return kind.select_sheets(rows).withColumn("parent_key", kind.parent_key())

    def _chosen(self, kind: LedgerKind, pending: DataFrame, mode: str) -> tuple[DataFrame, DataFrame]:
        """Rows to work on, and in retry mode the keys passed over."""
        rows = self._ledger(kind)
        keys = rows.select("source_id", "parent_key").distinct()
        if mode == "full":
            return rows, keys.limit(0)
        chosen = keep_keys(rows, pending.select("parent_key").distinct(), ["parent_key"], ["row_num"])
        _, passed = quarantine.retry_parents(keys, pending, ["source_id"])
        return chosen, passed

    def _summary(self, kind: LedgerKind, tabs: extract.LedgerTabs) -> DataFrame:
        """Per sheet: extracted values with key, position in the run, and unit."""
        books = sources_of(self.registry, kind.seed_type).select("source_id", "source_no", "base_uom")
        uom = F.lit(kind.base_uom) if kind.base_uom else F.col("base_uom")
        return (
            lookup(tabs.summary(kind.name).drop("error"), books, ["source_id"], ["sheet"])
            .withColumn("seq", merge.input_seq(F.col("source_no"), F.col("sheet_idx")))
            .withColumn("base_uom", uom)
            .withColumn("parent_key", kind.parent_key())
        )

    def _settle(self, script: str, parents: DataFrame, failures: DataFrame) -> None:
        self._change("quarantine", *quarantine.parent_changes(self.table("quarantine"), script, parents, failures, self.ts))

    def _finish(
        self, script: str, counts: DataFrame, mode: str, must_be_zero: list[str], keys: DataFrame | None = None
    ) -> DataFrame:
        """``loaded`` status for each source in which nothing failed or is pending, manifest for a clean run.

        ``keys(source_id, parent_key)`` tells whose source a pending key is. A pending key of
        none of them, such as a field of an item, holds back all sources. The manifest of a
        run is written only if no source failed and the stage has nothing in quarantine.
        """
        counts = stage_table(counts, "counts")
        pending = quarantine.failures_of(self.table("quarantine"), script).select("parent_key").distinct()
        rows = quarantine.manifest_rows(counts, script, mode, self.ts, must_be_zero)
        blocked = not pending.isEmpty()
        if keys is not None and pending.join(keys, "parent_key", "left_anti").isEmpty():
            held = stage_table(keys.join(pending, "parent_key", "left_semi").select("source_id").distinct(), "held")
            rows = rows.join(held, "source_id", "left_anti")
        elif blocked:
            rows = rows.limit(0)
        rows = stage_table(rows, "manifest")
        if not blocked and rows.count() == counts.count():
            self._log("load_manifest", rows, "parquet", script)
        files = rows.select("source_id").join(self.statuses.select("source_id", "file_key"), "source_id")
        self._track(script, files, lambda tracker: tracking.mark_loaded(tracker, script, files, self.ts))
        return counts

    @transactional
    def items(self, kind: LedgerKind, retry: bool = False) -> DataFrame | None:
        """One item per sheet of a ledger; None if a retry was asked for and nothing is pending."""
        script = kind.item_stage
        pending = self._pending(script)
        mode = quarantine.run_mode(pending, retry)
        if mode == "noop":
            return None
        rows, passed = self._chosen(kind, pending, mode)
        tabs = extract.LedgerTabs(rows, sheets.ITEM_TOKENS, {"items": fixed.ITEMS_COL})
        summary = self._summary(kind, tabs)
        error = F.when(F.col("header_row").isNull(), kind.no_item_header).when(
            F.col("items").isNull(), kind.no_items
        )
        inputs = stage_table(
            summary.select(
                "source_id",
                "seq",
                "parent_key",
                "display_name",
                F.lit(fixed.CATEGORY).alias("category"),
                "base_uom",
                error.alias("error"),
            ),
            "item-inputs",
        )
        items = self.table("inventory_item")
        actions = stage_table(merge.item_actions(items, inputs), "item-actions")
        self._change("inventory_item", merge.changed_items(items, actions, self.ts))
        failures = actions.filter(F.col("action") == "fail").select(
            "parent_key",
            F.lit(quarantine.NO_CHILD).alias("child_key"),
            "reason",
            F.concat(F.lit("sheet="), F.col("parent_key")).alias("detail"),
            "seq",
        )
        self._settle(script, inputs.select("parent_key"), failures)
        by_source = actions.join(inputs.select("seq", "source_id"), "seq").select("source_id", "action")
        skipped = passed.select("source_id", F.lit("skip").alias("action"))
        counts = quarantine.action_counts(
            by_source.unionByName(skipped), ITEM_ACTIONS, ["source_id"]
        )
        keys = inputs.select("source_id", "parent_key").unionByName(passed.select("source_id", "parent_key"))
        return self._finish(script, counts, mode, ["fail"], keys)

    @transactional
    def specs(self, kind: LedgerKind, retry: bool = False) -> DataFrame | None:
        """Properties from the canonical specification of each sheet.

        A pending sheet is taken whole: what it already has is skipped, and entries for the
        sheet as such (no header, no parse) disappear once it works.
        """
        script = kind.spec_stage
        pending = self._pending(script)
        mode = quarantine.run_mode(pending, retry)
        if mode == "noop":
            return None
        rows, passed = self._chosen(kind, pending, mode)
        tabs = extract.LedgerTabs(rows, sheets.SPEC_TOKENS)
        items = self.table("inventory_item")
        known = items.select("display_name", F.lit(True).alias("found"))
        summary = lookup(self._summary(kind, tabs), known, ["display_name"], ["source_id", "sheet"])
        parsed = kind.parse(F.col("spec"))
        reason = (
            F.when(F.col("header_row").isNull(), kind.no_spec_header)
            .when(F.col("display_name").isNull(), kind.no_name)
            .when(F.col("found").isNull(), F.printf(F.lit(kind.blocked), F.col("display_name")))
            .when(F.col("spec").isNull(), kind.no_specs)
            .when(
                F.col("parsed.error").isNotNull(),
                F.printf(F.lit(kind.parse_error), F.col("parsed.error")),
            )
        )
        parse_failed = F.col("spec").isNotNull() & F.col("found") & F.col("parsed.error").isNotNull()
        work = stage_table(
            summary.withColumn("parsed", parsed)
            .withColumn("reason", reason)
            .withColumn("child_key", F.when(parse_failed, "parse").otherwise("all")),
            "spec-work",
        )
        good = work.filter(F.col("reason").isNull())
        inputs = stage_table(
            unpivot_properties(
                good, "parsed", kind.properties, ["source_id", "seq", "parent_key", "display_name"]
            ),
            "property-inputs",
        )
        existing = self.table("item_property")
        actions = stage_table(merge.property_actions(items, existing, inputs), "property-actions")
        self._change("item_property", merge.added_properties(actions, self.ts))

        where = F.concat(F.lit("sheet="), F.col("parent_key"))
        failures = work.filter(F.col("reason").isNotNull()).select(
            "parent_key", "child_key", "reason", where.alias("detail"), "seq"
        )
        failures = failures.unionByName(
            actions.filter(F.col("action") == "fail").select(
                "parent_key", F.col("property_name").alias("child_key"), "reason", where.alias("detail"), "seq"
            )
        )
        if kind.check_variants:
            failures = failures.unionByName(self._variant_failures(kind, tabs, good))
        self._settle(script, work.select("parent_key"), failures)

        by_source = (
            actions.join(inputs.select("seq", "property_name", "source_id"), ["seq", "property_name"])
            .select("source_id", "action")
            .unionByName(
                work.filter(F.col("reason").isNotNull()).select(
                    "source_id",
                    F.when(F.col("found").isNull() & F.col("display_name").isNotNull(), "blocked")
                    .otherwise("fail")
                    .alias("action"),
                )
            )
            .unionByName(passed.select("source_id", F.lit("skip").alias("action")))
        )
        counts = quarantine.action_counts(by_source, PROPERTY_ACTIONS, ["source_id"])
        keys = work.select("source_id", "parent_key").unionByName(passed.select("source_id", "parent_key"))
        return self._finish(script, counts, mode, ["blocked", "fail"], keys)

    def _variant_failures(self, kind: LedgerKind, tabs: extract.LedgerTabs, good: DataFrame) -> DataFrame:
        bad = extract.bad_variants(extract.spec_variants(tabs.values), kind.parse)
        places = good.select(*SHEET_KEYS, "parent_key", "seq")
        return lookup(bad, places, SHEET_KEYS, ["spec"]).filter("seq is not null").select(
            "parent_key",
            F.concat(F.lit("variant_"), F.col("spec")).alias("child_key"),
            F.printf(F.lit(fixed.MSG_VARIANT), F.col("error")).alias("reason"),
            F.concat(F.lit("raw="), F.col("spec")).alias("detail"),
            "seq",
        )

    # --- supplier fields -------------------------------------------------------------

    @transactional
    def fields(
        self,
        sheet: str = fixed.SUPPLIER_SHEET,
        retry: bool = False,
        item_filter: Column | None = None,
        mapping: DataFrame | None = None,
    ) -> DataFrame | None:
        """Field definitions of the supplier sheet for every item (or those of a filter).

        ``mapping(field_name, field_key, field_type, is_required)`` takes the place of the
        usual one throughout: in what headers are expected, found, and defined.
        Headers are checked anew on every run and never start a retry by themselves.
        """
        script = fixed.STAGE_FIELDS
        pending = self._pending(script)
        mode = quarantine.run_mode(pending, retry)
        if mode == "noop":
            return None
        books = sources_of(self.registry, fixed.SUPPLIER_SEED).select("source_id")
        rows = named_sheet(keep_keys(self.grid, books, ["source_id"], ["row_num"]), sheet)
        headers = stage_table(extract.header_list(rows), "headers")
        present = headers.select(*SHEET_KEYS).distinct()
        here = F.lit(0).cast("bigint")
        if mapping is None:
            mapping = extract.field_mapping(self.grid.sparkSession)
        no_sheet = books.join(present, "source_id", "left_anti").select(
            "source_id",
            F.lit(HEADER_PARENT).alias("parent_key"),
            F.concat_ws("/", "source_id", F.lit(sheet)).alias("child_key"),
            F.printf(F.lit(fixed.MSG_SHEET_MISSING), F.lit(sheet)).alias("reason"),
            F.lit(fixed.MSG_NO_HEADERS).alias("detail"),
            here.alias("seq"),
        )
        no_header = extract.missing_headers(headers, present, mapping).select(
            "source_id",
            F.lit(HEADER_PARENT).alias("parent_key"),
            F.col("header").alias("child_key"),
            F.printf(F.lit(fixed.MSG_HEADER_MISSING), F.col("header"), F.lit(sheet)).alias("reason"),
            F.concat_ws("/", "source_id", "sheet").alias("detail"),
            here.alias("seq"),
        )
        found = extract.mapped_fields(headers, mapping)
        no_headers = stage_table(no_sheet.unionByName(no_header), "header-failures")
        items = self.table("inventory_item")
        if item_filter is not None:
            items = items.filter(item_filter)
        if mode == "retry":
            names = pending.select(F.col("parent_key").alias("display_name")).distinct()
            items = items.join(names, "display_name", "left_semi")
        existing = self.table("batch_field")
        actions = stage_table(merge.field_actions(items, found, existing), "field-actions")
        self._change("batch_field", merge.added_fields(actions, self.ts))
        conflict = F.printf(
            F.lit(fixed.MSG_CONFLICT),
            F.col("field_key"),
            F.col("display_name"),
            F.coalesce(F.col("existing_required").cast("string"), F.lit("None")),
            F.col("is_required").cast("string"),
        )
        failures = actions.filter(F.col("action").isin("conflict", "fail")).select(
            F.col("display_name").alias("parent_key"),
            F.col("field_key").alias("child_key"),
            F.coalesce("reason", conflict).alias("reason"),
            F.concat(F.lit("item_id="), F.col("item_id")).alias("detail"),
            here.alias("seq"),
        )
        parents = items.select(F.col("display_name").alias("parent_key")).unionByName(
            books.limit(1).select(F.lit(HEADER_PARENT).alias("parent_key"))
        )
        self._settle(script, parents, failures.unionByName(no_headers.drop("source_id")))
        totals = quarantine.action_counts(actions, FIELD_ACTIONS)
        # Fields belong to all books alike: their totals are a row of their own. Headers are of their book.
        own = books.join(
            no_headers.groupBy("source_id").agg(F.count(F.lit(1)).alias("headers")), "source_id", "left"
        ).select(
            "source_id", *[F.lit(0).cast("bigint").alias(n) for n in FIELD_ACTIONS if n != "fail"], F.coalesce("headers", F.lit(0)).alias("fail")
        )
        counts = own.unionByName(totals.select(F.lit(ALL_BOOKS).alias("source_id"), *FIELD_ACTIONS))
        held = no_headers.select("source_id", "parent_key")
        return self._finish(script, counts, mode, ["conflict", "fail"], held)

    # --- thresholds ------------------------------------------------------------------

    def _keep_errors(self, bad: DataFrame) -> str:
        self.store.write("config_errors", bad)
        return self.store.path("config_errors")

    def thresholds(self, config: DataFrame, retry: bool = False) -> DataFrame | None:
        """Thresholds from ``config(value)``; an invalid document stops before anything is written."""
        checked = checks.checked_thresholds(checks.threshold_entries(config))
        return self._thresholds(checks.require_valid(stage_table(checked, "checked"), self._keep_errors), retry)

    @transactional
    def _thresholds(self, wanted: DataFrame, retry: bool) -> DataFrame | None:
        script = fixed.STAGE_THRESHOLDS
        pending = self._pending(script)
        mode = quarantine.run_mode(pending, retry)
        if mode == "noop":
            return None
        passed = wanted.limit(0)
        if mode == "retry":
            named = wanted.withColumn("parent_key", F.col("display_name"))
            chosen, passed = quarantine.retry_parents(named, pending, ["threshold"])
            wanted = chosen.drop("parent_key")
        items = self.table("inventory_item")
        actions = stage_table(merge.threshold_actions(items, wanted), "threshold-actions")
        self._change("inventory_item", merge.changed_thresholds(items, actions, self.ts))
        self._log("audit", quarantine.audit_rows(actions, script, self.ts), "json", script)
        failures = actions.filter(F.col("action") == "blocked").select(
            F.col("display_name").alias("parent_key"),
            F.lit(quarantine.NO_CHILD).alias("child_key"),
            F.printf(F.lit(fixed.MSG_BLOCKED), F.col("display_name")).alias("reason"),
            F.concat(F.lit("display_name="), F.col("display_name")).alias("detail"),
            F.lit(0).cast("bigint").alias("seq"),
        )
        self._settle(script, actions.select(F.col("display_name").alias("parent_key")), failures)
        everything = actions.select("action").unionByName(passed.select(F.lit("skip").alias("action")))
        counts = quarantine.action_counts(everything, THRESHOLD_ACTIONS).select(
            F.lit("thresholds").alias("source_id"), *THRESHOLD_ACTIONS
        )
        return self._finish(script, counts, mode, ["blocked"])

    def run(self, thresholds: DataFrame, force: bool = False) -> None:
        """All stages in order."""
        self.catalog(force)
        self.profile(force)
        self.items(BOARDS)
        self.specs(BOARDS)
        self.fields()
        self.thresholds(thresholds)
        self.items(GLUE)
        self.specs(GLUE)
