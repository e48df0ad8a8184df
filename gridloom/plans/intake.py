"""Cells of any number of files to facts, dimension and decision log."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.model import NULL_TOKENS, TargetSchema
from gridloom.operators import clean, enrich, growth, headers, integrity, metadata, structure, values
from gridloom.operators.kpi import file_outcome
from gridloom.operators.lookup import fits_broadcast, lookup_join
from gridloom.operators.ordered import WIDTH
from gridloom.operators.resolvers import Resolver
from gridloom.session import cut_lineage
from gridloom.sinks.dictionaries import DictionaryStore
from gridloom.sinks.report import RunRecorder
from gridloom.sinks.store import Store

SHEET, ROW, COLUMN = structure.SHEET, clean.ROW, clean.COLUMN
_HAS = "__has_"
_FOLDED = "__folded"


@dataclass(frozen=True)
class Options:
    """What a run may vary; the defaults follow the established behaviour."""

    schema: TargetSchema = field(default_factory=TargetSchema)
    header_resolver: Resolver | None = None
    value_resolver: Resolver | None = None
    header_policy: str = "rules_if_unresolved"
    value_mode: str = "exact"
    clean_order: str = "reference"
    skip_first: bool = True
    trim_bottom: bool = False
    min_header_cells: int = 3
    #: Texts that count as empty below the header; None takes every text as it is.
    na_tokens: tuple[str, ...] | None = NULL_TOKENS
    #: Of equally good sheets, ``(file_id, sheet_name)`` to take: called once with all of them.
    tie_choice: Callable[[DataFrame], DataFrame] | None = None
    #: The field that takes the columns outside the schema as ``header: value | header: value``.
    fold_into: str | None = None
    #: The field that takes the phase named by a row of its own above; None drops such rows.
    phase_into: str | None = None
    #: Refuse rows that lack a required field of the schema; the id field is numbered, never refused.
    refuse_incomplete: bool = False
    id_col: str = "id_inject"
    strict: bool = True
    width: int = WIDTH

    def __post_init__(self):
        for name in (self.fold_into, self.phase_into):
            if name is not None and name not in self.schema.fields:
                raise ValueError(f"{name} is no field of the schema")


class Intake(NamedTuple):
    rows: DataFrame  # enriched rows, one column per field
    rejected_rows: DataFrame
    files: DataFrame  # file_id of the files with a main sheet
    rejected_files: DataFrame
    dropped_columns: DataFrame
    log: DataFrame
    learned_headers: DataFrame
    learned_values: DataFrame


class Result(NamedTuple):
    facts: DataFrame
    outcome: DataFrame
    rejected: DataFrame


def find_ranges(cells: DataFrame, main: DataFrame, options: Options) -> DataFrame:
    """Header row, columns and last row of the table in each main sheet."""
    found = structure.header_row_by_fill(cells, options.min_header_cells)
    if options.trim_bottom:
        found = found.join(main.select(*SHEET), SHEET, "left_semi")
        return structure.last_data_row(cells, found, width=options.width)
    ends = main.select(*SHEET, F.col("max_row").alias("last_row"))
    return found.join(ends, SHEET)


def plan_intake(
    cells: DataFrame,
    sheets: DataFrame,
    submissions: DataFrame,
    header_dictionary: DataFrame,
    value_dictionary: DataFrame,
    options: Options = Options(),
    unique_values: bool = False,
) -> Intake:
    """The whole flow over all files.

    ``submissions`` holds one registered row per file; ``unique_values`` says that no key of the value dictionary
    repeats, as in a dictionary store. Tables that several later steps read are
    written once (ranges, filled grid, headers, wide rows); all but the grid and the rows are small.
    The grid is shuffled as cells, before it is filled, and from then on goes as whole rows: filled cells are
    copies, which lie side by side there. Header rows and phase rows go the same way, so the cells are moved for
    them no second time. The kept columns and their fields meet the grid in one join by sheet.
    """
    schema = options.schema
    stats = structure.sheet_stats(cells, sheets)
    main = cut_lineage(structure.main_sheet(stats), "main")
    if options.tie_choice is not None:
        tied = cut_lineage(structure.tied_sheets(stats, main), "tied")
        choice = cut_lineage(options.tie_choice(tied), "choice")
        main = cut_lineage(structure.apply_tie_choice(main, tied, choice), "main")
    main_cells = structure.near_main(cells, main)
    ranges = cut_lineage(find_ranges(main_cells, main, options), "ranges")
    phased = options.phase_into is not None
    # Phase rows are taken out before anything is filled: a filled phase row would look like data.
    grid = clean.grid_rows(main_cells, ranges, options.clean_order, phased, options.na_tokens, options.width)
    grid = cut_lineage(grid, "grid")
    filled = grid.where(F.col(clean.KIND) == clean.BODY).drop(clean.KIND)

    each = filled.select(*ROW, F.inline("cells"))
    kept = cut_lineage(clean.filled_columns(each, options.skip_first), "columns")
    found = clean.heads_of(grid).join(kept, COLUMN, "left_semi")
    named = headers.standardize_headers(
        cut_lineage(found, "headers"),
        header_dictionary,
        schema.fields,
        options.header_resolver,
        options.header_policy,
        options.strict,
    )
    # The columns, the log and the dropped ones read it.
    named = named._replace(headers=cut_lineage(named.headers, "named"))
    picked = headers.pick_columns(named.headers, schema.fields)
    log = headers.header_log(named.headers)
    flags = (_HAS, list(schema.allowed))
    exact = options.value_mode != "normalized"
    touched = values.touched_fields(value_dictionary, {} if exact else schema.allowed, schema.fields)
    spark = cells.sparkSession
    learned_values = spark.createDataFrame([], "field string, raw string, standard string")
    as_rows = exact and options.fold_into is None and (len(touched) <= 1 or fits_broadcast(value_dictionary))
    if as_rows:
        # Their cells are neither moved nor sorted to become a row again.
        wide = cut_lineage(clean.wide_rows(filled, picked, kept, schema.fields, flags, touched), "shown")
        wide = values.standardize_texts(wide, value_dictionary, touched, ROW, unique_values)
    else:
        columns = kept.join(picked, [*COLUMN], "left")
        folded = None
        if options.fold_into is not None:
            inside = F.coalesce(F.col("standard").isin(schema.fields), F.lit(False))
            label = F.nullif("raw_header", F.lit("")).alias("__label")
            columns = columns.join(named.headers.select(*COLUMN, label, (~inside).alias("__outside")), COLUMN, "left")
            folded = (_FOLDED, headers.folded_text(F.coalesce("__outside", F.lit(False)), F.col("__label")))
        # Written once: the dictionary's lookup reads it beside the rest.
        shown = cut_lineage(clean.with_columns(filled, columns, kept), "shown")
        long = shown.select(*ROW, F.inline("shown"))
        if exact:
            long = values.standardize_exact(long, value_dictionary, fields=touched)
        else:
            done = values.standardize_values(
                long,
                value_dictionary,
                schema.allowed,
                options.value_resolver,
                options.strict,
                fields=touched,
            )
            standard = F.coalesce(F.nullif("standard", F.lit("")), "value")
            long = done.values.withColumn("value", standard).select(*long.columns)
            log = log.unionByName(values.value_log(done.values))
            learned_values = growth.learned_values(done.learned)
        wide = headers.to_wide(long, ROW, schema.fields, flags, folded)
        if folded is not None:
            texts = F.concat_ws(" | ", options.fold_into, F.nullif(_FOLDED, F.lit("")))
            wide = wide.withColumn(options.fold_into, F.nullif(texts, F.lit(""))).drop(_FOLDED)
    if touched or not as_rows:
        wide = cut_lineage(wide, "rows")
    if phased:
        phases = clean.phases_of(grid)
        wide = cut_lineage(clean.under_phases(wide, phases, options.phase_into, options.width), "phased")
    kept_rows, rejected_rows = values.filter_allowed(wide, schema.allowed, _HAS)
    if options.refuse_incomplete:
        required = [f for f in schema.required if f != options.id_col]
        kept_rows, incomplete = integrity.split_required(kept_rows, required)
        rejected_rows = rejected_rows.unionByName(incomplete)
    told = [_HAS + f for f in schema.allowed]
    return Intake(
        rows=enrich.enrich(
            kept_rows.drop(*told), submissions, options.id_col, width=options.width
        ),
        rejected_rows=rejected_rows.drop(*told),
        files=main.select("file_id").distinct(),
        rejected_files=structure.without_header(main, ranges),
        dropped_columns=headers.dropped_columns(named.headers, schema.fields),
        log=lookup_join(
            log, submissions.select("file_id", "id_chronogramme"), ["file_id"], ["position"], "inner"
        ),
        learned_headers=growth.learned_headers(named.learned),
        learned_values=learned_values,
    )


def register(submissions: DataFrame, start: int) -> metadata.Checked:
    """Defaults, required fields, cleaned texts and an id for each accepted submission."""
    checked = metadata.check_required(metadata.with_defaults(submissions))
    return metadata.Checked(
        metadata.assign_ids(metadata.clean_metadata(checked.valid), start), checked.rejected
    )


def register_in(store: Store, submissions: DataFrame, batch_id: str) -> metadata.Checked:
    """The same with ids of the store's ledger: a file keeps its id however often its batch is run."""
    checked = metadata.check_required(metadata.with_defaults(submissions))
    cleaned = metadata.clean_metadata(checked.valid)
    known = store.ledger.with_ids(cleaned, batch_id, store.max_id(but=batch_id))
    return metadata.Checked(known, checked.rejected)


def complete(
    submissions: DataFrame, sheets: DataFrame, unreadable: DataFrame | None = None
) -> DataFrame:
    """The submissions, and one without any field for each file that was read, or could not be, and has
    none. Its id is taken for its path, which is what the reader gives."""
    seen = sheets.select("file_id")
    if unreadable is not None:
        seen = seen.unionByName(unreadable.select("file_id"))
    new = seen.distinct().join(submissions.select("file_id"), "file_id", "left_anti")
    return submissions.unionByName(
        new.withColumn("file_path", F.col("file_id")), allowMissingColumns=True
    )


def run_intake(
    spark: SparkSession,
    store: Store,
    header_store: DictionaryStore,
    value_store: DictionaryStore,
    cells: DataFrame,
    sheets: DataFrame,
    submissions: DataFrame,
    batch_id: str,
    options: Options = Options(),
    unreadable: DataFrame | None = None,
) -> Result:
    """Plan, check and append one batch of files.

    ``unreadable(file_id, reason)`` lists the files that the reader refused; files without a submission
    get the defaults of one. Every file is in ``outcome``, and each that is not stored in ``rejected``
    with its reasons.

    Rows and ids are written out once before the checks, so the checks and the appends see the same
    rows. The batch shows once facts, log, dimension and learnt entries are all written; run again it
    replaces itself under the same ids. A run that fails leaves its log as well.
    """
    recorder = RunRecorder(batch_id)
    stored = None
    try:
        with recorder.step("INSERT_METADATA"):
            files = cut_lineage(complete(submissions, sheets, unreadable), "submissions")
            registered = register_in(store, files, batch_id)
            known = cut_lineage(registered.valid)
        with recorder.step("STANDARDIZE") as metrics:
            hidden = store.open_batches()
            for entries in (header_store, value_store):
                entries.settle([*hidden, batch_id])
            intake = plan_intake(
                cells, sheets, known, header_store.read(), value_store.read(), options, unique_values=True
            )
            rows = cut_lineage(recorder.observe(intake.rows, "rows"))
            metrics["rows"] = recorder.rows("rows")
        with recorder.step("INSERT_INJECTS"):
            earlier = store.facts_like(rows, but=batch_id)
            gate = integrity.atomic_gate(rows, known, earlier, unit="file_id")
            refused = cut_lineage(_refused(gate, intake, registered, known, unreadable))
            counts = rows.groupBy("id_chronogramme").agg(F.count("*").alias("nb_new"))
            passed = known.join(refused.select("file_id"), "file_id", "left_anti")
            passed = cut_lineage(passed.drop("nb_injects"), "passed")
            dimension = passed.join(counts, "id_chronogramme", "left").withColumn(
                "nb_injects", F.coalesce("nb_new", F.lit(0))
            )
            store.begin(batch_id)
            store.append_facts(gate.accepted, batch_id)
            store.append_log(intake.log, batch_id)
            header_store.stage(intake.learned_headers, batch_id)
            value_store.stage(intake.learned_values, batch_id)
            store.append_dimension(dimension, batch_id)
            store.finish(batch_id)
            for entries in (header_store, value_store):
                entries.settle(store.open_batches())
            stored = passed
    finally:
        recorder.write(spark, f"{store.base}/run_logs", stored)
    named = files.select("file_id", metadata.file_name(F.col("file_path")).alias("file_name"))
    return Result(gate.accepted, file_outcome(named, passed, refused), refused)


def _refused(
    gate: integrity.Gate,
    intake: Intake,
    registered: metadata.Checked,
    known: DataFrame,
    unreadable: DataFrame | None,
) -> DataFrame:
    """``(file_id, reason)`` of all files that are not stored."""
    refused = (
        gate.rejected.select("file_id", "reason")
        .unionByName(intake.rejected_files.select("file_id", "reason"))
        .unionByName(registered.rejected.select("file_id", "reason"))
    )
    empty = known.select("file_id").join(intake.files, "file_id", "left_anti")
    if unreadable is not None:
        refused = refused.unionByName(unreadable.select("file_id", "reason"))
        empty = empty.join(unreadable.select("file_id"), "file_id", "left_anti")
    return refused.unionByName(empty.withColumn("reason", F.lit("no sheet")))
