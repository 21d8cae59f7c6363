"""The job: records in, one table per target out.

``MappedRecords`` works on any records, rules and lists given as DataFrames. Given a
place to stage tables, it writes the filtered records, the id tables and the
records with their ids; without one it builds plans, and runs a job only where a join
has to count its keys. ``run_job`` reads the inputs from files, stages and writes
every output.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable
from dataclasses import dataclass, field, replace
from functools import cached_property

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapweave import fixed_values as fixed
from mapweave.functions import expressions as ex
from mapweave.functions.casts import cast_declared
from mapweave.operators import dictionary as dic
from mapweave.operators import filters, keys, lists, reports, reshape
from mapweave.operators.key_registry import KeyRegistry
from mapweave.plans import rules as rule_plans
from mapweave.plans.expression_columns import with_sources
from mapweave.plans.rules import Rule
from mapweave.sources import readers, writers
from mapweave.sources.local import local_frame
from mapweave.sources.publish import publication
from mapweave.sources.storage import Staging

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class FixedColumns:
    """Names the job gives a meaning of its own; the defaults are those of the export."""

    repeat_instrument: str = fixed.REPEAT_INSTRUMENT
    repeat_instance: str = fixed.REPEAT_INSTANCE
    trimmed: tuple[str, ...] = fixed.TRIMMED_COLUMNS
    title: str = fixed.TITLE_COLUMN
    first_name: str = fixed.FIRST_NAME_COLUMN
    last_name: str = fixed.LAST_NAME_COLUMN
    reviewer_prefix: str = fixed.REVIEWER_PREFIX
    # Options of ``dictionary.member_rows``, where they differ from its defaults.
    members: dict = field(default_factory=dict)
    # Record columns that the report of unknown columns leaves out.
    ignored: tuple[str, ...] = ()

    @property
    def built_in_types(self) -> tuple[tuple[str, str], ...]:
        return ((self.repeat_instrument, "text"), (self.repeat_instance, "int"))


@dataclass
class Inputs:
    """Records and what is applied to them."""

    records: DataFrame
    rules: list[Rule]
    enrich: list[DataFrame] = field(default_factory=list)
    restrict: list[DataFrame] = field(default_factory=list)
    block: list[DataFrame] = field(default_factory=list)
    dictionary: DataFrame | None = None
    # Off by default; the records need the title and name columns for it.
    drop_test_records: bool = False
    columns: FixedColumns = field(default_factory=FixedColumns)
    # Where tables are staged: write what each stage rejects next to the records, and count rows.
    keep_rejects: bool = True


def cast_records(
    records: DataFrame, rules: Iterable[Rule], built_in: tuple[tuple[str, str], ...] = fixed.BUILT_IN_TYPES
) -> DataFrame:
    """Give record columns their declared types, in one projection.

    A field declared with several types is cast to each in rule order.
    """
    casts = {}
    for name, type_name in rule_plans.declared_types(rules, records.columns, built_in):
        casts[name] = cast_declared(casts.get(name, ex.field(name)), type_name)
    return records.withColumns(casts) if casts else records


def filter_records(
    inputs: Inputs, staging: Staging | None = None, counts: dict[str, Observation] | None = None
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Typed and trimmed records through the filter chain, and rejects by stage.

    With staging the stages run once: kept and rejected records are parts of one written table.
    """
    cut = staging.cut if staging else None
    names = inputs.columns
    typed = cast_records(inputs.records, inputs.rules, names.built_in_types)
    stages = [
        ("primary", filters.primary_records(names.repeat_instrument, names.repeat_instance)),
        ("enrich", lists.enrich_all(inputs.enrich, cut)),
        ("restrict", lists.restrict_all(inputs.restrict, cut)),
        ("block", lists.block_all(inputs.block, cut)),
    ]
    if inputs.drop_test_records:
        test_records = filters.split_test_records(names.title, names.first_name, names.last_name)
        stages.append(("test", test_records))
    trimmed = filters.trim_columns(typed, names.trimmed)
    if staging is None:
        return filters.run_stages(trimmed, stages)
    if not inputs.keep_rejects:
        records, _ = filters.run_stages(trimmed, stages)
        return staging.table(records, "records"), {}
    return filters.run_stages(trimmed, stages, lambda df, by: staging.table(df, "records", by), counts)


def add_ids(
    records: DataFrame, rules: list[Rule], staging: Staging | None = None, registry: KeyRegistry | None = None
) -> DataFrame:
    """Attach the generated id columns; rules with the same parts share one key table.

    With a registry, which needs staging, keys of earlier runs keep their ids.
    """
    if registry is not None and staging is None:
        raise ValueError("a key registry needs a place to stage tables")
    columns_by_parts: dict[tuple[str, ...], list[str]] = {}
    for column, parts in rule_plans.id_rules(rules).items():
        columns_by_parts.setdefault(parts, []).append(column)
    schema: T.StructType = records.schema
    for i, (parts, columns) in enumerate(columns_by_parts.items()):
        values = [rule_plans.operand(p, schema)[0] for p in parts]
        tuples = keys.key_tuples(records, values)
        if staging is None:
            numbered = keys.number_keys(tuples, "id")
            records = keys.attach_keys(records, values, numbered, columns)
            continue
        tuples = staging.table(tuples.distinct(), f"keys_{i}")
        if registry is None:
            numbered = keys.number_keys(tuples, "id", keys.digits_for(tuples.count()))
        else:
            numbered = registry.numbered(parts, tuples)
        numbered = staging.table(numbered, f"ids_{i}")
        # Every later id and target table reads these, not the joins so far.
        records = staging.table(keys.attach_keys(records, values, numbered, columns), f"with_ids_{i}")
    return records


def routed_rules(spark: SparkSession, rules: list[Rule], names: list[str]) -> dict[str, list[Rule]]:
    """Rules that read one of the named columns, by target table, in rule order."""
    routed = rule_plans.route(rule_plans.rules_frame(spark, rules), names)
    by_table: dict[str, list[Rule]] = {}
    for ordinal in sorted(row["ordinal"] for row in routed.select("ordinal").collect()):
        by_table.setdefault(rules[ordinal].table, []).append(rules[ordinal])
    return by_table


def target_tables(records: DataFrame, rules: list[Rule]) -> dict[str, DataFrame]:
    """One DataFrame per target table: copied columns, plus ticks of checkbox groups."""
    spark = records.sparkSession
    groups = reshape.checkbox_groups(records.columns)
    copied = routed_rules(spark, rules, reshape.plain_columns(records.columns))
    tables = {t: rule_plans.project_rules(records, table_rules) for t, table_rules in copied.items()}
    if not groups:
        return tables
    for table, checkbox_rules in routed_rules(spark, rules, list(groups)).items():
        # Checked before: one checkbox rule per table.
        rule = checkbox_rules[0]
        pairs = rule_plans.key_pairs(rule, rules)
        ticks = reshape.unpivot_ticks(records, pairs, groups[rule.args[0]], rule.column)
        tables[table] = reshape.attach_copied(ticks, tables[table], [target for _, target in pairs])
    return tables


def column_reports(
    records: DataFrame, rules: list[Rule], ignored: Iterable[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Record columns no rule uses, and used columns the records lack, both as bags.

    Columns in ``ignored`` are never reported as unused.
    """
    spark = records.sparkSession
    groups = reshape.checkbox_groups(records.columns)
    names = reshape.plain_columns(records.columns) + list(groups)
    present = local_frame(spark, [(n,) for n in names], T.StructType().add("column", "string"))
    mapped = rule_plans.mapped_fields(rule_plans.rules_frame(spark, rules))
    unknown = reports.bag_difference(present, mapped).where(~F.col("column").isin(*ignored))
    return unknown, reports.bag_difference(mapped, present)


class MappedRecords:
    """Every output of the job, each built when it is first asked for."""

    def __init__(self, inputs: Inputs, staging: Staging | None = None, registry: KeyRegistry | None = None):
        added = [c for df in inputs.enrich + inputs.restrict for c in df.columns]
        columns = list(dict.fromkeys(inputs.records.columns + added))
        self._spark = inputs.records.sparkSession
        generated = list(rule_plans.id_rules(inputs.rules))
        inputs = replace(inputs, rules=with_sources(self._spark, inputs.rules, columns + generated))
        rule_plans.check_rules(inputs.rules, columns)
        self._inputs = inputs
        self._staging = staging
        self._registry = registry
        for rule in inputs.rules:
            if rule.table is None or not rule.sources:
                log.warning("rule for %s.%s (%s) reaches no table", rule.table, rule.column, rule.kind)
        self._counts: dict[str, Observation] = {}
        self.records, self.rejects = filter_records(inputs, staging, self._counts)

    @property
    def stage_rows(self) -> dict[str, int]:
        """The rows that each filter stage leaves, counted as they were staged with their rejects."""
        return {name: count.get["rows"] for name, count in self._counts.items()}

    @cached_property
    def records_with_ids(self) -> DataFrame:
        return add_ids(self.records, self._inputs.rules, self._staging, self._registry)

    @cached_property
    def mapped_tables(self) -> dict[str, DataFrame]:
        return target_tables(self.records_with_ids, self._inputs.rules)

    @cached_property
    def reviewers(self) -> DataFrame | None:
        return reshape.prefixed_to_long(
            self.records, self._inputs.columns.reviewer_prefix, "reviewer", "organization"
        )

    @cached_property
    def labels(self) -> DataFrame | None:
        if self._inputs.dictionary is None:
            return None
        rules = rule_plans.rules_frame(self._spark, self._inputs.rules)
        return dic.label_dimension(self._inputs.dictionary, rules, **self._inputs.columns.members)

    @cached_property
    def _reports(self) -> tuple[DataFrame, DataFrame]:
        return column_reports(self.records_with_ids, self._inputs.rules, self._inputs.columns.ignored)

    @property
    def unknown(self) -> DataFrame:
        return self._reports[0]

    @property
    def missing(self) -> DataFrame:
        return self._reports[1]

    def tables(self) -> dict[str, DataFrame]:
        """Target tables together with the reviewer table and the label dimension."""
        tables = dict(self.mapped_tables)
        if self.reviewers is not None:
            tables[fixed.REVIEWER_TABLE] = self.reviewers
        if self.labels is not None:
            tables[fixed.LABEL_TABLE] = self.labels
        return tables


def write_outputs(
    mapped: MappedRecords, directory: str, count_rows: bool = False, rejects: bool = False
) -> dict[str, int]:
    """Write tables and reports; with ``count_rows`` also return the rows of each table.

    ``rejects`` also writes what each stage rejected, under ``rejects/<stage>``.
    """
    writers.write_report(mapped.unknown, f"{directory}/unknown")
    writers.write_report(mapped.missing, f"{directory}/missing")
    for name, df in mapped.rejects.items() if rejects else ():
        writers.write_csv(df, f"{directory}/rejects/{name}")
    for name, rows in mapped.stage_rows.items() if count_rows else ():
        log.info("stage %s leaves %d rows", name, rows)
    if not count_rows:
        writers.write_tables(mapped.tables(), directory)
        return {}
    observed = {name: reports.counted(df, name) for name, df in mapped.tables().items()}
    writers.write_tables({name: df for name, (df, _) in observed.items()}, directory)
    counts = {name: observation.get["rows"] for name, (_, observation) in observed.items()}
    for name, rows in counts.items():
        log.info("table %s: %d rows", name, rows)
    return counts


@dataclass
class JobFiles:
    """Where the job reads and writes; an empty list directory means no such list."""

    records: str
    rules: str
    dictionary: str
    output: str
    enrich: str = ""
    restrict: str = ""
    block: str = ""
    json_lines: bool = False
    record_columns: list[str] | None = None
    drop_test_records: bool = False
    columns: FixedColumns = field(default_factory=FixedColumns)
    # Folder of the ids given so far; none numbers the keys of each run anew.
    key_registry: str = ""
    # Write the rejected records of each stage too.
    rejects: bool = False


def read_inputs(spark: SparkSession, files: JobFiles, staging: Staging | None = None) -> Inputs:
    def lists_in(directory: str) -> list[DataFrame]:
        return readers.read_lists(spark, directory, staging) if directory else []

    return Inputs(
        records=readers.read_json_strings(
            spark, files.records, files.record_columns, lines=files.json_lines, staging=staging
        ),
        rules=rule_plans.read_rules(spark, files.rules),
        enrich=lists_in(files.enrich),
        restrict=lists_in(files.restrict),
        block=lists_in(files.block),
        dictionary=readers.read_json_strings(spark, files.dictionary, staging=staging),
        drop_test_records=files.drop_test_records,
        columns=files.columns,
    )


def run_job(spark: SparkSession, files: JobFiles, count_rows: bool = False) -> dict[str, int]:
    """Read, map and write; staged tables are removed in the end.

    The outputs lie in the folder that ``published`` names for ``files.output``. They count all
    together, once all are written: a run that breaks leaves those of the run before.
    """
    staging = Staging(spark)
    registry = KeyRegistry(spark, files.key_registry) if files.key_registry else None
    try:
        with publication(spark, files.output) as folder:
            inputs = read_inputs(spark, files, staging)
            inputs.keep_rejects = files.rejects or count_rows
            mapped = MappedRecords(inputs, staging, registry)
            return write_outputs(mapped, folder, count_rows, files.rejects)
    finally:
        staging.remove()
