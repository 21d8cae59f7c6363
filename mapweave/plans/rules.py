"""Mapping rules: one row says which expression feeds which target column.

Rules are configuration. They are read and routed as DataFrames, and only
their rows are ever collected to the driver.

An operand in ``args`` is a column name, a literal in double quotes, or another
rule node, ``{"kind": .., "args": [..]}``, of any kind but generate_id, expr and none.

====================  =====================================================
kind                  args
====================  =====================================================
field                 a column, or the shared prefix of a checkbox group
literal               a literal
first_nonblank        two or more operands; the first non-blank one wins
if_equal              a, b, then, else
first_name            an operand holding a person name
last_name             an operand holding a person name
generate_id           one or more operands; the target column holds the id
expr                  one Spark SQL expression; the job finds its columns
none                  nothing; the target column is known to be unavailable
====================  =====================================================

Nested nodes carry types, so text next to a number compares as it does in a rule
of its own. In ``expr`` all of Spark SQL is available, with its ANSI casts.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapweave import fixed_values as fixed
from mapweave.functions import expressions as ex
from mapweave.functions.casts import declared_type
from mapweave.operators.reshape import checkbox_groups, plain_columns
from mapweave.sources.local import local_frame

RULE_SCHEMA = (
    "ordinal int, table string, column string, kind string, sources array<string>, "
    "args array<string>, type string, primary boolean"
)

# Fewest and most args of each kind.
_ARITY = {
    "field": (1, 1),
    "literal": (1, 1),
    "first_nonblank": (2, None),
    "if_equal": (4, 4),
    "first_name": (1, 1),
    "last_name": (1, 1),
    "generate_id": (1, None),
    "expr": (1, 1),
    "none": (0, 0),
}
# Kinds whose value another rule may use.
VALUE_KINDS = ("field", "literal", "first_nonblank", "if_equal", "first_name", "last_name")


@dataclass(frozen=True)
class Rule:
    table: str | None
    column: str
    kind: str
    args: tuple[str, ...] = ()
    type: str | None = "text"
    primary: bool = False
    # Columns an expr reads, found by ``with_sources`` where not stated; worked out from args for
    # every other kind.
    reads: tuple[str, ...] = ()

    @property
    def sources(self) -> list[str]:
        """The columns the rule reads, in order, repeats kept."""
        if self.kind == "expr":
            return list(self.reads)
        if self.kind in ("none", "literal"):
            return []
        return [s for a in self.args for s in sources_of(a)]


def node(kind: str, *args: str) -> str:
    """A nested operand."""
    return json.dumps({"kind": kind, "args": args}, ensure_ascii=False)


def nested(operand: str) -> tuple[str, list[str]] | None:
    """Kind and args of an operand that is a node, else None."""
    if not operand.startswith("{"):
        return None
    try:
        parsed = json.loads(operand)
    except ValueError:
        return None
    if not isinstance(parsed, dict) or "kind" not in parsed:
        return None
    args = [a if isinstance(a, str) else json.dumps(a, ensure_ascii=False) for a in parsed.get("args") or ()]
    return parsed["kind"], args


def sources_of(operand: str) -> list[str]:
    """The columns an operand reads, in order, repeats kept."""
    inner = nested(operand)
    if inner is not None:
        return [s for a in inner[1] for s in sources_of(a)]
    return [] if is_literal(operand) else [operand]


def is_literal(operand: str) -> bool:
    return len(operand) >= 2 and operand[0] == operand[-1] == '"'


def operand(text: str, schema: T.StructType) -> tuple[Column, T.DataType]:
    """The value an operand stands for, and its type."""
    inner = nested(text)
    if inner is not None:
        return value(*inner, schema)
    if is_literal(text):
        return ex.literal(text[1:-1]), ex.STRING
    return ex.field(text), schema[text].dataType


def value(kind: str, args: Iterable[str], schema: T.StructType) -> tuple[Column, T.DataType]:
    """The value of a node and its type."""
    pairs = [operand(a, schema) for a in args]
    columns, types = [c for c, _ in pairs], [t for _, t in pairs]
    if kind in ("field", "literal"):
        return pairs[0]
    if kind == "first_nonblank":
        return ex.first_nonblank(columns, types), ex.common_type(types)
    if kind == "if_equal":
        same = ex.equals(*columns[:2], *types[:2])
        return ex.if_else(same, *columns[2:], *types[2:]), ex.common_type(types[2:])
    if kind == "first_name":
        return ex.first_name(columns[0]), ex.STRING
    if kind == "last_name":
        return ex.last_name(columns[0]), ex.STRING
    raise ValueError(f"unknown rule kind {kind!r}")


def rule_column(rule: Rule, schema: T.StructType) -> Column:
    """The Column that computes a rule over records of this schema."""
    if rule.kind == "none":
        raise ValueError(f"rule for {rule.table}.{rule.column} has no value to evaluate")
    if rule.kind == "generate_id":
        return ex.field(rule.column)
    if rule.kind == "expr":
        return F.expr(rule.args[0])
    return value(rule.kind, rule.args, schema)[0]


def project_rules(records: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Distinct rows of the rules' target columns."""
    return records.select(
        *[rule_column(r, records.schema).alias(r.column) for r in rules]
    ).distinct()


# --- rules as rows -----------------------------------------------------------


def selected(rules: DataFrame) -> DataFrame:
    """Rules marked for use, with only the columns that matter."""
    return rules.where(F.col("initialize") == "yes").select(
        "ordinal", "table", "column", "kind", "sources", "args", "type", "primary"
    )


def read_rules(spark: SparkSession, path: str) -> list[Rule]:
    """Read rule rows from a JSON array, in ordinal order.

    Only rows with ``initialize`` set to yes are used. ``primary`` is yes or true
    for key columns. ``sources`` states the columns of an expr that are not to be found in it.
    """
    schema = (
        "initialize string, ordinal int, table string, column string, kind string, "
        "sources array<string>, args array<string>, type string, primary string"
    )
    rows = selected(spark.read.json(path, schema=schema, multiLine=True, mode="FAILFAST"))
    return [
        Rule(
            table=r["table"],
            column=r["column"],
            kind=r["kind"],
            args=tuple(r["args"] or ()),
            type=r["type"],
            primary=r["primary"] in ("yes", "true"),
            reads=tuple(r["sources"] or ()),
        )
        for r in rows.orderBy("ordinal", "table", "column").collect()
    ]


def rules_frame(spark: SparkSession, rules: Iterable[Rule]) -> DataFrame:
    rows = [
        (i, r.table, r.column, r.kind, r.sources, list(r.args), r.type, r.primary)
        for i, r in enumerate(rules)
    ]
    return local_frame(spark, rows, T.StructType.fromDDL(RULE_SCHEMA))


def route(rules: DataFrame, names: Iterable[str]) -> DataFrame:
    """Rules with a target table that read at least one of the named columns."""
    wanted = F.array(*[F.lit(n) for n in names]).cast("array<string>")
    return rules.where(F.arrays_overlap("sources", wanted) & F.col("table").isNotNull())


def column_lists(rules: DataFrame, *columns: str) -> DataFrame:
    """The named rule columns per target table, as a list in ordinal order."""
    return rules.groupBy("table").agg(
        F.sort_array(F.collect_list(F.struct("ordinal", *columns))).alias("columns")
    )


def primary_keys(rules: DataFrame) -> DataFrame:
    """Key rules per target table."""
    return column_lists(rules.where(F.col("primary")), "sources", "column", "type")


def counted_above(df: DataFrame, keys: list[str], limit: int = 1) -> DataFrame:
    """Groups with more than ``limit`` rows, and their count."""
    return df.groupBy(*map(ex.field, keys)).agg(F.count(F.lit(1)).alias("count")).where(F.col("count") > limit)


def lineage(rules: DataFrame) -> DataFrame:
    """One row per column use of a rule, repeats kept."""
    return rules.select("ordinal", "table", "column", F.explode("sources").alias("source"))


def mapped_fields(rules: DataFrame) -> DataFrame:
    """Columns used by the distinct expressions, as a bag."""
    return (
        rules.select("kind", "args", "sources")
        .distinct()
        .select(F.explode("sources").alias("column"))
    )


# --- checks before any job ---------------------------------------------------


def declared_types(
    rules: Iterable[Rule],
    columns: Iterable[str],
    built_in: Iterable[tuple[str, str]] = fixed.BUILT_IN_TYPES,
) -> list[tuple[str, str]]:
    """Casts of record columns, in order: built-in ones, then those of bare field rules."""
    columns = set(columns)
    pairs = [(c, t) for c, t in built_in if c in columns]
    pairs += [
        (r.args[0], r.type) for r in rules if r.kind == "field" and r.args[0] in columns
    ]
    return list(dict.fromkeys(pairs))


def id_rules(rules: Iterable[Rule]) -> dict[str, tuple[str, ...]]:
    """Key parts by generated column; tables that share a rule share the ids."""
    ids: dict[str, tuple[str, ...]] = {}
    for rule in rules:
        if rule.kind == "generate_id" and ids.setdefault(rule.column, rule.args) != rule.args:
            raise ValueError(f"two different generate_id rules fill {rule.column}")
    return ids


def check_shapes(rules: Iterable[Rule]) -> None:
    """Kinds, arguments and stated sources of every rule."""
    for rule in rules:
        where = f"rule for {rule.table}.{rule.column}"
        _check_shape(where, rule.kind, rule.args)


def _check_shape(where: str, kind: str | None, args: Iterable[str]) -> None:
    if kind not in _ARITY:
        raise ValueError(f"{where}: unknown kind {kind!r}")
    args = list(args)
    fewest, most = _ARITY[kind]
    if len(args) < fewest or (most is not None and len(args) > most):
        raise ValueError(f"{where}: wrong number of args for {kind}: {len(args)}")
    if kind == "literal" and not is_literal(args[0]):
        raise ValueError(f"{where}: a literal is written in double quotes")
    if kind == "field" and (is_literal(args[0]) or nested(args[0])):
        raise ValueError(f"{where}: a field is a column name")
    for inner in filter(None, map(nested, args)):
        if inner[0] not in VALUE_KINDS:
            raise ValueError(f"{where}: {inner[0]} cannot be nested")
        _check_shape(where, *inner)


def check_rules(rules: list[Rule], columns: list[str]) -> None:
    """Everything that would make the job fail later, for records with these columns."""
    check_shapes(rules)
    for _, type_name in declared_types(rules, columns):
        declared_type(type_name)
    ids = id_rules(rules)
    clashes = sorted(set(ids) & set(columns))
    if clashes:
        raise ValueError(f"generated columns already exist in the records: {clashes}")
    for column, parts in ids.items():
        lacking = [s for p in parts for s in sources_of(p) if s not in columns]
        if lacking:
            raise ValueError(f"generate_id for {column} reads missing {lacking}")
    available = set(columns) | set(ids)
    groups = checkbox_groups(columns)
    plain = set(plain_columns(columns)) | set(ids)
    used = [r for r in rules if r.table is not None]

    for table in (fixed.REVIEWER_TABLE, fixed.LABEL_TABLE):
        if any(r.table == table for r in used):
            raise ValueError(f"table {table} is written by the job itself")

    copied: dict[str, list[Rule]] = {}
    for rule in used:
        if plain.intersection(rule.sources):
            copied.setdefault(rule.table, []).append(rule)
            lacking = sorted(set(rule.sources) - available)
            if lacking:
                raise ValueError(f"rule for {rule.table}.{rule.column} reads missing {lacking}")
    for table, table_rules in copied.items():
        repeated = [c for c, n in Counter(r.column for r in table_rules).items() if n > 1]
        if repeated:
            raise ValueError(f"table {table} gets several rules for {repeated}")

    ticked = list(dict.fromkeys(r for r in used if groups.keys() & set(r.sources)))
    crowded = [t for t, n in Counter(r.table for r in ticked).items() if n > 1]
    if crowded:
        raise ValueError(f"more than one checkbox rule for {crowded}")
    for rule in ticked:
        _check_checkbox(rule, rules, columns, copied)


def _check_checkbox(
    rule: Rule, rules: list[Rule], columns: list[str], copied: dict[str, list[Rule]]
) -> None:
    where = f"checkbox rule for {rule.table}.{rule.column}"
    if rule.kind != "field":
        raise ValueError(f"{where}: must be a plain field")
    if rule.type != "text":
        raise ValueError(f"{where}: values are column names, so the type must be text")
    if rule.table not in copied:
        raise ValueError(f"{where}: the table has no copied columns")
    keys = key_pairs(rule, rules)
    if not keys:
        raise ValueError(f"{where}: the table has no primary key")
    for source, target in keys:
        if source not in columns or target not in [r.column for r in copied[rule.table]]:
            raise ValueError(f"{where}: key {target} must be a copied record column")
    if rule.column in [r.column for r in copied[rule.table]]:
        raise ValueError(f"{where}: {rule.column} is filled by a copied column too")


def key_pairs(rule: Rule, rules: Iterable[Rule]) -> list[tuple[str, str]]:
    """Key columns of a checkbox rule's table as (record column, target column)."""
    pairs = []
    for key in rules:
        if key.table != rule.table or not key.primary or key.kind == "none":
            continue
        if key.args == rule.args and key.kind == "field":
            continue
        if key.kind != "field":
            raise ValueError(f"key {key.table}.{key.column} of a checkbox table must be a field")
        pairs.append((key.args[0], key.column))
    return pairs
