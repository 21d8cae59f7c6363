"""The columns that a Spark SQL expression reads, from Spark's own parser."""

from __future__ import annotations

import dataclasses
from collections.abc import Iterable, Iterator

from pyspark.errors import ParseException
from pyspark.sql import SparkSession

from mapweave.plans.rules import Rule


def _items(seq) -> list:
    return [seq.apply(i) for i in range(seq.length())]


def _names(node, bound: frozenset[str]) -> Iterator[list[str]]:
    """Name parts of the attributes below a parsed node; ``bound`` are variables of lambdas around it."""
    kind = node.getClass().getSimpleName()
    if kind in ("UnresolvedAttribute", "UnresolvedNamedLambdaVariable"):
        # In the body of a lambda the parser takes every name for a variable.
        parts = _items(node.nameParts())
        if kind == "UnresolvedAttribute" or parts[0].lower() not in bound:
            yield parts
    elif kind == "LambdaFunction":
        own = {_items(a.nameParts())[0].lower() for a in _items(node.arguments())}
        yield from _names(node.function(), bound | own)
    elif "Star" in kind or "Subquery" in kind or kind == "Exists":
        raise ValueError("an expression names its columns, without * or subqueries")
    else:
        for child in _items(node.children()):
            yield from _names(child, bound)


def expression_columns(spark: SparkSession, text: str, columns: Iterable[str] = ()) -> list[str]:
    """The columns ``text`` reads, in order, repeats kept.

    Names are matched to ``columns`` as the session does, with or without regard to case. A
    field of a struct counts as its column; a name that is no column stays as it is.
    """
    try:
        parsed = spark._jsparkSession.sessionState().sqlParser().parseExpression(text)
    except ParseException as error:
        raise ValueError(f"no expression: {text}") from error
    known = {c: c for c in columns}
    if spark.conf.get("spark.sql.caseSensitive") != "true":
        known = {c.lower(): c for c in columns} | known
    return [known.get(p[0], known.get(p[0].lower(), p[0])) for p in _names(parsed, frozenset())]


def with_sources(spark: SparkSession, rules: Iterable[Rule], columns: Iterable[str]) -> list[Rule]:
    """The rules, those of kind expr with the columns they read where none are stated."""
    columns = list(columns)
    out = []
    for rule in rules:
        if rule.kind == "expr" and not rule.reads and len(rule.args) == 1:
            try:
                reads = expression_columns(spark, rule.args[0], columns)
            except ValueError as error:
                raise ValueError(f"rule for {rule.table}.{rule.column}: {error}") from error
            rule = dataclasses.replace(rule, reads=tuple(reads))
        out.append(rule)
    return out
