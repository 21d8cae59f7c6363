"""Joins that hold up when one key carries a large share of the rows.

A side that Catalyst will broadcast cannot overload a task, and such joins are left
alone. Otherwise the keys of both sides are counted, each once. Rows of heavy
keys are spread over numbered slices of their own side, and the matching rows
of the other side are repeated once per slice, so every row still meets exactly
its matches. The heavy keys stay a written table: there may be any number of them.
"""

from __future__ import annotations

from functools import reduce
from operator import and_
from uuid import uuid4

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapweave.sources.storage import Staging

# Rows of one key that go to one task.
ROWS_PER_SLICE = 1_000_000
# Tasks that look up the slices of one key, where heavy keys are too many to broadcast.
LOOKUP_SALTS = 64


def temp_name(label: str) -> str:
    """A column name no input will have."""
    return f"__{label}_{uuid4().hex[:12]}"


def will_broadcast(df: DataFrame) -> bool:
    """Whether Catalyst's size estimate is within the session's broadcast threshold."""
    try:
        limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
        return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) <= limit
    except AttributeError:
        return False


def heavy_keys(df: DataFrame, keys: list[str], slices: str) -> DataFrame | None:
    """All key tuples with more than ROWS_PER_SLICE rows and their number of slices.

    Runs a job: counts are pre-aggregated before the shuffle and the few heavy ones
    are written. None where there are none.
    """
    counts = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias(slices))
    heavy = counts.where(F.col(slices) > ROWS_PER_SLICE)
    stage = Staging(df.sparkSession)
    heavy = stage.table(heavy.withColumn(slices, F.ceil(F.col(slices) / ROWS_PER_SLICE).cast("int")), "heavy_keys")
    if heavy.isEmpty():
        stage.remove()
        return None
    return heavy


def _with_slices(df: DataFrame, keys: list[str], heavy: DataFrame, slices: str) -> DataFrame:
    """Add the slice count of each row's key; null for keys that are not heavy."""
    *heavy_columns, count = heavy.columns
    names = [temp_name("heavy") for _ in keys]
    lookup = heavy.select(
        *[F.col(f"`{h}`").alias(n) for h, n in zip(heavy_columns, names, strict=True)],
        F.col(count).alias(slices),
    )
    match = key_condition(list(zip(keys, names)), null_safe=True)
    if will_broadcast(heavy):
        return df.join(lookup, match, "left").drop(*names)
    # A hot key would be hot in this join too, so it is looked up in many places.
    own, other = temp_name("salt"), temp_name("salt")
    salts = F.explode(F.sequence(F.lit(0), F.lit(LOOKUP_SALTS - 1)))
    salted = df.withColumn(own, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(LOOKUP_SALTS)).cast("int"))
    match &= F.col(own) == F.col(other)
    return salted.join(lookup.withColumn(other, salts), match, "left").drop(*names, own, other)


def _sliced(
    df: DataFrame,
    keys: list[str],
    own: DataFrame | None,
    own_slice: str,
    other: DataFrame | None,
    other_slice: str,
) -> DataFrame:
    """Put each row in one slice of its own side and repeat it for those of the other."""
    count = temp_name("count")
    if own is None:
        df = df.withColumn(own_slice, F.lit(0))
    else:
        # Rows are numbered as they are written, so equal rows spread too and a
        # repeated task finds the same numbers.
        number = temp_name("number")
        df = Staging(df.sparkSession).cut(df.withColumn(number, F.monotonically_increasing_id()))
        slot = F.coalesce(F.pmod(F.col(number), F.col(count)).cast("int"), F.lit(0))
        df = _with_slices(df, keys, own, count).withColumn(own_slice, slot).drop(count, number)
    if other is None:
        return df.withColumn(other_slice, F.lit(0))
    slots = F.sequence(F.lit(0), F.coalesce(F.col(count), F.lit(1)) - 1)
    return _with_slices(df, keys, other, count).withColumn(other_slice, F.explode(slots)).drop(count)


def _slice_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[tuple[str, str]],
    how: str,
    null_safe: bool,
    heavy_left: DataFrame | None,
    heavy_right: DataFrame | None,
) -> DataFrame:
    """Join with the given heavy keys split; a left join has none on the right."""
    condition = key_condition(keys, null_safe)
    if heavy_left is None and heavy_right is None:
        return left.join(right, condition, how)
    lefts, rights = [k for k, _ in keys], [k for _, k in keys]
    l_slice, l_repeat, r_slice, r_repeat = (temp_name("slice") for _ in range(4))
    left = _sliced(left, lefts, heavy_left, l_slice, heavy_right, l_repeat)
    right = _sliced(right, rights, heavy_right, r_slice, heavy_left, r_repeat)
    condition &= (F.col(l_slice) == F.col(r_repeat)) & (F.col(l_repeat) == F.col(r_slice))
    return left.join(right, condition, how).drop(l_slice, l_repeat, r_slice, r_repeat)


def split_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[tuple[str, str]],
    how: str,
    null_safe: bool = False,
    unique_right: bool = False,
) -> DataFrame:
    """Join with heavy keys split; keeps all columns of both sides."""
    lefts, rights = [k for k, _ in keys], [k for _, k in keys]
    distinct = right.select(*[F.col(f"`{k}`") for k in rights]).distinct()
    heavy_left = heavy_keys(left, lefts, temp_name("n"))
    if how == "left_anti":
        return _slice_join(left, distinct, keys, how, null_safe, heavy_left, None)
    heavy_right = None if unique_right else heavy_keys(right, rights, temp_name("n"))
    if how == "left" and heavy_right is not None:
        # A repeated left row has a match in some slices only, so rows without
        # any match are found by themselves.
        matched = _slice_join(left, right, keys, "inner", null_safe, heavy_left, heavy_right)
        unmatched = _slice_join(left, distinct, keys, "left_anti", null_safe, heavy_left, None)
        return matched.unionByName(unmatched, allowMissingColumns=True)
    return _slice_join(left, right, keys, how, null_safe, heavy_left, heavy_right)


def key_condition(keys: list[tuple[str, str]], null_safe: bool) -> Column:
    pairs = [(F.col(f"`{lk}`"), F.col(f"`{rk}`")) for lk, rk in keys]
    return reduce(and_, [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])


def balanced_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[tuple[str, str]],
    how: str,
    null_safe: bool = False,
    unique_right: bool = False,
) -> DataFrame:
    """Equi-join on differently named key pairs, split unless Catalyst broadcasts a side.

    ``how`` is inner, left or left_anti; only an inner join can broadcast its left side.
    The two sides share no column name. ``unique_right`` says that no key comes
    twice on the right.
    """
    if will_broadcast(right) or (how == "inner" and will_broadcast(left)):
        return left.join(right, key_condition(keys, null_safe), how)
    return split_join(left, right, keys, how, null_safe, unique_right)
