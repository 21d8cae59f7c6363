"""Exact top-k search by distributed histogram selection.

Every query is scored against every candidate, in blocks: candidates and queries are cut into
blocks of fixed size, and each pair of blocks is one group of a cogrouped job that
multiplies two matrices. Nothing is kept of the scores but histograms: each pass
counts the scores of a query that fall into equal bins of an interval, the counts
are summed over all blocks, and the bin that holds the k-th highest score becomes the
next interval, until bins are one score wide. A last pass takes the
scores at or above the k-th value, with ties going to the smaller ids.

A block sends only the bins that hold its own k highest scores, and at the end
only its own k best: no more can matter, so the result stays exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mapweave.llm import common

K = 20
QUERY_BLOCK = 1024
CANDIDATE_BLOCK = 8192
BINS = 256
# Sums of products below this are exact in double precision.
EXACT = 1 << 53
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1


def whole_vectors(vectors: DataFrame, vec_id: str, embedding: str, scale: float) -> DataFrame:
    """(vec_id, vec): components floor(scale * x); vectors null or with null or non-finite components are left out."""
    x = F.col(f"`{embedding}`").cast("array<double>")
    fine = ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    whole = F.transform(x, lambda v: F.floor(v * F.lit(scale)).cast("long"))
    return vectors.where(x.isNotNull() & fine).select(F.col(f"`{vec_id}`").alias("vec_id"), whole.alias("vec"))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of numbers, short ones filled up with zeros."""
    flat = column.combine_chunks()
    lengths = np.asarray(flat.value_lengths())
    values = np.asarray(flat.flatten())
    if len(lengths) and (lengths == width).all():
        return values.reshape(-1, width)
    out = np.zeros((len(lengths), width), dtype=np.int64)
    out[np.arange(width) < lengths[:, None]] = values
    return out


def _scores(queries: pa.Table, candidates: pa.Table, exact: bool) -> tuple[np.ndarray, np.ndarray]:
    """Inner products, and whether each candidate is another row than the query's own."""
    q_col, c_col = queries.column("vec"), candidates.column("vec")
    width = max(int(np.max(col.combine_chunks().value_lengths(), initial=0)) for col in (q_col, c_col))
    q, c = _matrix(q_col, width), _matrix(c_col, width)
    if exact:
        scores = (q.astype(np.float64) @ c.T.astype(np.float64)).astype(np.int64)
    else:
        products = q.astype(object) @ c.T.astype(object)
        scores = np.clip(products, LOWEST, HIGHEST).astype(np.int64)
    return scores, np.asarray(queries.column("query_id"))[:, None] != np.asarray(candidates.column("vec_id"))[None, :]


def _histograms(exact: bool, span: int, width: int, k: int):
    """Counts of the scores in [low, low + span) by bins of ``width``."""

    def run(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        out = {"query": [], "bin": [], "n": []}
        if queries.num_rows and candidates.num_rows:
            scores, other = _scores(queries, candidates, exact)
            low = np.asarray(queries.column("low"))[:, None]
            # Differences of 64-bit numbers may need one bit more.
            away = scores - low if exact else scores.astype(object) - low
            q, c = np.nonzero(other & (away >= 0) & (away < span))
            bins = (away[q, c] // width).astype(np.int64)
            counts = np.bincount(q * BINS + bins, minlength=len(scores) * BINS).reshape(-1, BINS)
            higher = counts[:, ::-1].cumsum(axis=1)[:, ::-1] - counts
            at = np.nonzero((counts > 0) & (higher < k))
            out = {"query": np.asarray(queries.column("query"))[at[0]], "bin": at[1], "n": counts[at]}
        return pa.table({n: pa.array(v, pa.int64()) for n, v in out.items()})

    return run


def _best(exact: bool, k: int):
    def run(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        out = {"query": [], "query_id": [], "vec_id": [], "score": []}
        if queries.num_rows and candidates.num_rows:
            scores, other = _scores(queries, candidates, exact)
            q, c = np.nonzero(other & (scores >= np.asarray(queries.column("low"))[:, None]))
            ids, found = np.asarray(candidates.column("vec_id"))[c], scores[q, c]
            order = np.lexsort((ids, ~found, q))
            q, ids, found = q[order], ids[order], found[order]
            first = np.searchsorted(q, q)
            top = np.arange(len(q)) - first < k
            q, ids, found = q[top], ids[top], found[top]
            out = {
                "query": np.asarray(queries.column("query"))[q],
                "query_id": np.asarray(queries.column("query_id"))[q],
                "vec_id": ids,
                "score": found,
            }
        return pa.table({n: pa.array(v, pa.int64()) for n, v in out.items()})

    return run


def top_k(
    vectors: DataFrame,
    is_query: str = "vec_id % 20 = 0",
    k: int = K,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    scale: float = 64.0,
) -> DataFrame:
    """The ``k`` best candidates of each query row: query_id, rank, vec_id, score.

    Scores are inner products of the vectors' whole-numbered components; sums
    beyond 64 bits stop at the largest number. A query's own row, and any other row
    of its id, is no candidate for it. Equal query rows give one result; rows of one id
    with different vectors each give theirs. Repeated candidates each count.
    Vectors of different length are filled up with zeros. Rows with a null id take no part.
    """
    stage = common.staging(vectors)
    whole = whole_vectors(vectors, vec_id, embedding, scale).where(F.col("vec_id").isNotNull())
    whole = stage.table(whole.withColumn("vec_id", F.col("vec_id").cast("long")), "whole_vectors")
    asked = whole.where(is_query).distinct().select(
        F.xxhash64("vec_id", "vec").alias("query"), F.col("vec_id").alias("query_id"), "vec"
    )
    asked = stage.table(asked, "asked_vectors")
    squares = F.aggregate("vec", F.lit(0.0), lambda acc, v: acc + v.cast("double") * v.cast("double"))
    longest = F.sqrt(F.max(squares))
    bounds = [df.agg(longest).first()[0] or 0.0 for df in (whole, asked)]
    bound = min(int(bounds[0] * bounds[1] * 1.001) + 1, HIGHEST)
    exact = bound < EXACT
    low = -bound if exact else LOWEST
    width = -(-(2 * bound + 2) // BINS) if exact else -(-(1 << 64) // BINS)
    grid = [max(1, -(-asked.count() // QUERY_BLOCK)), max(1, -(-whole.count() // CANDIDATE_BLOCK))]

    def dealt(df: DataFrame, own: int, names: list[str]) -> DataFrame:
        """Rows evenly in blocks, and once for every block of the other side."""
        block = F.pmod(F.monotonically_increasing_id() * 7_919 + F.spark_partition_id(), F.lit(grid[own]))
        others = F.explode(F.sequence(F.lit(0), F.lit(grid[1 - own] - 1)).cast("array<long>"))
        return df.withColumn(names[own], block.cast("long")).withColumn(names[1 - own], others)

    names = ["_query_block", "_candidate_block"]
    candidates = dealt(whole, 1, names).groupBy(*names)
    state = stage.cut(asked.select("query", F.lit(low).cast("long").alias("low"), F.lit(0).cast("long").alias("above")))

    def blocks(state: DataFrame):
        with_low = asked.join(state, "query")
        return dealt(stage.cut(with_low), 0, names).groupBy(*names).cogroup(candidates)

    span = width * BINS
    while True:
        counted = blocks(state).applyInArrow(_histograms(exact, span, width, k), "query long, bin long, n long")
        sums = counted.groupBy("query", "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("query").orderBy(F.desc("bin"))
        reached = sums.withColumn("upto", F.sum("n").over(down)).join(state, "query")
        kth = (
            reached.where(F.col("above") + F.col("upto") >= k)
            .groupBy("query")
            .agg(F.max("bin").alias("bin"), F.max_by(F.col("upto") - F.col("n"), "bin").alias("over"))
        )
        # Queries with fewer scores than k keep the lowest bin.
        state = stage.cut(
            state.join(kth, "query", "left").select(
                "query",
                # Steps of the widest interval do not fit in 64 bits by themselves.
                (F.col("low").cast("decimal(38,0)") + F.coalesce("bin", F.lit(0)).cast("decimal(18,0)") * F.lit(width).cast("decimal(19,0)"))
                .cast("long")
                .alias("low"),
                (F.col("above") + F.coalesce("over", F.lit(0))).alias("above"),
            )
        )
        if width == 1:
            break
        span, width = width, -(-width // BINS)
    best = blocks(state).applyInArrow(_best(exact, k), "query long, query_id long, vec_id long, score long")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
