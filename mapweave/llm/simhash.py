"""SimHash near-duplicates, linked through a Gray-order hierarchical index.

Each document gets a 64-bit fingerprint of its word shingles. Distinct fingerprints
within a few bits of each other are linked, and the connected components of
the links are the groups of near-duplicates.

The index is a hierarchy of masked bit patterns. Its top nodes are bands: with one
band more than differing bits allowed, two linked fingerprints agree in at least
one whole band, so each (band mask, pattern) is a node that holds all its
fingerprints, and a group too large for one task is divided again by bands of its
remaining bits. Below, the fingerprints of a node are sorted by Gray rank, where
neighbours differ in few bits. Runs of them become nodes that hold the bits
their members agree on, less the bits that the node above them already holds. A search
goes down from a top node, adds up the differences met on the way, and
drops a whole node as soon as they exceed the limit.

Links found inside one node are reduced to a spanning forest before they leave
the task, so a group of copies never becomes all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapweave.llm import common
from mapweave.llm.components import components
from mapweave.sources.storage import Staging

SHINGLE = 3
MOST_BITS = 2
HASH_SEED = 42
# Fingerprints of one top node that a task searches; larger nodes are divided.
NODE_LIMIT = 4096
# Children of an index node.
FAN = 8
# Fingerprints indexed, and candidate comparisons held, at a time.
INDEXED = 1 << 17
HELD = 1 << 21


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The majority of each bit over the hashes of all shingles, as a signed 64-bit number.

    Fewer words than a shingle count as one; no words give zero.
    """
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    size = min(shingle, len(words))
    digest, seed = xxhash.xxh64_intdigest, HASH_SEED
    bounds = zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist(), strict=True)
    hashes = np.array([digest(joined[a:b], seed) for a, b in bounds], dtype=">u8")
    counts = np.zeros(64, dtype=np.int64)
    for part in range(0, len(hashes), 8192):
        bits = np.unpackbits(hashes[part : part + 8192].view(np.uint8)).reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes)).view(">i8")[0])


def with_fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(row, fingerprint): the columns of each document, and its fingerprint."""

    def run(batches):
        for batch in batches:
            values = [fingerprint(t.as_py(), shingle) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.int64())], names=["row", "fingerprint"])

    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    schema = common.with_columns(docs, T.StructField("fingerprint", T.LongType()))
    return docs.select(row, F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(run, schema)


def gray_rank(value: Column) -> Column:
    """Position of a bit pattern in Gray code order, for sorting as a signed number."""
    for shift in (1, 2, 4, 8, 16, 32):
        value = value.bitwiseXOR(F.shiftrightunsigned(value, shift))
    return value.bitwiseXOR(F.lit(-(1 << 63)))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def band_masks(within: int, bands: int) -> list[int]:
    """The set bits of ``within`` cut into ``bands`` masks; fewer where bits run out."""
    bits = [i for i in range(64) if within >> i & 1]
    cuts = [len(bits) * i // bands for i in range(bands + 1)]
    masks = [sum(1 << b for b in bits[a:z]) for a, z in zip(cuts, cuts[1:])]
    return [m for m in masks if m]


def top_nodes(prints: DataFrame, stage: Staging, most_bits: int, limit: int = NODE_LIMIT) -> DataFrame:
    """(mask, pattern, value): every fingerprint under the top nodes that hold it.

    Nodes of more than ``limit`` fingerprints are divided by bands of their free
    bits until none is left; two fingerprints within ``most_bits`` always share one.
    """
    everything = (1 << 64) - 1
    masks = band_masks(everything, most_bits + 1)

    def under(df: DataFrame, choices: Column) -> DataFrame:
        opened = df.select("value", F.explode(choices).alias("mask"))
        return opened.select("mask", F.col("value").bitwiseAND(F.col("mask")).alias("pattern"), "value")

    placed = stage.cut(under(prints, F.array(*[F.lit(_signed(m)) for m in masks])))
    done = []
    while True:
        large = placed.groupBy("mask", "pattern").count().where(F.col("count") > limit).drop("count")
        large = stage.cut(large)
        if large.isEmpty():
            break
        done.append(placed.join(large, ["mask", "pattern"], "left_anti"))
        deeper = {m: [m | b for b in band_masks(everything & ~m, most_bits + 1)] for m in masks}
        options = F.create_map(
            *[x for m, below in deeper.items() for x in (F.lit(_signed(m)), F.array(*[F.lit(_signed(b)) for b in below]))]
        )
        divided = placed.join(large, ["mask", "pattern"], "left_semi")
        placed = stage.cut(under(divided, options[F.col("mask")]).distinct())
        masks = sorted({b for below in deeper.values() for b in below})
    for part in done:
        placed = placed.unionByName(part)
    return placed


class GrayIndex:
    """Index over fingerprints sorted by top node and Gray rank, searched for pairs within some bits."""

    def __init__(self, values: np.ndarray, nodes: np.ndarray):
        """``nodes`` numbers the top node of each value, ascending."""
        self.values = values
        # Levels from the values up; each has its group, agreed bits, their values and child bounds.
        group, begins = nodes, np.arange(len(values))
        self.levels = [(np.full(len(values), ~np.uint64(0)), values, begins, begins + 1)]
        self.last = [np.arange(len(values))]
        while len(group) > 1 and (group[1:] == group[:-1]).any():
            first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
            sizes = np.diff(np.append(first, len(group)))
            within = np.arange(len(group)) - np.repeat(first, sizes)
            starts = np.flatnonzero(within % FAN == 0)
            agreed, held, *_ = self.levels[-1]
            both = np.bitwise_and.reduceat(held, starts)
            any_ = np.bitwise_or.reduceat(held, starts)
            same = np.bitwise_and.reduceat(agreed, starts) & ~(both ^ any_)
            stops = np.append(starts[1:], len(group))
            self.levels.append((same, both & same, starts, stops))
            self.last.append(self.last[-1][stops - 1])
            group = group[starts]
        self.root_of = np.searchsorted(group, nodes)

    def pairs(self, queries: np.ndarray, most_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query, later position) within ``most_bits``, for positions ``queries``."""
        nodes, query = self.root_of[queries], queries
        spent = np.zeros(len(queries), dtype=np.int64)
        above = np.zeros(len(queries), dtype=np.uint64)
        for level in range(len(self.levels) - 1, -1, -1):
            agreed, held, starts, stops = self.levels[level]
            own = agreed[nodes] & ~above
            spent = spent + np.bitwise_count((self.values[query] ^ held[nodes]) & own)
            keep = (spent <= most_bits) & (self.last[level][nodes] > query)
            nodes, query, spent = nodes[keep], query[keep], spent[keep]
            if level == 0:
                yield query, nodes
                return
            count = stops[nodes] - starts[nodes]
            above = np.repeat(agreed[nodes], count)
            query, spent = np.repeat(query, count), np.repeat(spent, count)
            base = np.repeat(starts[nodes] - np.concatenate(([0], np.cumsum(count)[:-1])), count)
            nodes = base + np.arange(len(base))


def _roots(size: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The first position linked to each position, over all links."""
    root = np.arange(size)
    for a, b in pairs:
        while True:
            low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
            apart = low != high
            if not apart.any():
                break
            np.minimum.at(root, high[apart], low[apart])
            while (root[root] != root).any():
                root = root[root]
    return root


def links_of(values: np.ndarray, nodes: np.ndarray, most_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between values under the same top node."""
    index = GrayIndex(values, nodes)
    first = np.flatnonzero(np.concatenate(([True], nodes[1:] != nodes[:-1])))
    sizes = np.diff(np.append(first, len(nodes)))
    # Queries are taken so many at a time that their nodes' members stay bounded.
    work = np.cumsum(np.repeat(sizes, sizes)) // HELD
    cuts = np.flatnonzero(np.concatenate(([True], work[1:] != work[:-1], [True])))

    def found():
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield from index.pairs(np.arange(a, b), most_bits)

    root = _roots(len(values), found())
    moved = np.flatnonzero(root != np.arange(len(values)))
    return values[moved], values[root[moved]]


def links(prints: DataFrame, stage: Staging, most_bits: int = MOST_BITS, limit: int = NODE_LIMIT) -> DataFrame:
    """(u, v): links that connect all distinct ``value`` fingerprints within ``most_bits``."""
    ordered = (
        top_nodes(prints, stage, most_bits, limit)
        .repartition("mask", "pattern")
        .sortWithinPartitions("mask", "pattern", gray_rank(F.col("value")))
    )

    def search(mask, pattern, value):
        change = (mask[1:] != mask[:-1]) | (pattern[1:] != pattern[:-1])
        nodes = np.concatenate(([0], np.cumsum(change)))
        # Nodes of one fingerprint have nothing to link.
        sizes = np.bincount(nodes)
        several = sizes[nodes] > 1
        if not several.any():
            return
        u, v = links_of(value[several].view(np.uint64), nodes[several], most_bits)
        yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

    def run(batches):
        held: list[tuple[np.ndarray, ...]] = []
        count = 0
        for batch in batches:
            held.append(tuple(batch.column(i).to_numpy() for i in range(3)))
            count += batch.num_rows
            if count < INDEXED:
                continue
            mask, pattern, value = (np.concatenate(c) for c in zip(*held, strict=True))
            # The last node may go on in the next batch.
            open_ = (mask == mask[-1]) & (pattern == pattern[-1])
            stop = int(np.argmax(open_))
            if stop:
                yield from search(mask[:stop], pattern[:stop], value[:stop])
            held, count = [(mask[stop:], pattern[stop:], value[stop:])], len(mask) - stop
        if count:
            yield from search(*(np.concatenate(c) for c in zip(*held, strict=True)))

    return ordered.mapInArrow(run, "u long, v long")


def near_duplicates(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    shingle: int = SHINGLE,
    most_bits: int = MOST_BITS,
    keep: list[str] | None = None,
) -> DataFrame:
    """(row, fingerprint, component_id, root): one row per document.

    ``component_id`` is the least document id that can be reached through links, the document
    itself included. Null and empty texts have fingerprint zero and are linked like
    any other. Repeated rows each give their row. Null ids count only where a
    component has no other. ``root`` is a fingerprint of the component that stands for
    it, also where components share an id or have none. ``keep`` names the columns of ``row``; all by default.
    """
    stage = common.staging(docs)
    narrow = docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*(keep or docs.columns), text])])
    printed = with_fingerprints(narrow, text, shingle)
    if keep:
        printed = printed.select(F.struct(*[F.col(f"row.`{c}`") for c in keep]).alias("row"), "fingerprint")
    printed = stage.table(printed.withColumn("_id", F.col(f"row.`{doc_id}`")), "fingerprints")
    distinct = printed.groupBy(F.col("fingerprint").alias("value")).agg(F.min("_id").alias("least"))
    distinct = stage.table(distinct, "distinct_fingerprints")
    linked = components(stage.cut(links(distinct.select("value"), stage, most_bits)), stage)
    rooted = distinct.join(linked, F.col("value") == F.col("node"), "left").select(
        "value", "least", F.coalesce("root", "value").alias("root")
    )
    rooted = stage.table(rooted, "rooted_fingerprints")
    least = stage.table(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "component_ids")
    named = stage.table(rooted.join(least, "root").select("value", "component_id", "root"), "named_fingerprints")
    return printed.join(named, F.col("fingerprint") == F.col("value")).select("row", "fingerprint", "component_id", "root")


def hex_digits(value: str = "fingerprint") -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def deduplicated(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """One document of each group, the one with the least id, with the columns of ``docs``.

    Of several rows with that id, the one with the least text checksum stays.
    """
    found = near_duplicates(docs, text, doc_id, **options)
    kept = found.where(F.col(f"row.`{doc_id}`").eqNullSafe(F.col("component_id")))
    body = F.coalesce(F.col(f"row.`{text}`").cast("string"), F.lit(""))
    # Components may share their least id, or have none.
    one = kept.groupBy("root").agg(
        F.min_by("row", F.struct(F.crc32(body.cast("binary")), F.length(body))).alias("row")
    )
    return one.select("row.*")
