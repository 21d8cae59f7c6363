"""Benchmark decontamination by a generalised suffix automaton over words.

The words of the test items form one automaton. Every document is streamed
through it word by word while the length of the longest match that ends at the
word is tracked. A match as long as the window, or a whole item shorter than the
window, is a hit. The state reached names the items, so one pass gives the hit
words, the spans and the items together. No shuffle is needed.

The items are cut into parts of at most ``PART_BYTES`` of text. The items of one part are
broadcast at a time, so what is broadcast has a fixed bound; more parts mean
more passes over the documents, whose hits are then united per document.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import repeat
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapweave.llm import common

WINDOW = 13
# Item text that one automaton holds.
PART_BYTES = 2_000_000
# Document text that is split into words at a time.
BATCH_BYTES = 1 << 21
END = b"\x01"

# Lower-cases A-Z and blanks every other ASCII byte that is no letter or digit.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """The lower-cased words of a text: runs of letters, digits and non-ASCII."""
    return (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


class SuffixAutomaton:
    """Generalised suffix automaton of word sequences, with the items of each window."""

    def __init__(self, items: list[tuple[int, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        sequences = []
        for name, words in items:
            if words:
                ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
                self._insert(ids)
                sequences.append((name, ids))
        order = sorted(range(1, len(self.length)), key=self.length.__getitem__)
        # The state on the suffix path whose strings include the last `window` words.
        self.window_state = [-1] * len(self.length)
        for v in order:
            if self.length[v] >= window:
                up = self.link[v]
                self.window_state[v] = v if self.length[up] < window else self.window_state[up]
        self.items: dict[int, set[int]] = {}
        self.short_items: dict[int, set[int]] = {}
        for name, ids in sequences:
            v = 0
            for n, w in enumerate(ids, 1):
                v = self.next[v][w]
                if n >= window:
                    self.items.setdefault(self.window_state[v], set()).add(name)
            if len(ids) < window:
                self.short_items.setdefault(v, set()).add(name)
        # The nearest state on the suffix path, itself included, that is a short item.
        self.short_state = [-1] * len(self.length)
        for v in order:
            self.short_state[v] = v if v in self.short_items else self.short_state[self.link[v]]
        self._index_pairs(sequences)
        self.lookup = {**self.vocabulary, END: -2}

    def _state(self, length: int) -> int:
        self.next.append({})
        self.link.append(-1)
        self.length.append(length)
        return len(self.length) - 1

    def _insert(self, ids: list[int]) -> None:
        last = 0
        for w in ids:
            last = self._extend(last, w)

    def _split(self, p: int, q: int, w: int) -> int:
        clone = self._state(self.length[p] + 1)
        self.next[clone] = dict(self.next[q])
        self.link[clone] = self.link[q]
        self.link[q] = clone
        while p != -1 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, w: int) -> int:
        q = self.next[last].get(w)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, w)
        new, p = self._state(self.length[last] + 1), last
        while p != -1 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p == -1:
            self.link[new] = 0
        else:
            q = self.next[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, w)
        return new

    def _index_pairs(self, sequences: list[tuple[int, list[int]]]) -> None:
        """Marks of the word pairs that occur in items, to find where streaming can matter."""
        self.shortest = min([self.window, *(len(ids) for _, ids in sequences)])
        pairs = sum(len(ids) for _, ids in sequences)
        self.mask = (1 << max(16, (16 * pairs).bit_length())) - 1
        self.pairs = np.zeros(self.mask + 1, dtype=bool)
        for _, ids in sequences:
            a = np.array(ids, dtype=np.int64)
            self.pairs[self._slot(a[:-1], a[1:])] = True

    def _slot(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a * 1_000_003 + b * 7_919) & self.mask

    def regions(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of all runs of words that could hold a window or a short item."""
        if self.shortest == 1:
            known, least = ids >= 0, 1
        else:
            known = (ids[:-1] >= 0) & (ids[1:] >= 0) & self.pairs[self._slot(ids[:-1], ids[1:])]
            least = self.shortest - 1
        edges = np.flatnonzero(np.diff(np.concatenate(([0], known.view(np.int8), [0]))))
        starts, ends = edges[::2], edges[1::2]
        long = ends - starts >= least
        return starts[long], ends[long] + (self.shortest > 1)

    def stream(self, ids: list[int], offset: int, spans: list, found: set[int]) -> None:
        """Run words through the automaton; add hit spans and the items that occur."""
        v = matched = 0
        for i, w in enumerate(ids, offset):
            while v and w not in self.next[v]:
                v = self.link[v]
                matched = self.length[v]
            v = self.next[v].get(w, 0)
            matched = matched + 1 if v else 0
            start = i + 1
            if matched >= self.window:
                start = i + 1 - self.window
                found.update(self.items[self.window_state[v]])
            # Only the state itself can stand for more words than were matched.
            s = self.short_state[v if self.length[v] <= matched else self.link[v]] if v else -1
            while s > 0:
                found.update(self.short_items[s])
                start = min(start, i + 1 - self.length[s])
                s = self.short_state[self.link[s]]
            if start <= i:
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append((start, i + 1))

    def hits(self, words: list[bytes]) -> list[tuple[int, list, set[int]]]:
        """For each END-terminated document in ``words``: words, hit spans, items."""
        ids = np.fromiter(map(self.lookup.get, words, repeat(-1)), np.int64, len(words))
        ends = np.flatnonzero(ids == -2)
        begins = np.concatenate(([0], ends[:-1] + 1)) if len(ends) else ends
        out = [(int(e - b), [], set()) for b, e in zip(begins, ends, strict=True)]
        if self.vocabulary:
            for a, b in zip(*self.regions(ids), strict=True):
                d = int(np.searchsorted(ends, a))
                self.stream(ids[a:b].tolist(), int(a - begins[d]), out[d][1], out[d][2])
        return out


@dataclass
class ItemPart:
    """Broadcast items; each Python worker builds their automaton once."""

    items: list[tuple[int, str]]
    window: int
    built: SuffixAutomaton | None = None

    @property
    def automaton(self) -> SuffixAutomaton:
        if self.built is None:
            named = [(n, words_of(text)) for n, (_, text) in enumerate(self.items)]
            self.built = SuffixAutomaton(named, self.window)
        return self.built


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def _batches(texts: list[str | None]):
    part, size = [], 0
    for text in texts:
        data = (text or "").encode("utf-8", "surrogatepass")
        part.append(data)
        size += len(data)
        if size >= BATCH_BYTES:
            yield part
            part, size = [], 0
    if part:
        yield part


def _scan_part(docs: DataFrame, part, text: str) -> DataFrame:
    schema = common.with_columns(
        docs,
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", SPANS),
        T.StructField("item_ids", T.ArrayType(T.StringType())),
    )
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        automaton, names = part.value.automaton, [n for n, _ in part.value.items]
        for batch in batches:
            found = []
            for texts in _batches(batch.column(1).to_pylist()):
                joined = b" ".join(t.translate(WORD_BYTES) + b" " + END for t in texts)
                found += automaton.hits(joined.split())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([n for n, _, _ in found], pa.int64()),
                    pa.array([[{"start": a, "end": b} for a, b in s] for _, s, _ in found], span_type),
                    pa.array([sorted({names[i] for i in items}) for _, _, items in found], pa.list_(pa.string())),
                ],
                names=["row", "n_words", "spans", "item_ids"],
            )

    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return docs.select(row, F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(run, schema)


def item_parts(items: DataFrame, item_id: str, text: str) -> tuple[DataFrame, int]:
    """Distinct items with a text, each with the number of its part; and the count of parts."""
    kept = items.select(
        F.coalesce(F.col(f"`{item_id}`").cast("string"), F.lit("")).alias("item"),
        F.col(f"`{text}`").cast("string").alias("text"),
    ).where(F.col("text").isNotNull()).distinct()
    total = kept.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // (PART_BYTES // 2)))
    return kept.withColumn("part", F.pmod(F.xxhash64("item", "text"), F.lit(parts))), parts


def contamination(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """One row per document: ``row`` (its columns), n_words, n_hit, spans, item_ids.

    ``spans`` are the merged [start, end) word ranges of all windows found, and
    ``item_ids`` the distinct sorted ids of the items with a window in the text.
    Null and empty texts have no words and no hits; items without words are left
    out; a null item id counts as an empty one, and repeated items as one. Without
    items nothing is hit. Repeated documents each give their row.
    """
    spark = docs.sparkSession
    split, parts = item_parts(items, item_id, item_text)

    def scanned(source: DataFrame, part: int) -> tuple[DataFrame, Broadcast]:
        # At most about PART_BYTES: the parts are cut by the measured size.
        held = [tuple(r) for r in split.where(F.col("part") == part).select("item", "text").toLocalIterator()]
        shared = spark.sparkContext.broadcast(ItemPart(held, window))
        return _scan_part(source, shared, text), shared

    if parts == 1:
        found = scanned(docs, 0)[0]
    else:
        # One staged key per row, so that the hits of the passes meet again. Only hits are kept of
        # all passes but one, and a part goes before the next is held.
        key, stage = f"key_{uuid4().hex}", common.staging(docs)
        source = stage.cut(docs.withColumn(key, F.expr("uuid()")))
        passes = []
        for part in range(1, parts):
            more, shared = scanned(source, part)
            hits = more.where(F.size("spans") > 0)
            passes.append(stage.cut(hits.select(F.col(f"row.{key}").alias(key), "spans", "item_ids")))
            shared.destroy()
        hits = reduce(DataFrame.unionByName, passes).groupBy(F.col(key).alias("_key"))
        hits = hits.agg(
            F.flatten(F.collect_list("spans")).alias("_spans"), F.flatten(F.collect_list("item_ids")).alias("_items")
        )
        first = scanned(source, 0)[0]
        joined = first.join(stage.cut(hits), F.col(f"row.{key}") == F.col("_key"), "left")
        spans = F.sort_array(F.concat("spans", F.coalesce("_spans", F.array().cast(SPANS.simpleString()))))
        names = F.concat("item_ids", F.coalesce("_items", F.array().cast("array<string>")))
        joined = joined.select("row", "n_words", spans.alias("spans"), F.sort_array(F.array_distinct(names)).alias("item_ids"))
        found = joined.select(F.col("row").dropFields(key).alias("row"), "n_words", merged_spans("spans"), "item_ids")
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"])
    return found.withColumn("n_hit", hit)


def merged_spans(column: str):
    """Sorted spans with overlapping and touching ones joined."""

    def add(acc, s):
        last = F.element_at(acc, -1)
        head = F.slice(acc, 1, F.size(acc) - 1)
        joined = F.struct(
            F.least(last["start"], s["start"]).alias("start"), F.greatest(last["end"], s["end"]).alias("end")
        )
        return (
            F.when(F.size(acc) == 0, F.array(s))
            .when(last["end"] >= s["start"], F.concat(head, F.array(joined)))
            .otherwise(F.concat(acc, F.array(s)))
        )

    none = F.array().cast(SPANS.simpleString())
    return F.aggregate(F.col(column), none, add).alias("spans")


def is_contaminated(coverage: int = 20):
    """Whether at least one word in ``coverage`` lies in a hit."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") * coverage >= F.col("n_words"))


def decontaminated(docs: DataFrame, items: DataFrame, coverage: int = 20, **options) -> DataFrame:
    """The documents below the coverage limit, unchanged and with their own columns."""
    kept = contamination(docs, items, **options).where(~is_contaminated(coverage))
    return kept.select("row.*")


def without_spans(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """All documents with the words of every hit cut from ``text``.

    Cut texts are rebuilt from their words and what stands between them; untouched
    texts stay as they are.
    """
    other = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
    found = contamination(docs, items, text=text, **options)
    body = F.col(f"row.`{text}`")
    words = F.regexp_extract_all(body, F.lit(f"([{other}]*[^{other}]+)"), F.lit(1))
    kept = F.filter(words, lambda w, i: ~F.exists("spans", lambda s: (i >= s["start"]) & (i < s["end"])))
    cut = F.when(F.size("spans") == 0, body).otherwise(F.ltrim(F.array_join(kept, "")))
    fields = [cut.alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    return found.select(*fields)
