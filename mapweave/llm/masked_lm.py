"""Language-model scores by masked pseudo-likelihood.

A network of one hidden layer predicts every word of a document from the words on
both sides of it. The logarithms of these conditional probabilities, summed over a
text, are its score. The most frequent words of all documents are listed, and the list grows
with the square root of the corpus; rarer words share classes by hash. The output is a
softmax over groups of words, then over the words of the group. A rarer word's
probability is that of its class times the word's share of all occurrences of the class,
so that every word has its own.

Training runs where the data is. In each round every task starts from the same
parameters, takes gradient steps over all its documents and gives its parameters, which are
averaged by the number of words they come from. The driver holds one set of
parameters, whatever the size of the corpus.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapweave.llm import common

# As many groups as members in each makes the two softmaxes cheapest. A small corpus
# has this many; see groups_for.
GROUPS = 32
WORDS = GROUPS * GROUPS
# Numbers that are shared out to one rare class.
PER_CLASS = 16
SIDE = 2
HIDDEN = 24
ROUNDS = 2
STEP_WORDS = 8192
RATE = 0.08
SEED = 10
# Words of documents whose ids are handled at a time.
CHUNK = 1 << 18
# Bytes of text that are split into words at a time: to number them, and to count them.
TEXT_BYTES = 1 << 23
COUNTED_BYTES = 1 << 24
# Logits of one softmax that are worked out together; they stay in a core's cache.
LOGITS = 1 << 16
# Words beside the listed ones whose shares are broadcast; those of all others are joined.
KNOWN = 1 << 18
OFFSETS = [*range(-SIDE, 0), *range(1, SIDE + 1)]


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The lower-cased words of all texts, and where those of each text begin and end; empty words among them."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    return lists.flatten().cast(pa.binary()), lists.offsets.to_numpy()


def rare_classes(groups: int) -> int:
    return groups * groups // PER_CLASS - 1


def most_words(groups: int) -> int:
    """Words that can be listed beside the boundary of texts, which is word 0, and the rare classes."""
    return groups * groups - rare_classes(groups) - 1


def groups_for(words: list[bytes]) -> int:
    """The least number of groups, and of members in each, that holds the listed words."""
    groups = GROUPS
    while most_words(groups) < len(words):
        groups += 1
    return groups


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n): the occurrences of every word over the whole texts of all documents."""

    def run(batches):
        for part in _chunks(batches, 0, COUNTED_BYTES):
            counts = pc.value_counts(split_words(part.column(0))[0])
            rows = pa.RecordBatch.from_arrays([counts.field("values"), counts.field("counts")], names=["word", "n"])
            yield rows.filter(pc.greater(pc.binary_length(rows.column(0)), 0))

    return (
        docs.select(F.col(f"`{text}`").cast("string").alias("text"))
        .mapInArrow(run, "word binary, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
    )


def frequent(counts: DataFrame) -> list[bytes]:
    """The most frequent words of (word, n), most frequent first; ties by bytes.

    There are about half as many as the square root of all occurrences, or WORDS in a small
    corpus. ``counts`` is read several times and should be staged.
    """
    sizes = _sizes(counts)
    total = sum(n * words for n, words in sizes)
    least, room = _least(sizes, most_words(max(GROUPS, math.isqrt(math.isqrt(total) // 2))))
    rows = counts.where(F.col("n") > least).collect()
    if least and room:
        rows += counts.where(F.col("n") == least).orderBy("word").limit(room).collect()
    return [w for _, w in sorted((-r["n"], bytes(r["word"])) for r in rows)]


def _sizes(counts: DataFrame) -> list[tuple[int, int]]:
    """Every different count of (word, n), highest first, with its number of words."""
    # A corpus has few different counts: their sum is at most the number of its words.
    return sorted(map(tuple, counts.groupBy("n").count().collect()), reverse=True)


def _least(sizes: list[tuple[int, int]], room: int) -> tuple[int, int]:
    """The count above which all words find room, and the room that they leave."""
    for n, words in sizes:
        if words > room:
            return n, room
        room -= words
    return 0, room


def vocabulary(docs: DataFrame, text: str = "text") -> list[bytes]:
    """The listed words of documents, counted over whole texts."""
    return frequent(common.staging(docs).table(word_counts(docs, text), "word_counts"))


class Numbers:
    """The number of each listed word; any other word falls into a rare class by its checksum.

    ``known`` is a table (word, log_share) of words that are not listed.
    """

    def __init__(self, words: list[bytes], known: pa.Table | None = None):
        names, shares = known.to_pydict().values() if known else ((), ())
        self.rare = len(words) + 1
        self.classes = rare_classes(groups_for(words))
        self.names = pa.array([*words, *names], pa.binary())
        self.ids = np.append(np.arange(1, self.rare, dtype=np.uint32), self._class_ids(self.names[len(words) :]))
        self.shares = np.append(np.zeros(len(words)), np.array(shares, np.float64))

    def _class_ids(self, words: pa.Array) -> np.ndarray:
        sums = np.fromiter(map(zlib.crc32, words.to_numpy(zero_copy_only=False).tolist()), np.uint32, len(words))
        return sums % np.uint32(self.classes) + np.uint32(self.rare)

    def of(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The number of each word, and its log_share: 0 where it is listed, NaN where it is not known."""
        at = pc.index_in(distinct, value_set=self.names).fill_null(-1).to_numpy()
        other = np.flatnonzero(at < 0)
        ids, shares = np.empty(len(at), np.uint32), np.full(len(at), np.nan)
        found = at >= 0
        ids[found], shares[found] = self.ids[at[found]], self.shares[at[found]]
        ids[other] = self._class_ids(distinct.take(pa.array(other)))
        return ids, shares


RARE_WORDS = T.ArrayType(T.StructType([T.StructField("word", T.BinaryType()), T.StructField("times", T.LongType())]))


def with_ids(
    docs: DataFrame,
    words: list[bytes],
    text: str = "text",
    keep: list[str] | None = None,
    known: pa.Table | None = None,
) -> DataFrame:
    """(row, ids, known, rare): the columns of each document, its words as 32-bit numbers, the summed
    log_share of its words that are not listed but ``known``, and its other distinct words that are not
    listed, with their occurrences in it."""
    shared = docs.sparkSession.sparkContext.broadcast((words, known))

    def run(batches):
        numbers = Numbers(*shared.value)
        for part in _chunks(batches, 1, TEXT_BYTES):
            yield pa.RecordBatch.from_arrays([part.column(0), *_numbered(numbers, part.column(1))], names=schema.names)

    row = F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("row")
    narrow = docs.select(row, F.col(f"`{text}`").cast("string").alias("text"))
    schema = T.StructType(
        [
            T.StructField("row", narrow.schema["row"].dataType),
            T.StructField("ids", T.BinaryType()),
            T.StructField("known", T.DoubleType()),
            T.StructField("rare", RARE_WORDS),
        ]
    )
    return narrow.mapInArrow(run, schema)


def _numbered(numbers: Numbers, texts: pa.Array) -> list[pa.Array]:
    """ids, known and rare of each text; each distinct word is looked up once."""
    words, ends = split_words(texts)
    coded = words.dictionary_encode()
    names, at = coded.dictionary, coded.indices.to_numpy()
    blank = pc.index(names, b"").as_py()
    if blank >= 0:
        filled = at != blank
        at, ends = at[filled], np.append(0, np.cumsum(filled))[ends]
    ids, shares = numbers.of(names)
    bounds = pa.py_buffer((4 * ends).astype(np.int32))
    found = pa.Array.from_buffers(pa.binary(), len(texts), [None, bounds, pa.py_buffer(ids[at])])
    doc, share = np.repeat(np.arange(len(texts)), np.diff(ends)), shares[at]
    known = np.bincount(doc, weights=np.nan_to_num(share), minlength=len(texts))
    far = np.isnan(share)
    pairs, times = np.unique(doc[far] * max(len(names), 1) + at[far], return_counts=True)
    doc, at = np.divmod(pairs, max(len(names), 1))
    rare = pa.StructArray.from_arrays([names.take(pa.array(at)), pa.array(times, pa.int64())], ["word", "times"])
    starts = np.searchsorted(doc, np.arange(len(texts) + 1))
    return [found, pa.array(known, pa.float64()), pa.ListArray.from_arrays(pa.array(starts, pa.int32()), rare)]


def class_shares(counts: DataFrame, words: list[bytes]) -> DataFrame:
    """(word, n, log_share): of every word of (word, n) that is not listed, the logarithm of its
    share of all occurrences of its class."""
    listed = counts.sparkSession.createDataFrame([(w,) for w in words], "word binary")
    classes = rare_classes(groups_for(words))
    rare = counts.join(F.broadcast(listed), "word", "left_anti").withColumn("class", F.crc32("word") % classes)
    sums = rare.groupBy("class").agg(F.sum("n").alias("total"))
    return rare.join(F.broadcast(sums), "class").select("word", "n", F.log(F.col("n") / F.col("total")).alias("log_share"))


def known_shares(shares: DataFrame, most: int = KNOWN) -> pa.Table:
    """(word, log_share) of the most frequent words of (word, n, log_share), ``most`` at the most."""
    least, _ = _least(_sizes(shares), most)
    return shares.where(F.col("n") > least).select("word", "log_share").toArrow()


def within_classes(ids: DataFrame, shares: DataFrame) -> DataFrame:
    """(key, inside): the summed log_share of the rare words of each document of (key, rare)."""
    pairs = ids.select("key", F.explode("rare").alias("pair")).select("key", "pair.*")
    return pairs.join(shares, "word").groupBy("key").agg(F.sum(F.col("times") * F.col("log_share")).alias("inside"))


class WindowNetwork:
    """Parameters and steps of the network."""

    def __init__(self, flat: np.ndarray | None = None, groups: int = GROUPS):
        self.groups = groups
        shapes = {
            "inputs": (len(OFFSETS), groups * groups, HIDDEN),
            "hidden": (HIDDEN,),
            # The last row of output weights is their bias.
            "group": (HIDDEN + 1, groups),
            "member": (groups, HIDDEN + 1, groups),
        }
        if flat is None:
            draw = np.random.default_rng(SEED)
            flat = np.concatenate([draw.normal(0, 0.1, np.prod(s)) * (len(s) > 1) for s in shapes.values()])
        self.flat = flat.astype(np.float32)
        self.shapes = shapes
        self.parts = self._parted(self.flat)
        self.seen: np.ndarray | None = None

    def _parted(self, flat: np.ndarray, names: list[str] | None = None) -> dict[str, np.ndarray]:
        parts, at = {}, 0
        for name in names or self.shapes:
            size = int(np.prod(self.shapes[name]))
            parts[name] = flat[at : at + size].reshape(self.shapes[name])
            at += size
        return parts

    def _hidden(self, context: list[np.ndarray]) -> np.ndarray:
        """The hidden layer, and a last column of ones."""
        total = np.take(self.parts["inputs"][0], context[0], axis=0)
        total += self.parts["hidden"]
        for table, words in zip(self.parts["inputs"][1:], context[1:], strict=True):
            total += np.take(table, words, axis=0)
        # Much slower where lines of the output lie apart.
        np.tanh(total, out=total)
        out = np.ones((len(total), HIDDEN + 1), total.dtype)
        out[:, :HIDDEN] = total
        return out

    def _by_group(self, words: np.ndarray) -> tuple[np.ndarray, list[list[tuple[int, int, int]]]]:
        """An order that puts the words of a group together, and blocks of the groups' bounds in it."""
        # Numbers of 16 bits or fewer are sorted by radix.
        group = (words // self.groups).astype(np.uint16)
        order = np.argsort(group, kind="stable")
        cuts = np.searchsorted(group[order], np.arange(self.groups + 1)).tolist()
        most, blocks, room = max(1, LOGITS // self.groups), [], 0
        for g, (a, end) in enumerate(zip(cuts[:-1], cuts[1:])):
            while a < end:
                if not room:
                    blocks.append([])
                    room = most
                b = min(end, a + room)
                blocks[-1].append((g, a, b))
                room -= b - a
                a = b
        return order, blocks

    def _wide(self) -> tuple[bool, bool]:
        """Whether exp could overflow on logits of groups, and of members."""
        # Hidden values lie in [-1, 1], which bounds the logits.
        return tuple(bool(np.abs(self.parts[name]).sum(axis=-2).max() > 80) for name in ("group", "member"))

    def _outputs(self, hidden: np.ndarray, block: list[tuple[int, int, int]], wide: tuple[bool, bool]):
        """In proportion to the probabilities of all groups, and of all members of the word's group, and their
        sums, for the rows of a block."""
        first, last = block[0][1], block[-1][2]
        member = np.empty((last - first, self.groups), hidden.dtype)
        for g, a, b in block:
            np.dot(hidden[a:b], self.parts["member"][g], out=member[a - first : b - first])
        group = hidden[first:last] @ self.parts["group"]
        return [(x, self._exp(x, w)) for x, w in zip((group, member), wide, strict=True)]

    @staticmethod
    def _exp(logits: np.ndarray, wide: bool) -> np.ndarray:
        """Turns logits into their exponentials, and gives the sum of each row."""
        if wide:
            logits -= logits.max(axis=1, keepdims=True)
        np.exp(logits, out=logits)
        return logits @ np.ones(logits.shape[1], logits.dtype)

    def log_probabilities(self, words: np.ndarray, context: list[np.ndarray]) -> np.ndarray:
        """Natural logarithm of the probability of each word given its context."""
        order, blocks = self._by_group(words)
        rows, group, member = np.arange(len(words)), *np.divmod(words[order], self.groups)
        hidden = self._hidden([c[order] for c in context])
        ranked, wide = np.empty(len(words), dtype=np.float64), self._wide()
        for block in blocks:
            a, b = block[0][1], block[-1][2]
            (by_group, groups), (by_member, members) = self._outputs(hidden, block, wide)
            ranked[a:b] = by_group[rows[: b - a], group[a:b]] / groups * (by_member[rows[: b - a], member[a:b]] / members)
        out = np.empty_like(ranked)
        out[order] = np.log(np.maximum(ranked, 1e-30))
        return out

    def step(self, words: np.ndarray, context: list[np.ndarray]) -> None:
        """One gradient step over a batch."""
        order, blocks = self._by_group(words)
        rows, group, member = np.arange(len(words)), *np.divmod(words[order], self.groups)
        context = [c[order] for c in context]
        hidden = self._hidden(context)
        if self.seen is None:
            self.seen = np.zeros_like(self.flat)
        # The inputs come first; a step changes only the lines of words in its contexts.
        inputs, tail = self.parts["inputs"], self.parts["inputs"].size
        slope = np.zeros_like(self.flat[tail:])
        grad = self._parted(slope, list(self.shapes)[1:])
        back, wide = np.empty_like(hidden), self._wide()
        for block in blocks:
            first, last = block[0][1], block[-1][2]
            (by_group, groups), (by_member, members) = self._outputs(hidden, block, wide)
            by_group /= groups[:, None]
            by_group[rows[: last - first], group[first:last]] -= 1
            grad["group"] += hidden[first:last].T @ by_group
            np.matmul(by_group, self.parts["group"].T, out=back[first:last])
            by_member /= members[:, None]
            by_member[rows[: last - first], member[first:last]] -= 1
            for g, a, b in block:
                part = by_member[a - first : b - first]
                grad["member"][g] += np.dot(hidden[a:b].T, part)
                back[a:b] += np.dot(part, self.parts["member"][g].T)
        hidden *= hidden
        back *= 1 - hidden
        # bincount adds up 64-bit numbers.
        lines = back.T[:HIDDEN].astype(np.float64, order="C")
        grad["hidden"][:] = lines.sum(axis=1)
        number = np.float32(len(words))
        for table, past, near in zip(inputs, self._parted(self.seen)["inputs"], context, strict=True):
            there = np.zeros(len(table), bool)
            there[near] = True
            changed = np.flatnonzero(there)
            place = np.zeros(len(table), np.intp)
            place[changed] = np.arange(len(changed))
            at = place[near]
            own = np.empty((HIDDEN, len(changed)))
            for total, line in zip(own, lines, strict=True):
                total[:] = np.bincount(at, weights=line, minlength=len(changed))
            own = own.T.astype(np.float32, order="C")
            own /= number
            sums, moved = np.take(past, changed, axis=0), np.take(table, changed, axis=0)
            sums += own * own
            past[changed] = sums
            moved -= self._scaled(own, sums, sums)
            table[changed] = moved
        slope /= number
        self.seen[tail:] += slope * slope
        self.flat[tail:] -= self._scaled(slope, self.seen[tail:])

    @staticmethod
    def _scaled(slope: np.ndarray, sums: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
        """The step against ``slope``, in its place; ``out`` takes the roots of the sums."""
        root = np.sqrt(sums, out=out)
        root += np.float32(1e-5)
        slope /= root
        slope *= np.float32(RATE)
        return slope


def stream(documents: list[bytes]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Words of several documents, their contexts, and the number of words of each.

    Texts are set apart by boundary words, which are context but never predicted.
    """
    gap = np.zeros(SIDE, np.uint32)
    parts, sizes = [gap], []
    for data in documents:
        ids = np.frombuffer(data, np.uint32)
        parts += [ids, gap]
        sizes.append(len(ids))
    line = np.concatenate(parts).astype(np.int64)
    at = np.flatnonzero(line > 0)
    return line[at], [line[at + o] for o in OFFSETS], np.array(sizes)


def _chunks(batches, column: int, most: int = 4 * CHUNK):
    """Row ranges of batches with about ``most`` bytes each."""
    for batch in batches:
        begin, size = 0, 0
        for i, length in enumerate(pc.binary_length(batch.column(column)).to_pylist()):
            size += length or 0
            if size >= most:
                yield batch.slice(begin, i + 1 - begin)
                begin, size = i + 1, 0
        if begin < batch.num_rows:
            yield batch.slice(begin)


# Parameters that are averaged together, and the rows that carry them.
BLOCK = 1024
MOVED = "block int, words long, values binary"
ARROW_MOVED = pa.schema([("block", pa.int32()), ("words", pa.int64()), ("values", pa.binary())])


def trained(ids: DataFrame, rounds: int = ROUNDS, groups: int = GROUPS) -> WindowNetwork:
    """Train on all documents of (row, ids); without words the first parameters stay."""
    network = WindowNetwork(groups=groups)
    for number in range(rounds):
        shared = ids.sparkSession.sparkContext.broadcast(network.flat)

        def run(batches, shared=shared, number=number):
            own, count = WindowNetwork(shared.value.copy(), groups), 0
            draw = np.random.default_rng(SEED + number)
            for part in _chunks(batches, 0):
                words, context, _ = stream([v.as_py() for v in part.column(0)])
                order = draw.permutation(len(words))
                for a in range(0, len(words), STEP_WORDS):
                    at = order[a : a + STEP_WORDS]
                    own.step(words[at], [c[at] for c in context])
                count += len(words)
            if count:
                # Words that a task has not seen keep their parameters there.
                yield _moved(own.flat - shared.value, count)

        got = _averaged(ids.select("ids").mapInArrow(run, MOVED)).collect()
        total = sum(r["words"] for r in got if r["block"] < 0)
        flat = network.flat.copy()
        for r in got:
            if r["block"] >= 0:
                part = np.frombuffer(r["values"], np.float64)
                at = r["block"] * BLOCK
                flat[at : at + BLOCK] += (part / total)[: len(flat) - at].astype(flat.dtype)
        if total:
            network = WindowNetwork(flat, groups)
    return network


def _moved(moved: np.ndarray, words: int) -> pa.RecordBatch:
    """What a task changed: a row for each block of parameters that moved, and one, block -1, for its words."""
    blocks = np.zeros((-(-len(moved) // BLOCK), BLOCK), np.float32)
    blocks.reshape(-1)[: len(moved)] = moved
    at = np.flatnonzero(blocks.any(axis=1))
    values = [b"", *(blocks[i].tobytes() for i in at)]
    columns = [pa.array(np.append(-1, at), pa.int32()), pa.array([words] * len(values), pa.int64())]
    return pa.RecordBatch.from_arrays([*columns, pa.array(values, pa.binary())], names=["block", "words", "values"])


def _averaged(rows: DataFrame) -> DataFrame:
    """(block, words, values): the moves of all tasks added up, each times its words; in one order on every run."""
    placed = rows.withColumn("task", F.spark_partition_id()).repartition("block").sortWithinPartitions("block", "task")

    def run(batches):
        block, words, total = None, 0, np.zeros(0)

        def out():
            return pa.RecordBatch.from_pydict({"block": [block], "words": [words], "values": [total.tobytes()]}, ARROW_MOVED)

        for batch in batches:
            for number, count, values in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if number != block:
                    if block is not None:
                        yield out()
                    block, words, total = number, 0, np.zeros(len(values) // 4)
                words += count
                total = total + np.frombuffer(values, np.float32).astype(np.float64) * count
        if block is not None:
            yield out()

    return placed.select("block", "words", "values").mapInArrow(run, MOVED)


def scored(ids: DataFrame, network: WindowNetwork) -> DataFrame:
    """(row, n_words, log_likelihood) of every document of (row, ids).

    A word that is not listed counts with the probability of its class; see ``within_classes``.
    """
    shared = ids.sparkSession.sparkContext.broadcast(network.flat)
    groups = network.groups

    def run(batches):
        net = WindowNetwork(shared.value, groups)
        for part in _chunks(batches, 1):
            words, context, sizes = stream([v.as_py() for v in part.column(1)])
            sums = np.zeros(len(sizes))
            doc = np.repeat(np.arange(len(sizes)), sizes)
            for a in range(0, len(words), STEP_WORDS):
                b = a + STEP_WORDS
                got = net.log_probabilities(words[a:b], [c[a:b] for c in context])
                sums += np.bincount(doc[a:b], weights=got, minlength=len(sizes))
            arrays = [part.column(0), pa.array(sizes, pa.int64()), pa.array(sums)]
            yield pa.RecordBatch.from_arrays(arrays, names=["row", "n_words", "log_likelihood"])

    row = ids.schema["row"]
    schema = T.StructType(
        [row, T.StructField("n_words", T.LongType()), T.StructField("log_likelihood", T.DoubleType())]
    )
    return ids.select("row", "ids").mapInArrow(run, schema)


def pseudo_likelihood(docs: DataFrame, text: str = "text", keep: list[str] | None = None, rounds: int = ROUNDS) -> DataFrame:
    """(row, n_words, log_likelihood): the summed log-probability of every word of each document.

    The network is trained on the same documents. Null and empty texts have no
    words and log-likelihood 0. Repeated rows each give theirs, and count as often in training.
    """
    stage = common.staging(docs)
    counts = stage.table(word_counts(docs, text), "word_counts")
    words = frequent(counts)
    shares = stage.table(class_shares(counts, words), "class_shares")
    ids = with_ids(docs, words, text, keep, known_shares(shares)).withColumn("key", F.monotonically_increasing_id())
    ids = stage.table(ids, "word_ids")
    inside = within_classes(ids, shares)
    keyed = ids.select(F.struct("row", "key", "known").alias("row"), "ids")
    by_class = scored(keyed, trained(ids, rounds, groups_for(words))).select("row.*", "n_words", "log_likelihood")
    whole = F.col("log_likelihood") + F.col("known") + F.coalesce("inside", F.lit(0.0))
    return by_class.join(inside, "key", "left").select("row", "n_words", whole.alias("log_likelihood"))
