"""Phrase collocations by partitioned mining.

Documents are dealt into a fixed number of shards. Each shard is mined completely for phrases that
reach the support lowered to the shard's part of all words: words first, then word pairs of such
words, then longer phrases of such pairs. A phrase that is frequent in all documents is frequent
in one shard at least, so the union of the shards' phrases misses none; all of them are then
counted exactly over all documents, as text.

Shards are spread over all tasks: a task counts what it reads, and sums meet by 32 bits of a hash of
the phrase. Sums travel as packed rows, one for each shard, language and range of hashes. What passes from one level to the next is a bitmap of fixed size. Phrases that share
a hash, or a bit, only make more candidates for the exact count.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mapweave.llm import common

SUPPORT = 30
LONGEST = 4
# Shards; a shard's support is about SUPPORT / SHARDS.
SHARDS = 6
# A phrase goes if a longer one that holds it has this many hundredths of its occurrences.
COVERED = 80
FIRST = 2000
SCALE = 2_000_000
UNKNOWN_LANG = "und"
# Bits of a hash that are summed by, and those that find a place in one level's bitmap of 16 MB.
HASH_BITS, BITS = 32, 27
BUCKET = 1 << 15
# First bits of a hash by which sums are packed into rows.
PACK_BITS = 10
LIMITS = ["support", "n_shard", "n_all"]
# Bytes of text taken at a time, phrase numbers and words held by a task before they are summed.
BYTES, HELD, WORDS = 4 << 20, 1 << 22, 1 << 18
# Texts taken and phrases given out at a time.
TEXTS, ROWS = 500, 50_000
SUMS = pa.schema(
    [("shard", pa.int32()), ("lang", pa.string()), ("hashes", pa.binary()), ("counts", pa.binary()), ("total", pa.int64())]
)

# Capital letters become small, breaks a full stop, tabs blanks: as bytes, which leaves all others alone.
_TABLE = bytearray(range(256)).lower()
for _b in b".,;:!?\n\x0b\x0c\r":
    _TABLE[_b] = ord(".")
_TABLE[ord("\t")] = ord(" ")
_TABLE = bytes(_TABLE)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads close ones."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Words(dict):
    """Numbers words in the order they are met; 0 is a break."""

    def __init__(self):
        super().__init__()
        self.names: list[bytes] = []
        self.hashes = np.empty(0, np.uint64)
        self[b"."]

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.names)
        self.names.append(word)
        return number

    def hashed(self) -> np.ndarray:
        new = self.names[len(self.hashes) :]
        if new:
            import xxhash

            more = np.fromiter(map(xxhash.xxh3_64_intdigest, new), np.uint64, len(new))
            self.hashes = np.concatenate((self.hashes, more))
        return self.hashes


def _chunks(batches, most: int):
    """Lists of (shard, lang, bytes) of texts of one shard and language each, with a break after each text."""
    held: dict[tuple[int, str], list] = {}
    size = 0
    slices = (batch.slice(a, TEXTS) for batch in batches for a in range(0, batch.num_rows, TEXTS))
    for part in slices:
        shards, langs, texts = (part.column(i) for i in range(3))
        texts = texts.cast(pa.binary())
        for shard, lang, data in zip(shards.to_pylist(), langs.to_pylist(), texts.to_pylist(), strict=True):
            held.setdefault((shard, lang), []).append(data)
            size += len(data)
            if size >= most:
                yield [(s, name, b"\n".join([*parts, b""])) for (s, name), parts in held.items()]
                held, size = {}, 0
    if held:
        yield [(s, name, b"\n".join([*parts, b""])) for (s, name), parts in held.items()]


def _numbers(words: _Words, chunk: list[tuple[int, str, bytes]]):
    """(shard, lang, numbers of all words) of each part of a chunk; each distinct word is looked up once."""
    texts = [data.translate(_TABLE).replace(b".", b" . ") for _, _, data in chunk]
    split = pc.split_pattern(pa.array(texts, pa.large_binary()), b" ")
    coded = split.flatten().dictionary_encode()
    names = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
    own = np.fromiter(map(words.__getitem__, names), np.int64, len(names))
    numbers, ends = own[coded.indices.to_numpy()], split.offsets.to_numpy().tolist()
    blank = words.get(b"")
    for (shard, lang, _), a, b in zip(chunk, ends[:-1], ends[1:], strict=True):
        part = numbers[a:b]
        yield shard, lang, part if blank is None else part[part != blank]


def _phrase_hashes(words: _Words, numbers: np.ndarray, lang: str, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all phrases of ``size`` words, and their hashes."""
    inside = numbers != 0
    whole = inside[: len(numbers) - size + 1].copy()
    for k in range(1, size):
        whole &= inside[k : len(numbers) - size + 1 + k]
    starts = np.flatnonzero(whole)
    return starts, _hashes_at(words, numbers, lang, size, starts)


def _hashes_at(words: _Words, numbers: np.ndarray, lang: str, size: int, starts: np.ndarray) -> np.ndarray:
    import xxhash

    hashes = words.hashed()
    salt = np.uint64(xxhash.xxh3_64_intdigest(f"{size} {lang}".encode()))
    found = np.full(len(starts), salt, np.uint64)
    for k in range(size):
        found = _mixed(found * np.uint64(0x9E3779B97F4A7C15) + hashes[numbers[starts + k]])
    return found


def _marked(marks: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the top bits of each hash are marked."""
    bits = (8 * len(marks)).bit_length() - 1
    at = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    return (marks[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _candidates(words, numbers, lang, size, marks, below: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of phrases all of whose parts of ``below`` words are marked."""
    starts, hashes = _phrase_hashes(words, numbers, lang, below)
    fit = np.zeros(len(numbers) + size, dtype=bool)
    fit[starts[_marked(marks, hashes)]] = True
    whole = fit[: len(numbers)].copy()
    for k in range(1, size - below + 1):
        whole &= fit[k : len(numbers) + k]
    at = np.flatnonzero(whole)
    return at, _hashes_at(words, numbers, lang, size, at)


def _texts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """(shard, lang, text): equal texts are dealt by their rows, so copies do not meet in one shard."""
    name = F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(UNKNOWN_LANG))
    content = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    # Rows are dealt in turn; a shard may hold any rows, as long as each pass deals them alike.
    shard = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in _dealt(docs)]), F.lit(SHARDS)).cast("int")
    return docs.select(shard.alias("shard"), name.alias("lang"), content.alias("text"))


def _dealt(docs: DataFrame) -> list[str]:
    """Columns whose hash deals rows: those that can be hashed."""
    return [f.name for f in docs.schema if "map" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]


def _summed(batches, level, limits: tuple[int, int, int]):
    """Sums over what a task reads, packed by (shard, lang, bucket), given out whenever much is held."""
    most_bytes, most_held, most_words = limits
    words, held, size = _Words(), {}, 0
    for chunk in _chunks(batches, most_bytes):
        if len(words) > most_words:
            words = _Words()
        for shard, lang, numbers in _numbers(words, chunk):
            for hashes in level(words, numbers, lang):
                held.setdefault((shard, lang), []).append((hashes >> np.uint64(64 - HASH_BITS)).astype(np.uint32))
                size += len(hashes)
            if size >= most_held:
                yield from map(_packed, held, held.values())
                held, size = {}, 0
    yield from map(_packed, held, held.values())
    held.clear()
    # Workers are used again by other stages.
    del words
    common.give_back()


def _packed(key: tuple[int, str], parts: list[np.ndarray]) -> pa.RecordBatch:
    """A row for each bucket of hashes that occurs: its hashes and their counts."""
    hashes, counts = np.unique(np.concatenate(parts), return_counts=True)
    counts = counts.astype(np.uint32)
    bucket = hashes >> np.uint32(HASH_BITS - PACK_BITS)
    cuts = np.flatnonzero(np.concatenate((bucket[:1] >= 0, bucket[1:] != bucket[:-1])))
    rows = list(zip(cuts.tolist(), [*cuts[1:].tolist(), len(hashes)]))
    columns = [
        pa.array([key[0]] * len(rows), pa.int32()),
        pa.array([key[1]] * len(rows), pa.string()),
        pa.array(bucket[cuts].astype(np.int32)),
        pa.array([hashes[a:b].tobytes() for a, b in rows], pa.binary()),
        pa.array([counts[a:b].tobytes() for a, b in rows], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["shard", "lang", "bucket", "hashes", "counts"])


def _added(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes and the sums of their counts."""
    order = np.argsort(hashes, kind="stable")
    hashes, counts = hashes[order], counts[order]
    at = np.flatnonzero(np.concatenate((hashes[:1] >= 0, hashes[1:] != hashes[:-1])))
    return hashes[at], np.add.reduceat(counts, at)


def _merged(batches, most: int):
    """(shard, lang, further columns, hashes, sums of counts) for each (shard, lang, bucket) of sorted rows."""
    key, hashes, counts, size = None, [], [], 0
    known = np.empty(0, np.uint32), np.empty(0, np.int64)

    def all_so_far():
        more = np.frombuffer(b"".join(hashes), np.uint32), np.frombuffer(b"".join(counts), np.uint32).astype(np.int64)
        return _added(np.concatenate((known[0], more[0])), np.concatenate((known[1], more[1])))

    for batch in batches:
        columns = (column.to_numpy(zero_copy_only=False).tolist() for column in batch.columns)
        for shard, lang, bucket, some, times, *further in zip(*columns, strict=True):
            if key is None or key[:3] != (shard, lang, bucket):
                if key is not None:
                    yield key[0], key[1], key[3], *all_so_far()
                key, hashes, counts, size = (shard, lang, bucket, further), [], [], 0
                known = np.empty(0, np.uint32), np.empty(0, np.int64)
            hashes.append(some)
            counts.append(times)
            size += len(some) // 4
            if size >= most:
                known = all_so_far()
                hashes, counts, size = [], [], 0
    if key is not None:
        yield key[0], key[1], key[3], *all_so_far()


def _mine(texts: DataFrame, level, needed: DataFrame | None = None) -> DataFrame:
    """Packed rows of how often each hash that ``level`` gives occurs in each shard, those of one bucket together.

    (shard, lang, bucket, hashes, counts), several rows for a bucket, and the columns of ``needed``.
    """
    limits = (BYTES, HELD, WORDS)
    schema = "shard int, lang string, bucket int, hashes binary, counts binary"
    counted = texts.mapInArrow(lambda batches: _summed(batches, level, limits), schema)
    if needed is not None:
        counted = counted.join(needed, ["shard", "lang"])
    key = ["shard", "lang", "bucket"]
    return counted.repartition(*key).sortWithinPartitions(*key)


def _sums(mined: DataFrame) -> DataFrame:
    """(shard, lang, hashes, counts, total): the counts of each bucket added up, as 64-bit numbers, and their sum."""
    most = HELD

    def run(batches):
        for shard, lang, _, hashes, counts in _merged(batches, most):
            row = [[shard], [lang], [hashes.tobytes()], [counts.tobytes()], [int(counts.sum())]]
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, SUMS)], schema=SUMS)
        common.give_back()

    return mined.mapInArrow(run, "shard int, lang string, hashes binary, counts binary, total long")


def _frequent(hashes: np.ndarray, counts: np.ndarray, support: int, n_shard: int, n_all: int, shift: int) -> pa.RecordBatch:
    """The bits of hashes that reach their shard's part of the support, exactly."""
    found = hashes[counts >= -(-int(support) * int(n_shard) // int(n_all))]
    return pa.RecordBatch.from_arrays([pa.array(np.unique(found >> np.uint32(shift)).astype(np.int64))], names=["bit"])


def _bits_of_sums(sums: DataFrame, needed: DataFrame) -> DataFrame:
    """(bit) of the hashes of summed rows that reach their shard's support."""
    shift = HASH_BITS - BITS

    def run(batches):
        for batch in batches:
            columns = (column.to_numpy(zero_copy_only=False).tolist() for column in batch.columns)
            for hashes, counts, *limits in zip(*columns, strict=True):
                yield _frequent(np.frombuffer(hashes, np.uint32), np.frombuffer(counts, np.int64), *limits, shift)
        common.give_back()

    rows = sums.join(needed, ["shard", "lang"]).select("hashes", "counts", *LIMITS)
    return rows.mapInArrow(run, "bit long")


def _bits_of_mined(texts: DataFrame, level, needed: DataFrame) -> DataFrame:
    """(bit) of the hashes that ``level`` gives and that reach their shard's support; a task needs one Python worker."""
    shift, most = HASH_BITS - BITS, HELD

    def run(batches):
        for _, _, limits, hashes, counts in _merged(batches, most):
            yield _frequent(hashes, counts, *limits, shift)
        common.give_back()

    rows = _mine(texts, level, needed).select("shard", "lang", "bucket", "hashes", "counts", *LIMITS)
    return rows.mapInArrow(run, "bit long")


def _bitmap(frequent: DataFrame) -> np.ndarray:
    """The bitmap of (bit)."""
    bits = frequent.groupBy(F.expr(f"bit div {BUCKET}").alias("bucket"))
    found = bits.agg(F.bitmap_construct_agg(F.col("bit") % BUCKET).alias("bits"))
    marks = np.zeros(1 << BITS - 3, np.uint8)
    for bucket, part in found.toLocalIterator():
        at = bucket * BUCKET // 8
        marks[at : at + len(part)] = np.frombuffer(bytes(part), np.uint8)
    return marks


def frequent_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", support: int = SUPPORT, longest: int = LONGEST) -> DataFrame:
    """(lang, phrase, size, f, n): every phrase of 1 to ``longest`` words with at least ``support`` occurrences.

    ``n`` counts all words of the language. A null text is an empty one, a null language is
    ``und``. Repeated rows count each; an empty table, or texts without words, give no rows.
    Other columns of ``docs`` only help to deal rows to shards. ``docs`` is read once for each level and
    should be cheap to read.
    """
    spark = docs.sparkSession
    stage = common.staging(docs)
    texts = _texts(docs, text, lang)

    def each_word(words, numbers, name):
        yield _phrase_hashes(words, numbers, name, 1)[1]

    one = stage.table(_sums(_mine(texts, each_word)), "words")
    shards = stage.table(one.groupBy("shard", "lang").agg(F.sum("total").alias("n_shard")), "shards")
    totals = shards.groupBy("lang").agg(F.sum("n_shard").alias("n_all"))
    needed = shards.join(totals, "lang").withColumn("support", F.lit(support))
    needed = stage.table(needed, "needed")
    marks = {1: spark.sparkContext.broadcast(_bitmap(_bits_of_sums(one, needed)))}

    if longest > 1:

        def pairs(words, numbers, name):
            yield _candidates(words, numbers, name, 2, marks[1].value, 1)[1]

        marks[2] = spark.sparkContext.broadcast(_bitmap(_bits_of_mined(texts, pairs, needed)))
    if longest > 2:

        def longer(words, numbers, name):
            for size in range(3, longest + 1):
                yield _candidates(words, numbers, name, size, marks[2].value, 2)[1]

        marks[3] = spark.sparkContext.broadcast(_bitmap(_bits_of_mined(texts, longer, needed)))

    # Here a phrase is held as the numbers of its words.
    most_bytes, most_held, most_words = BYTES, HELD // longest, WORDS

    def count(batches):
        words, held, size = _Words(), {}, 0

        def out():
            names = np.array(words.names, dtype=object)
            for (name, length), parts in held.items():
                rows, counts = _unique_rows(np.concatenate(parts))
                for a in range(0, len(rows), ROWS):
                    part = names[rows[a : a + ROWS]]
                    phrases = part[:, 0]
                    for k in range(1, length):
                        phrases = phrases + b" " + part[:, k]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([name] * len(part), pa.string()),
                            pa.array(phrases, pa.binary()).cast(pa.string()),
                            pa.array(np.full(len(part), length, np.int32)),
                            pa.array(counts[a : a + ROWS]),
                        ],
                        names=["lang", "phrase", "size", "f"],
                    )

        for chunk in _chunks(batches, most_bytes):
            if len(words) > most_words or size >= most_held:
                yield from out()
                words, held, size = _Words() if len(words) > most_words else words, {}, 0
            for _, name, numbers in _numbers(words, chunk):
                for length in range(1, longest + 1):
                    if length == 1:
                        starts, hashes = _phrase_hashes(words, numbers, name, 1)
                    else:
                        below = min(length, 3) - 1
                        starts, hashes = _candidates(words, numbers, name, length, marks[below].value, below)
                    starts = starts[_marked(marks[min(length, 3)].value, hashes)]
                    if len(starts):
                        rows = np.stack([numbers[starts + k] for k in range(length)], axis=1).astype(np.int32)
                        held.setdefault((name, length), []).append(rows)
                        size += len(starts)
        yield from out()
        del words
        held.clear()
        common.give_back()

    counted = texts.mapInArrow(count, "lang string, phrase string, size int, f long")
    exact = counted.groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f")).where(F.col("f") >= support)
    found = stage.table(exact, "frequent")
    return found.join(totals.withColumnRenamed("n_all", "n"), "lang")


def _unique_rows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of small numbers, and how often each occurs."""
    order = np.lexsort(rows.T[::-1])
    rows = rows[order]
    new = np.concatenate(([True], (rows[1:] != rows[:-1]).any(axis=1)))
    at = np.flatnonzero(new)
    return rows[at], np.diff(np.append(at, len(rows)))


def _part(start: int | Column, size: int | Column) -> Column:
    return F.array_join(F.slice("words", start, size), " ")


def scored(frequent: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of every phrase of two words or more, by its lowest cut."""
    known = frequent.select("lang", "phrase", "f")
    phrases = frequent.where("size > 1").select("lang", "phrase", "size", "n", F.col("f").alias("a"), F.split("phrase", " ").alias("words"))
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.withColumn("first", _part(F.lit(1), F.col("k"))).withColumn("rest", _part(F.col("k") + 1, F.col("size") - F.col("k")))
    cuts = cuts.drop("words", "size")
    cuts = cuts.join(known.toDF("lang", "first", "l"), ["lang", "first"]).join(known.toDF("lang", "rest", "r"), ["lang", "rest"])
    wide = "decimal(20,0)"
    score = F.expr(f"({SCALE} * cast(a AS {wide})) div (cast(l AS {wide}) + cast(r AS {wide}))").cast("long")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    best = cuts.groupBy("lang", "phrase", "a", "n").agg(lowest)
    return best.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def covered(frequent: DataFrame, hundredths: int = COVERED) -> DataFrame:
    """(lang, phrase) of phrases that mostly occur inside a longer frequent one."""
    longer = frequent.where("size > 2").select("lang", "size", "f", F.split("phrase", " ").alias("words"))
    sizes = longer.withColumn("m", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
    starts = sizes.withColumn("s", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1)))
    inner = starts.select("lang", _part(F.col("s"), F.col("m")).alias("phrase"), "f")
    most = inner.groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    wide = "decimal(20,0)"
    held = F.col("most").cast(wide) * 100 >= F.col("f").cast(wide) * hundredths
    return frequent.join(most, ["lang", "phrase"]).where(held).select("lang", "phrase")


def ranked(found: DataFrame, first: int = FIRST, salts: int = 64) -> DataFrame:
    """The ``first`` rows of each language by score, occurrences and phrase, with their rank from 1.

    Rows are cut to ``first`` within parts of a language before they meet.
    """
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    part = Window.partitionBy("lang", "_part").orderBy(*order)
    parts = found.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(salts)))
    kept = parts.withColumn("_rank", F.row_number().over(part)).where(F.col("_rank") <= first).drop("_part", "_rank")
    whole = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return whole.where(F.col("rank") <= first)


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", support: int = SUPPORT, first: int = FIRST) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the strongest phrases of each language."""
    frequent = frequent_phrases(docs, text, lang, support)
    found = scored(frequent).join(covered(frequent), ["lang", "phrase"], "left_anti")
    return ranked(found, first).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
