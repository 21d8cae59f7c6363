"""Token ids of all documents in compressed binary files, and back.

Documents are sorted by id, encoded with a public tokenizer and gathered into segments.
Global counts of all ids give one canonical length-limited Huffman code. Every
segment is written as one record of the file format: a header, the ids and lengths
of its documents, bit-offset checkpoints of its blocks, the coded ids and a
checksum. Blocks decode independently by table look-ups.

Segments are Spark rows: a task encodes or decodes one at a time, and nothing but the counts per
vocabulary entry and the code lengths, both bounded by the vocabulary, reaches the driver.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mapweave.llm import binary_files, common
from mapweave.llm.huffman import Coder, code_lengths

END_ID = 2
BLOCK = 256
SEGMENT_TOKENS = 1 << 19
SEGMENTS_PER_FILE = 32
# Bytes that a worker remembers of pieces of text and their ids.
REMEMBERED = 32 << 20
# Texts taken at a time, and about how many of their characters are encoded at a time.
TEXTS, CHARACTERS = 4096, 4 << 20
# Fixed values of the file format.
MAGIC = b"HTOK\x01"
HEADER = struct.Struct("<5sIIIQIIQ")
# A blank after which no word begins, and a line break that stands alone between words.
ODD = re.compile(r" (?=\s|$)")
BREAK = re.compile(r"\n(?<=\S\n)(?=\S)")
# Marks that end a word wherever they follow a letter; an apostrophe may go on.
TAIL = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'")
# Letters below this have been letters in every version of Unicode.
SETTLED = "\u0370"
WORD = r"\A\n?[%s]+\z" % "".join(filter(str.isalpha, map(chr, range(ord(SETTLED)))))


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class WordEncoder:
    """Encodes texts with a tokenizer, each distinct piece of text once as far as it is remembered.

    A byte-level tokenizer that splits words by its pattern starts a new word at every blank
    before a visible character, whatever stands on either side, and takes a line break between
    two visible characters as a word. Cut there, a text has the ids of its pieces. A piece of
    letters with marks behind them is cut once more, and its letters, one word for the
    tokenizer, go to the tokenizer's model alone, which takes a third of the time. Other
    tokenizers encode whole texts.
    """

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.kind, self.code = ("<u2", "H") if vocabulary_size(spec) <= 1 << 16 else ("<u4", "I")
        told = json.loads(spec)
        pre = told.get("pre_tokenizer") or {}
        self.by_piece = (
            told.get("normalizer") is None
            and pre.get("type") == "ByteLevel"
            and pre.get("use_regex", True)
            and not pre.get("add_prefix_space", True)
            and all(
                not re.search(r"\s", t["content"]) and not t.get("lstrip") and not t.get("rstrip")
                and re.search(r"[^\w\s].*\w", t["content"])
                for t in told.get("added_tokens", [])
            )
        )
        if self.by_piece:
            self.model = self.tokenizer.model
            self.letters = byte_letters()
            self.line_break = self.tokenizer.encode("\n", add_special_tokens=False).ids
            # Pieces after a blank, and their ids; those that begin with a line break have no blank.
            self.forget()

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [array(self.code, e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _word_ids(self, words: list[str]) -> "Pool":
        """Ids of a blank, or a line break, and a word of letters each."""
        tokenize, blank = self.model.tokenize, self.letters[32]
        # Words have no zero byte.
        spelled = "\0".join([w[1:] if w[0] == "\n" else w for w in words]).encode().decode("latin-1")
        spelled = spelled.translate(self.letters | {0: "\0"}).split("\0") if words else []
        ids, sizes = array(self.code), []
        for w, letters in zip(words, spelled, strict=True):
            broken = w[0] == "\n"
            found = [t.id for t in tokenize(letters if broken else blank + letters)]
            if broken:
                found[:0] = self.line_break
            ids.extend(found)
            sizes.append(len(found))
        return Pool(np.array(ids, self.kind), np.array(sizes, np.int64))

    def held(self) -> int:
        """Bytes of what is remembered."""
        return self.known.nbytes + self.pool.ids.nbytes + self.pool.sizes.nbytes if self.by_piece else 0

    def forget(self) -> None:
        self.known, self.pool = pa.array([], pa.string()), Pool.of([], self.kind)

    def _learn(self, pieces: pa.Array, is_word: np.ndarray) -> np.ndarray:
        """Places in the pool of the ids of distinct pieces after a blank; those marked are words of letters."""
        # The smaller table is the one looked into.
        at = pc.index_in(self.known, value_set=pieces)
        met = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
        places = np.full(len(pieces), -1, np.int64)
        places[at.drop_null().to_numpy()] = met
        if self.held() > REMEMBERED:
            # The pieces that are met now stay in reach.
            self.known, self.pool = self.known.take(pa.array(met)), self.pool.taken(met)
            places[at.drop_null().to_numpy()] = np.arange(len(met))
        new = np.flatnonzero(places < 0)
        words, other = new[is_word[new]], new[~is_word[new]]
        new = np.concatenate((words, other))
        places[new] = len(self.known) + np.arange(len(new))
        learned = pieces.take(pa.array(new))
        texts = strings(learned)
        more = self._ids([p if p[:1] == "\n" else " " + p for p in texts[len(words) :]])
        self.known = pa.concat_arrays([self.known, learned])
        self.pool = self.pool.joined(self._word_ids(texts[: len(words)]), Pool.of(more, self.kind))
        return places

    def _pieces_ids(self, pieces: pa.Array) -> "Pool":
        """Ids of distinct pieces after a blank."""
        cores = pc.utf8_rtrim(pieces, TAIL)
        is_word = pc.match_substring_regex(cores, WORD)
        keys = pc.if_else(is_word, cores, pieces).dictionary_encode()
        key, is_word = keys.indices.to_numpy(), is_word.to_numpy(zero_copy_only=False)
        of_words = np.zeros(len(keys.dictionary), bool)
        of_words[key] = is_word
        # Marks behind a word are single bytes.
        marks = (pc.binary_length(pieces).to_numpy() - pc.binary_length(cores).to_numpy()) * is_word
        tailed = np.flatnonzero(marks)
        whole = strings(pieces.take(pa.array(tailed)))
        ends = pa.array([p[-n:] for p, n in zip(whole, marks[tailed].tolist(), strict=True)], pa.string()).dictionary_encode()
        heads = self._learn(keys.dictionary, of_words)
        pool = self.pool.joined(Pool.of([*self._ids(strings(ends.dictionary)), b""], self.kind))
        parts = np.empty((len(pieces), 2), np.int64)
        parts[:, 0], parts[:, 1] = heads[key], len(pool.sizes) - 1
        parts[tailed, 1] = len(self.pool.sizes) + ends.indices.to_numpy()
        return Pool(pool.laid(parts.reshape(-1)), pool.sizes[parts].sum(axis=1))

    @staticmethod
    def pieces(text: str) -> list[str]:
        """The first piece, then those after each cut: with their line break, or without their blank."""
        if not ODD.search(text):
            # Behind a blank there is no line break yet, so that these tell the new cuts.
            return (BREAK.sub(" \n", text) if "\n" in text else text).split(" ")
        joined: list[str] = []
        for part in text.split(" "):
            if joined and not (part and not part[0].isspace()):
                joined[-1] += " " + part
            else:
                joined.append(part)
        cut = []
        for part in joined:
            head, *rest = BREAK.split(part)
            cut.append(head)
            cut.extend(["\n" + p for p in rest])
        return cut

    def encode(self, texts: list[str | None]) -> list[bytes]:
        texts = [t or "" for t in texts]
        if not self.by_piece:
            return self._ids(texts)
        found, begin, size = [], 0, 0
        for end, text in enumerate(texts, 1):
            size += len(text)
            if size >= CHARACTERS or end == len(texts):
                found += self._encoded(texts[begin:end])
                begin, size = end, 0
        return found

    def _encoded(self, texts: list[str]) -> list[bytes]:
        """Ids of some texts: all their pieces are told apart side by side."""
        first, rest, cut, odd = [], [], [], []
        for number, text in enumerate(texts):
            if ODD.search(text):
                head, *parts = self.pieces(text)
                odd.append(number)
                cut.append(parts)
                rest.append(None)
            else:
                # Behind a blank there is no line break yet, so that these tell the new cuts.
                head, blank, tail = (BREAK.sub(" \n", text) if "\n" in text else text).partition(" ")
                rest.append(tail if blank else None)
            first.append(head)
        split = pc.split_pattern(pa.array(rest, pa.string()), " ")
        count = pc.list_value_length(split).fill_null(0).to_numpy().astype(np.int64)
        pieces = pa.concat_arrays([split.flatten(), pa.array([p for parts in cut for p in parts], pa.string())])
        # Texts with odd blanks stand behind the others here.
        order = np.concatenate((np.setdiff1d(np.arange(len(texts)), odd), np.array(odd, np.int64))).astype(np.int64)
        count[odd] = [len(parts) for parts in cut]
        count = count[order]
        coded = pieces.dictionary_encode()
        known = self._pieces_ids(coded.dictionary)
        pool = known.joined(Pool.of(self._ids([first[i] for i in order.tolist()]), self.kind))
        places = np.empty(len(pieces) + len(texts), np.int64)
        starts = np.cumsum(count + 1) - (count + 1)
        behind = np.ones(len(places), bool)
        behind[starts] = False
        places[starts] = len(known.sizes) + np.arange(len(texts))
        places[behind] = coded.indices.to_numpy()
        ids = pool.laid(places)
        ends = np.cumsum(np.add.reduceat(pool.sizes[places], starts)) if len(texts) else starts
        out = [b""] * len(texts)
        for number, a, b in zip(order.tolist(), [0, *ends[:-1].tolist()], ends.tolist(), strict=True):
            out[number] = ids[a:b].tobytes()
        return out


class Pool:
    """Runs of ids behind each other, and the length of each run."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray):
        self.ids, self.sizes = ids, sizes

    @classmethod
    def of(cls, runs: list[bytes], kind: str) -> "Pool":
        ids = np.frombuffer(b"".join(runs), kind)
        return cls(ids, np.fromiter(map(len, runs), np.int64, len(runs)) // ids.itemsize)

    def joined(self, *others: "Pool") -> "Pool":
        pools = [self, *others]
        return Pool(np.concatenate([p.ids for p in pools]), np.concatenate([p.sizes for p in pools]))

    def taken(self, runs: np.ndarray) -> "Pool":
        return Pool(self.laid(runs), self.sizes[runs])

    def laid(self, runs: np.ndarray) -> np.ndarray:
        """The ids of runs, in the order given."""
        sizes = self.sizes[runs]
        ends = np.cumsum(sizes)
        shift = (np.cumsum(self.sizes) - self.sizes)[runs] - (ends - sizes)
        at = np.repeat(shift, sizes)
        at += np.arange(len(at))
        return self.ids[at]


@lru_cache(maxsize=1)
def encoder_for(spec: str) -> WordEncoder:
    """One encoder for all tasks of a worker, with what it remembers."""
    return WordEncoder(spec)


def strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


def byte_letters() -> dict[int, str]:
    """The visible character that byte-level tokenizers write for each byte.

    Visible Latin-1 characters stand for themselves, the others in turn for the
    characters from 256 on.
    """
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def vocabulary_size(spec: str) -> int:
    told = json.loads(spec)
    ids = [*told["model"]["vocab"].values(), *(t["id"] for t in told.get("added_tokens", []))]
    return max(ids) + 1


def token_segments(docs: DataFrame, spec: str, doc_id: str, text: str, end_id: int) -> DataFrame:
    """(file, segment, doc_ids, lengths, ids): documents in id order, cut into segments.

    Documents are never split. A range of ids is one file; equal ids order by a
    hash of their texts, and many rows of one id are spread over several ranges.
    """
    rows = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text")
    ).withColumns({"_hash": F.xxhash64("text"), "_row": F.monotonically_increasing_id()})
    key = ["doc_id", "_hash", "_row"]
    ordered = rows.repartitionByRange(*key).sortWithinPartitions(*key)
    shared = docs.sparkSession.sparkContext.broadcast(spec)
    names = ["file", "segment", "doc_ids", "lengths", "ids"]

    def run(batches):
        encoder = encoder_for(shared.value)
        end = np.array([end_id], dtype=encoder.kind).tobytes()
        segment, held, file, size = 0, [], 0, 0

        def packed():
            ids = b"".join(x for _, x in held)
            width = len(end)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([file], pa.int32()),
                    pa.array([segment], pa.int32()),
                    pa.array([[d for d, _ in held]], pa.list_(pa.int64())),
                    pa.array([[len(x) // width for _, x in held]], pa.list_(pa.int32())),
                    pa.array([ids], pa.binary()),
                ],
                names=names,
            )

        for batch in batches:
            for start in range(0, batch.num_rows, TEXTS):
                part = batch.slice(start, TEXTS)
                file = part.column(2)[0].as_py()
                coded = encoder.encode(part.column(1).to_pylist())
                for name, ids in zip(part.column(0).to_pylist(), coded, strict=True):
                    held.append((name, ids + end))
                    size += len(ids) // len(end) + 1
                    if size >= SEGMENT_TOKENS:
                        yield packed()
                        segment, held, size = segment + 1, [], 0
        if held:
            yield packed()
        held.clear()
        # Workers are used again by other stages.
        if encoder.held() > REMEMBERED:
            encoder.forget()
        common.give_back()

    schema = "file int, segment int, doc_ids array<long>, lengths array<int>, ids binary"
    return ordered.select("doc_id", "text", F.spark_partition_id().alias("file")).mapInArrow(run, schema)


def id_counts(segments: DataFrame, kind: str, size: int) -> np.ndarray:
    """How often each id occurs in all segments; one row per id reaches the driver."""

    def run(batches):
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for ids in batch.column(0):
                total += np.bincount(np.frombuffer(ids.as_buffer(), kind), minlength=size)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["id", "n"])

    sums = segments.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    counts = np.zeros(size, dtype=np.int64)
    for id_, n in sums.collect():
        counts[id_] = n
    return counts


def segment_bytes(coder: Coder, file: int, segment: int, doc_ids: list, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """One record of the format; its last byte is zero."""
    payload, offsets = coder.encode(ids, BLOCK)
    nulls = np.packbits(np.array([d is None for d in doc_ids], dtype=bool)).tobytes()
    names = np.array([d or 0 for d in doc_ids], dtype="<i8").tobytes()
    head = HEADER.pack(MAGIC, file, segment, len(doc_ids), len(ids), BLOCK, len(offsets), len(payload))
    body = b"".join((head, nulls, names, lengths.astype("<u4").tobytes(), offsets.astype("<u8").tobytes(), payload))
    return body + struct.pack("<I", zlib.crc32(body)) + binary_files.END


def read_segments(coder: Coder, data: bytes):
    """(file, segment, doc ids, lengths, ids) of each record of a file, checked."""
    at, view = 0, memoryview(data)
    while at < len(view):
        magic, file, segment, docs, tokens, block, blocks, payload = HEADER.unpack_from(view, at)
        if magic != MAGIC:
            raise ValueError("no token segment where one should begin")
        sizes = [-(-docs // 8), 8 * docs, 4 * docs, 8 * blocks, payload]
        cuts = np.cumsum([at + HEADER.size, *sizes]).tolist()
        nulls, names, lengths, offsets, coded = (bytes(view[a:b]) for a, b in zip(cuts, cuts[1:]))
        if struct.unpack_from("<I", view, cuts[-1])[0] != zlib.crc32(view[at : cuts[-1]]):
            raise ValueError(f"the checksum of segment {segment} of file {file} does not fit")
        missing = np.unpackbits(np.frombuffer(nulls, np.uint8), count=docs)
        ids = [None if m else d for d, m in zip(np.frombuffer(names, "<i8").tolist(), missing.tolist(), strict=True)]
        symbols = coder.decode(coded, np.frombuffer(offsets, "<u8"), tokens, block)
        yield file, segment, ids, np.frombuffer(lengths, "<u4"), symbols
        at = cuts[-1] + 5


def write_tokens(
    docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None, end_id: int = END_ID
) -> None:
    """Write the ids of every whole text, each followed by ``end_id``, under ``path``.

    ``path/ids`` holds the segments and ``path/code`` one record with the code length of
    each id. A null text is an empty one. Null ids come first; rows of one id each
    give a document. No documents give no segments. ``tokenizer`` is a file in the
    format of the tokenizers library.
    """
    with open(tokenizer or default_tokenizer(), encoding="utf-8") as file:
        spec = file.read()
    size = max(vocabulary_size(spec), end_id + 1)
    kind = "<u2" if vocabulary_size(spec) <= 1 << 16 else "<u4"
    stage = common.staging(docs)
    segments = stage.table(token_segments(docs, spec, doc_id, text, end_id), "token_segments")
    lengths = code_lengths(id_counts(segments, kind, size))
    shared = docs.sparkSession.sparkContext.broadcast(Coder(lengths))

    def run(batches):
        for batch in batches:
            columns = zip(*(batch.column(i) for i in range(5)), strict=True)
            for file, segment, doc_ids, counts, ids in columns:
                record = segment_bytes(
                    shared.value, file.as_py(), segment.as_py(), doc_ids.as_py(),
                    np.array(counts.as_py()), np.frombuffer(ids.as_buffer(), kind).astype(np.int64),
                )
                yield pa.RecordBatch.from_arrays([pa.array([record[:-1]], pa.binary())], names=["record"])
        common.give_back()

    binary_files.write_records(segments.mapInArrow(run, "record binary"), "record", f"{path}/ids", SEGMENTS_PER_FILE)
    stage.remove()
    book = docs.sparkSession.createDataFrame([(bytearray(lengths.tobytes()),)], "record binary")
    binary_files.write_records(book, "record", f"{path}/code", 1)


def read_code(spark: SparkSession, path: str) -> Coder:
    """The code of a written folder: one byte per vocabulary entry."""
    files = [bytes(r[1]) for r in binary_files.read_files(spark, f"{path}/code").collect()]
    return Coder(np.frombuffer(max(files, key=len)[:-1], np.uint8))


def read_tokens(spark: SparkSession, path: str, keep_ids: bool = False) -> DataFrame:
    """One row per document: doc_id, start, n_tokens, ids_crc32, and ids if asked for.

    ``start`` counts the ids of all documents before it in the order of the files,
    ``n_tokens`` its own with the end id, and the checksum is that of all those as
    little-endian unsigned 32-bit integers.
    """
    shared = spark.sparkContext.broadcast(read_code(spark, path))
    names = ["file", "segment", "within", "doc_id", "n_tokens", "ids_crc32", "ids"]

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                for file, segment, doc_ids, lengths, ids in read_segments(shared.value, content.as_py()):
                    raw = ids.astype("<u4")
                    ends = np.cumsum(lengths.astype(np.int64))
                    starts = ends - lengths
                    parts = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(parts), file), pa.int32()),
                            pa.array(np.full(len(parts), segment), pa.int32()),
                            pa.array(starts, pa.int64()),
                            pa.array(doc_ids, pa.int64()),
                            pa.array(lengths, pa.int64()),
                            pa.array([zlib.crc32(p.tobytes()) for p in parts], pa.int64()),
                            pa.array([p.astype(np.int64) if keep_ids else None for p in parts], pa.list_(pa.int64())),
                        ],
                        names=names,
                    )
        common.give_back()

    schema = "file int, segment int, within long, doc_id long, n_tokens long, ids_crc32 long, ids array<long>"
    stage = common.staging(binary_files.read_files(spark, f"{path}/ids"))
    rows = binary_files.read_files(spark, f"{path}/ids").select("content").mapInArrow(run, schema)
    rows = stage.table(rows, "token_rows")
    segments = rows.groupBy("file", "segment").agg(F.sum("n_tokens").alias("_tokens"))
    files = segments.groupBy("file").agg(F.sum("_tokens").alias("_tokens"))
    ahead = [Window.unboundedPreceding, -1]
    files = files.select(
        "file", F.coalesce(F.sum("_tokens").over(Window.orderBy("file").rowsBetween(*ahead)), F.lit(0)).alias("_file")
    )
    inside = Window.partitionBy("file").orderBy("segment").rowsBetween(*ahead)
    starts = segments.select("file", "segment", F.coalesce(F.sum("_tokens").over(inside), F.lit(0)).alias("_segment"))
    start = F.col("_file") + F.col("_segment") + F.col("within")
    columns = ["doc_id", start.alias("start"), "n_tokens", "ids_crc32"] + ["ids"] * keep_ids
    return rows.join(starts.join(files, "file"), ["file", "segment"]).select(*columns)
