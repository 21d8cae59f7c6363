"""Spelling variants: words one edit apart, the form each leads to, and its root.

The vocabulary's minimised acceptor is composed with a transducer that makes exactly one edit and
with the acceptor again; what the composition accepts are the near pairs. It is enumerated
partition by partition. Words one edit apart share what stands before the edit and what stands
behind it, so a partition holds the words of one length and the next that begin in the state
of one prefix and end alike: the first half of the shorter length when the edit lies behind
it, else the last half. Partitions above a limit are halved again, until one free
character is left, where the alphabet bounds them. Every pair is accepted in one partition, told by
the first character at which its words differ.
"""

from __future__ import annotations

import string
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapweave.llm import common

# Fixed by the contract of the query: letters, the least length and count of a word, how many
# times as often a form must occur, and one in how many occurrences loses a character.
RUN = "[A-Za-zÀ-ÿ]"
LENGTH, OCCURRENCES, TIMES, LOSES = 6, 5, 5, 199
# Words of a partition above which it is halved.
PARTITION = 1000
KEY = ["size", "left", "right", "until", "head", "tail"]


def vocabulary(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = LENGTH, least: int = OCCURRENCES) -> DataFrame:
    """(word, n): words of at least ``length`` letters that occur ``least`` times or more.

    A word is a maximal run of letters, of which only A-Z are lower-cased. Where 199 divides the
    crc32 of ``<doc_id>:<word>``, the word loses the letter at the remainder by its
    length. A null text has no words, a null id counts as empty text, rows that repeat count
    each, and an empty table has no words.
    """
    found = F.explode(F.regexp_extract_all(F.col(f"`{text}`").cast("string"), F.lit(f"{RUN}{{{length},}}+"), F.lit(0)))
    name = F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))
    rows = docs.select(name.alias("doc"), found.alias("run"))
    rows = rows.withColumn("run", F.translate("run", string.ascii_uppercase, string.ascii_lowercase))
    rows = rows.withColumn("h", F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = rows.select(F.when(F.col("h") % LOSES == 0, shorter).otherwise(F.col("run")).alias("word"))
    counted = words.where(F.length("word") >= length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= least)


def _halves(rows: DataFrame) -> DataFrame:
    """Each partition in two: its words share half of the free letters before the edit, or those behind."""
    half = F.expr("(size - left - right) div 2").cast("int")
    before = F.struct((F.col("left") + half).alias("left"), F.col("right").alias("right"), F.col("until").alias("until"))
    behind = F.struct(
        F.col("left").alias("left"), (F.col("size") - F.col("left") - half).alias("right"), (F.col("left") + half).alias("until")
    )
    # One free letter or none cannot be halved.
    parts = F.when(half > 0, F.array(before, behind)).otherwise(F.array(before))
    split = rows.select("word", "n", "size", F.explode(parts).alias("part"))
    return _keyed(split.select("word", "n", "size", "part.*"))


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {
            "head": F.substring("word", F.lit(1), F.col("left")),
            "tail": F.substring("word", F.length("word") - F.col("right") + 1, F.col("right")),
        }
    )


def partitions(words: DataFrame, limit: int = PARTITION) -> DataFrame:
    """(word, n, size, left, right, until, head, tail): every word in each partition that may pair it.

    A partition has words of ``size`` and ``size + 1`` letters that share the first ``left`` and last
    ``right``; it accepts pairs that differ before ``until`` (0: anywhere).
    """
    stage = common.staging(words)
    length = F.length("word")
    sizes = F.explode(F.array(length, length - 1)).alias("size")
    rows = words.select("word", "n", sizes).withColumns({"left": F.lit(0), "right": F.lit(0), "until": F.lit(0)})
    rows, done = stage.cut(_halves(rows)), []
    while True:
        large = rows.where("size - left - right > 1").groupBy(*KEY).agg(F.count(F.lit(1)).alias("rows"))
        large = stage.cut(large.where(F.col("rows") > limit).drop("rows"))
        if large.isEmpty():
            break
        done.append(rows.join(large, KEY, "left_anti"))
        rows = stage.cut(_halves(rows.join(large, KEY, "left_semi")))
    for part in done:
        rows = rows.unionByName(part)
    return rows


class _Acceptor:
    """A minimised acyclic acceptor of words of one length; several share their states."""

    def __init__(self):
        self.known: dict[tuple, int] = {}
        self.moves: list[dict[str, int]] = []
        self.tails: dict[tuple[int, int], list[str]] = {}

    def _state(self, moves: dict[str, int]) -> int:
        key = tuple(moves.items())
        if key not in self.known:
            self.known[key] = len(self.moves)
            self.moves.append(moves)
        return self.known[key]

    def add(self, words: list[str]) -> int:
        """The first state of an acceptor of sorted words."""
        path, last = [{}], ""
        for word in words:
            same = 0
            while same < len(last) and word[same] == last[same]:
                same += 1
            self._close(path, last, same)
            path.extend({} for _ in word[same:])
            last = word
        self._close(path, last, 0)
        return self._state(path[0])

    def _close(self, path: list[dict], word: str, depth: int) -> None:
        for at in range(len(word), depth, -1):
            path[at - 1][word[at - 1]] = self._state(path.pop())

    def common(self, one: int, two: int) -> list[str]:
        """What both states accept."""
        key = (one, two) if one < two else (two, one)
        found = self.tails.get(key)
        if found is None:
            found, open_ = [], [(one, two, "")]
            while open_:
                p, q, head = open_.pop()
                here, there = self.moves[p], self.moves[q]
                if not here and not there:
                    found.append(head)
                elif p == q:
                    open_.extend((s, s, head + c) for c, s in here.items())
                else:
                    open_.extend((s, there[c], head + c) for c, s in here.items() if c in there)
            self.tails[key] = found
        return found

    def replaced(self, first: int) -> Iterator[tuple[str, str]]:
        """Accepted pairs with one letter in place of another."""
        open_ = [(first, "")]
        while open_:
            state, head = open_.pop()
            moves = list(self.moves[state].items())
            for i, (c, one) in enumerate(moves):
                for d, two in moves[i + 1 :]:
                    for tail in self.common(one, two):
                        yield head + c + tail, head + d + tail
                open_.append((one, head + c))

    def inserted(self, short: int, long: int) -> Iterator[tuple[str, str]]:
        """Accepted pairs whose second word has one letter more; the last place where it may stand."""
        open_ = [(short, long, "")]
        while open_:
            p, q, head = open_.pop()
            here = self.moves[p]
            for c, two in self.moves[q].items():
                for tail in self.common(p, two):
                    if not tail.startswith(c):
                        yield head + tail, head + c + tail
                if c in here:
                    open_.append((here[c], two, head + c))


def near_in(words: list[str], size: int, left: int, right: int, until: int) -> Iterator[tuple[str, str]]:
    """The near pairs of one partition, each once."""
    if len(words) < 2:
        return
    lowest, highest = min(words), max(words)
    # What all words share in front is left out; the rest of the free letters stays.
    while left < size - right and lowest[left] == highest[left]:
        left += 1
    inner: dict[bool, dict[str, str]] = {False: {}, True: {}}
    for word in words:
        inner[len(word) > size][word[left : len(word) - right]] = word
    acceptor = _Acceptor()
    short = acceptor.add(sorted(inner[False]))
    pairs: list[tuple[Iterable, bool]] = [(acceptor.replaced(short), False)]
    if inner[False] and inner[True]:
        pairs.append((acceptor.inserted(short, acceptor.add(sorted(inner[True]))), True))
    for found, longer in pairs:
        for u, v in found:
            one, two = inner[False][u], inner[longer][v]
            if not until or one[:until] != two[:until]:
                yield one, two


def _each_partition(batches) -> Iterator[tuple[tuple, dict[str, int]]]:
    """(key, words with counts) of partitions that come one after another."""
    key, words = None, {}
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(8)]
        for word, n, *at in zip(*columns, strict=True):
            if at != key:
                if len(words) > 1:
                    yield tuple(key), words
                key, words = at, {}
            words[word] = n
    if len(words) > 1:
        yield tuple(key), words


def _by_partition(words: DataFrame, limit: int, run, schema: str) -> DataFrame:
    rows = partitions(words, limit).select("word", "n", *KEY)
    placed = rows.repartition(F.xxhash64(*KEY)).sortWithinPartitions(*KEY)
    return placed.mapInArrow(run, schema)


def near_pairs(words: DataFrame, limit: int = PARTITION) -> DataFrame:
    """(word, near, near_n): every two words exactly one edit apart, both ways round.

    ``words`` has distinct words and their counts ``n``; an empty table gives no pairs.
    """

    def run(batches):
        for key, found in _each_partition(batches):
            pairs = list(near_in(list(found), *key[:4]))
            if pairs:
                one, two = ([p[i] for p in pairs] + [p[1 - i] for p in pairs] for i in (0, 1))
                yield pa.RecordBatch.from_pydict({"word": one, "near": two, "near_n": [found[w] for w in two]})

    return _by_partition(words, limit, run, "word string, near string, near_n long")


def nearest(words: DataFrame, limit: int = PARTITION) -> DataFrame:
    """(word, n_near, best_n, best): how many words are near, and the most frequent, the first of equals.

    Pairs are summed up where they are found, so that one row a word and partition is shuffled.
    """

    def run(batches):
        held = {"word": [], "n_near": [], "rank": [], "best": []}
        for key, found in _each_partition(batches):
            seen: dict[str, list] = {}
            for one, two in near_in(list(found), *key[:4]):
                for word, near in ((one, two), (two, one)):
                    best = (-found[near], near)
                    told = seen.setdefault(word, [0, best])
                    told[0] += 1
                    told[1] = min(told[1], best)
            for word, (count, (rank, best)) in seen.items():
                for column, value in zip(held.values(), (word, count, rank, best), strict=True):
                    column.append(value)
            if len(held["word"]) >= 10_000:
                yield pa.RecordBatch.from_pydict(held)
                held = {column: [] for column in held}
        if held["word"]:
            yield pa.RecordBatch.from_pydict(held)

    found = _by_partition(words, limit, run, "word string, n_near long, rank long, best string")
    summed = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct("rank", "best")).alias("b"))
    return summed.select("word", "n_near", (-F.col("b.rank")).alias("best_n"), F.col("b.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): where the forms of each word end. ``forms`` has a row (word, form) a word.

    Forms lead to ever more frequent words, so they have no circles; steps double in each round.
    """
    stage = common.staging(forms)
    reached = stage.cut(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = reached.toDF("root", "next")
        moved = stage.cut(reached.join(ahead, "root", "left").select("word", "root", "next"))
        if moved.where("next IS NOT NULL").isEmpty():
            return moved.select("word", "root")
        reached = moved.select("word", F.coalesce("next", "root").alias("root"))


def variants(words: DataFrame, times: int = TIMES, limit: int = PARTITION) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of a vocabulary (word, n).

    The form is the near word of largest count, the first of equals, if that is at least
    ``times`` the word's; the root is where forms end, the word itself if it has none.
    """
    stage = common.staging(words)
    words = stage.table(words.select("word", "n"), "vocabulary")
    found = words.join(nearest(words, limit), "word", "left")
    leads = F.col("best_n") >= times * F.col("n")
    told = found.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(leads, F.col("best")).alias("form"),
        F.when(leads, F.col("best_n")).alias("form_n"),
    )
    told = stage.table(told, "forms")
    ends = roots(told.where("form IS NOT NULL").select("word", "form"))
    whole = told.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
    return whole.select("word", "form", "root", "n", "n_near", "form_n")
