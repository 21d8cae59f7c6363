"""A merge-type SentencePiece model in plain Python: exact encoding and decoding.

Pieces are numbered in the order of their merges: characters first, then by falling score.
A sequence of pieces is what merging gives exactly if each two neighbours are, so a text is
encoded from left to right: the longest piece that fits behind the one before is taken, a
shorter one if it does not fit, and where nothing fits the position is marked as failed and the
piece before is given up. Whether two pieces may stand next to each other is found by undoing
their merges, latest first, and looking for a pair across the border that would have
been merged earlier.
"""

from __future__ import annotations

import codecs
import heapq
import struct
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np

SPACE = "▁"
# Fixed values of the model format: kinds of pieces.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
# A character between words that no piece holds.
BORDER = "\0"
# Distinct words whose ids one encoder remembers, and places for pairs of pieces it has judged.
REMEMBERED, PLACES = 600_000, 1 << 20
# Longer words are not remembered.
LONG = 64


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of the fields of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield key >> 3, data[at : at + size]
        at += size


def read_pieces(data: bytes) -> tuple[list[tuple[str, float, int]], bool]:
    """(text, score, kind) of every piece of a model file, and whether texts get a blank in front.

    Models that are not of merge type, or that change texts before encoding, are an error.
    """
    pieces, trainer, normal = [], {}, {}
    for number, value in _fields(data):
        if number == 1:
            told = dict(_fields(value))
            score = struct.unpack("<f", told[2])[0] if 2 in told else 0.0
            pieces.append((told[1].decode(), score, told.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(_fields(value))
        elif number == 3:
            normal = dict(_fields(value))
    if trainer.get(3, 1) != 2:
        raise ValueError("the model is not of merge type")
    if trainer.get(24, 0) or not normal.get(5, 1) or normal.get(4, 1) or normal.get(2) or normal.get(6):
        raise ValueError("the model changes texts before it encodes them")
    if any(kind not in (NORMAL, UNKNOWN, CONTROL, BYTE) for _, _, kind in pieces):
        raise ValueError("the model has user-defined or unused pieces")
    return pieces, bool(normal.get(3, 1))


class PieceModel:
    """The pieces in the order of their merges, and which two each was merged from."""

    def __init__(self, data: bytes):
        self.pieces, self.dummy_prefix = read_pieces(data)
        normal = {text: (i, score) for i, (text, score, kind) in enumerate(self.pieces) if kind == NORMAL}
        self.byte_ids = {int(text[1:-1], 16): i for i, (text, _, kind) in enumerate(self.pieces) if kind == BYTE}
        if len(self.byte_ids) < 256:
            raise ValueError("the model has no bytes for unknown characters")
        merged = sorted((t for t in normal if len(t) > 1), key=lambda t: -normal[t][1])
        # Pieces of the lowest score may share it; they merge last, from the left.
        lowest = normal[merged[-1]][1] if merged else 0.0
        last = {t for t in merged if normal[t][1] == lowest}
        self.last = last if len(last) > 1 else set()
        merged = [t for t in merged if t not in self.last]
        scores = [normal[t][1] for t in merged]
        if any(a == b for a, b in zip(scores, scores[1:])):
            raise ValueError("pieces above the lowest score share a score")
        if any(set(t) != {SPACE} for t in self.last) or any(SPACE in t[1:] for t in merged):
            raise ValueError("pieces of blanks do not stand apart from the words")
        characters = sorted(t for t in normal if len(t) == 1)
        if not {c for t in merged for c in t} <= set(characters) or BORDER in characters:
            raise ValueError("a piece holds a character that is no piece")
        self.texts = list(characters)
        self.index = {c: n for n, c in enumerate(characters)}
        self.left, self.right = list(range(len(characters))), list(range(len(characters)))
        for text in merged:
            # A piece that its own merges never reach is no piece.
            for k in range(len(text) - 1, 0, -1):
                one, two = self.index.get(text[:k]), self.index.get(text[k:])
                if one is not None and two is not None and self.may_stand(one, two):
                    self.index[text] = len(self.texts)
                    self.texts.append(text)
                    self.left.append(one)
                    self.right.append(two)
                    break
        self.ids = [normal[t][0] for t in self.texts]
        self.last_ids = {t: normal[t][0] for t in self.last}
        self.lone = normal[SPACE][0] if SPACE in normal else None
        # The longest piece that begins a piece.
        self.shorter = [
            next((self.index[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in self.index), -1) for t in self.texts
        ]

        # The tree of all pieces: a number for each node and character, the node it leads to, and
        # the piece that ends there.
        nodes, ends = {}, [-1]
        for n, text in enumerate(self.texts):
            node = 0
            for c in text:
                step = node << 21 | ord(c)
                if step not in nodes:
                    nodes[step] = len(ends)
                    ends.append(-1)
                node = nodes[step]
            ends[node] = n
        order = sorted(nodes)
        self.steps = np.array(order, np.int64)
        self.nodes = np.array([nodes[s] for s in order], np.int64)
        self.ends = np.array(ends, np.int32)

    def longest(self, codes: np.ndarray, places: np.ndarray) -> np.ndarray:
        """The longest piece that begins at each of the places, the number behind all pieces where none does.

        ``codes`` are characters, the last of which no piece holds.
        """
        found = np.full(len(places), len(self.texts), np.int32)
        going, node, at = np.arange(len(places)), np.zeros(len(places), np.int64), places
        while len(going):
            step = node << 21 | codes[at]
            i = np.minimum(np.searchsorted(self.steps, step), len(self.steps) - 1)
            hit = self.steps[i] == step
            going, node, at = going[hit], self.nodes[i[hit]], at[hit] + 1
            piece = self.ends[node]
            found[going[piece >= 0]] = piece[piece >= 0]
        return found

    def may_stand(self, one: int, two: int) -> bool:
        """Whether merging leaves ``one`` and ``two`` side by side."""
        index, texts, left, right = self.index, self.texts, self.left, self.right
        # Merges before this number came before those undone so far.
        limit = len(texts) + 1
        while True:
            across = index.get(texts[one] + texts[two])
            if across is not None and across < limit:
                return False
            from_left = one > two
            for _ in range(2):
                if from_left and right[one] != one:
                    # A merge of equal number across the border lies to the right: it comes later.
                    limit, one = one, right[one]
                    break
                if not from_left and left[two] != two:
                    limit, two = two + 1, left[two]
                    break
                from_left = not from_left
            else:
                return True

    def merged_run(self, length: int) -> list[int]:
        """Ids of a run of ``length`` lone blanks: its pieces share a score and merge from the left."""
        start, size = list(range(length)), [1] * length
        after, before = list(range(1, length + 1)), list(range(-1, length - 1))
        known = {len(t) for t in self.last}
        ready = [i for i in range(length - 1) if 2 in known]
        heapq.heapify(ready)
        while ready:
            i = heapq.heappop(ready)
            j = after[i] if size[i] else length
            if j >= length or size[i] + size[j] not in known:
                continue
            size[i], size[j] = size[i] + size[j], 0
            after[i] = after[j]
            if after[i] < length:
                before[after[i]] = i
                heapq.heappush(ready, i)
            if before[i] >= 0:
                heapq.heappush(ready, before[i])
        return [self.lone if size[i] == 1 else self.last_ids[SPACE * size[i]] for i in start if size[i]]


class PieceEncoder:
    """Encodes texts word by word; words met often are remembered.

    All new words of a batch go through the search side by side, a step of each at a time.
    """

    def __init__(self, model: PieceModel):
        self.model = model
        # The number of a character that no piece holds; it stands alone beside anything.
        self.unknown = len(model.texts)
        self.lengths = np.array([len(t) for t in model.texts] + [1], np.int32)
        self.shorter = np.array([*model.shorter, -1], np.int32)
        self.ids = np.array([*model.ids, -1], np.int32)
        # Pairs of pieces judged before, each in the place its hash gives.
        self.judged = np.full(PLACES, -1, np.int64)
        self.verdicts = np.zeros(PLACES, bool)
        self.words: dict[str, bytes] = {}
        self.runs: dict[int, bytes] = {}
        self.automaton = ahocorasick.Automaton()
        for n, text in enumerate(model.texts):
            self.automaton.add_word(text, n)
        self.automaton.make_automaton()

    def _fit(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Whether merging leaves each two pieces side by side."""
        keys = one.astype(np.int64) * (self.unknown + 1) + two
        places = (keys * 0x9E3779B1 >> 12) % PLACES
        known = self.judged[places] == keys
        fit = self.verdicts[places]
        if known.all():
            return fit
        new, back = np.unique(keys[~known], return_inverse=True)
        found = np.empty(len(new), bool)
        for i, key in enumerate(new.tolist()):
            p, q = divmod(key, self.unknown + 1)
            found[i] = self.unknown in (p, q) or self.model.may_stand(p, q)
        fit[~known] = found[back]
        at = (new * 0x9E3779B1 >> 12) % PLACES
        # Of two new pairs for one place, one is kept, with its own verdict.
        self.judged[at] = new
        kept = self.judged[at] == new
        self.verdicts[at[kept]] = found[kept]
        return fit

    def _split(self, joined: str, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """The piece that begins at each place of ``joined``, -1 where none does; words lie from starts to stops."""
        lengths = self.lengths
        codes = np.frombuffer((joined + BORDER).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        # Longest matches where the one before ended; those elsewhere are looked up when needed.
        longest = np.full(len(joined) + 1, -1, np.int32)
        matches = np.fromiter(chain.from_iterable(self.automaton.iter_long(joined)), np.int64).reshape(-1, 2)
        longest[matches[:, 0] + 1 - lengths[matches[:, 1]]] = matches[:, 1]
        longest[starts] = np.where(longest[starts] < 0, self.model.longest(codes, starts), longest[starts])
        # The piece that ends before each place on the way taken so far, and places with no way on.
        ended = np.full(len(joined) + 1, -1, np.int32)
        failed = np.zeros(len(joined) + 1, bool)
        at, stop, piece = starts.copy(), stops, longest[starts]
        while len(at):
            end = at + lengths[piece]
            before = ended[at]
            ok = ~failed[end]
            judge = np.flatnonzero(ok & (before >= 0))
            ok[judge] = self._fit(before[judge], piece[judge])
            ended[end[ok]] = piece[ok]
            at = np.where(ok, end, at)
            new = at[ok & (longest[at] < 0)]
            longest[new] = self.model.longest(codes, new)
            piece = np.where(ok, longest[at], self.shorter[piece])
            # Where no shorter piece is left, the piece before is given up: it finds its end failed.
            stuck = np.flatnonzero(piece < 0)
            failed[at[stuck]] = True
            piece[stuck] = ended[at[stuck]]
            at[stuck] -= lengths[piece[stuck]]
            going = at < stop
            at, stop, piece = at[going], stop[going], piece[going]
        found = np.full(len(joined) + 1, -1, np.int32)
        at, start = stops.copy(), starts
        while len(at):
            piece = ended[at]
            at = at - lengths[piece]
            found[at] = piece
            going = at > start
            at, start = at[going], start[going]
        return found

    def _encoded(self, words: list[str]) -> list[bytes]:
        """Ids of words, each taken as it stands."""
        if not words:
            return []
        joined = BORDER.join(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        stops = np.cumsum(sizes + 1) - 1
        starts = stops - sizes
        found = self._split(joined, starts, stops)
        places = np.flatnonzero(found >= 0)
        ids = self.ids[found[places]]
        cuts = np.searchsorted(places, np.append(starts, len(found)))
        strange = set(np.searchsorted(stops, places[ids < 0]).tolist())
        raw, bounds = ids.tobytes(), (4 * cuts).tolist()
        out = [raw[a:b] for a, b in zip(bounds, bounds[1:])]
        byte_ids = self.model.byte_ids
        for n in strange:
            # Characters that no piece holds become their bytes.
            parts = []
            for i in range(cuts[n], cuts[n + 1]):
                spelled = joined[places[i]].encode("utf-8", "surrogatepass") if ids[i] < 0 else b""
                parts += [byte_ids[b] for b in spelled] or [ids[i]]
            out[n] = np.array(parts, np.int32).tobytes()
        return out

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of every text, without an end id."""
        known = self.words
        front = SPACE if self.model.dummy_prefix else ""
        cut = [(front + t).replace(" ", SPACE).split(SPACE) if t else [""] for t in texts]
        wanted = set()
        for words in cut:
            wanted.update(words[1:])
        wanted.discard("")
        if len(known) + len(wanted) > REMEMBERED:
            known.clear()
        new = list(wanted.difference(known))
        known.update(zip(new, self._encoded([SPACE + w for w in new]), strict=True))
        heads = [words[0] for words in cut if words[0]]
        first = dict(zip(heads, self._encoded(heads), strict=True))
        out = []
        for words in cut:
            head = first[words[0]] if words[0] else b""
            del words[0]
            if "" not in words:
                ids = head + b"".join(map(known.__getitem__, words))
            else:
                ids = head + b"".join(self._spaced(words))
            out.append(np.frombuffer(ids, np.int32))
        for word in new:
            if len(word) > LONG:
                del known[word]
        return out

    def _spaced(self, words: list[str]) -> Iterator[bytes]:
        """Ids of words between which there are runs of blanks."""
        lone, blanks = np.int32(self.model.lone).tobytes(), 0
        for word in words:
            if not word:
                blanks += 1
                continue
            ids = self.words[word]
            if blanks:
                # A word may leave its own blank alone, behind those in front of it.
                alone = ids[:4] == lone
                yield self._run(blanks + alone)
                ids, blanks = ids[4 * alone :], 0
            yield ids
        yield self._run(blanks)

    def _run(self, length: int) -> bytes:
        if length not in self.runs:
            if len(self.runs) > LONG:
                self.runs.clear()
            self.runs[length] = np.array(self.model.merged_run(length), np.int32).tobytes()
        return self.runs[length]


def _each_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("mapweave_each_byte", _each_byte)


class PieceDecoder:
    """Turns ids back into text."""

    def __init__(self, model: PieceModel):
        shown = {UNKNOWN: lambda t: " ⁇ ".encode(), CONTROL: lambda t: b"", BYTE: lambda t: bytes([int(t[1:-1], 16)])}
        self.dummy_prefix = model.dummy_prefix
        self.starts = {i for i, (t, _, kind) in enumerate(model.pieces) if kind == NORMAL and t.startswith(SPACE)}
        self.silent = {i for i, (_, _, kind) in enumerate(model.pieces) if kind == CONTROL}
        self.bytes = [
            shown[kind](t) if kind in shown else t.replace(SPACE, " ").encode() for t, _, kind in model.pieces
        ]

    def decode(self, ids: list[int]) -> str:
        """The text of ids; bytes that form no character are replaced one by one."""
        parts, silent = [[]], self.silent
        if silent.isdisjoint(ids):
            parts = [ids]
        else:
            # Bytes on either side of a control piece form no character together.
            for i in ids:
                if i in silent:
                    parts.append([])
                else:
                    parts[-1].append(i)
            parts = [p for p in parts if p]
        joined = [b"".join(map(self.bytes.__getitem__, p)) for p in parts]
        if self.dummy_prefix and parts and parts[0] and parts[0][0] in self.starts:
            # The blank put in front belongs to the first piece that shows anything.
            joined[0] = joined[0][1:]
        return "".join([j.decode("utf-8", "mapweave_each_byte") for j in joined])
