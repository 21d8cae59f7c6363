"""Operators on words and pieces against the library and brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from conftest import SMALL
from mapweave.llm import common, phrases, piece_tokens, queries, spelling
from mapweave.llm.piece_model import PieceDecoder, PieceEncoder, read_pieces

SCHEMA = "doc_id long, text string, lang string, word string, n string, hash string, shard string, row string"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows and columns named like internal ones."""
    common.share_code(spark)
    long = " ".join(f"Wörd{'x' * (i % 5)}able" for i in range(30_000)) + "é" * 3000
    texts = [None, "", " \t\n ", "A", "a  b ", "One two three four.", long, "é è ß 漢 \x1c\0 ▁x", "  \tAAA !!", "×÷×÷×÷"]
    data = [(i, t, "en" if i % 3 else None, "a", "b", "c", "d", "e") for i, t in enumerate(texts)]
    data += [(5, texts[5], "en", "a", "b", "c", "d", "e")] * 3 + [(None, "no id here", None, *"abcde")]
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture(scope="module")
def documents(spark):
    return common.table(spark, SMALL, "documents")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=piece_tokens.default_model())


# --- pieces ------------------------------------------------------------------


def test_ids_and_texts_are_those_of_the_library(spark, documents, library):
    expected = {}
    for r in documents.collect():
        ids = library.encode(r.text or "", add_eos=True)
        sha = [hashlib.sha256(s.encode()).hexdigest() for s in (" ".join(map(str, ids)), library.decode(ids))]
        expected[r.doc_id] = (len(ids), *sha)
    got = {r.doc_id: tuple(r)[1:] for r in queries.op11_piece_tokens(spark, SMALL).collect()}
    assert got == expected


def test_random_texts_and_ids_match_the_library(library):
    model = piece_tokens.read_model()
    encoder, decoder, draw = PieceEncoder(model), PieceDecoder(model), random.Random(5)
    letters = "  \t\n▁abcdehinorst'.,éß漢😀\0ゼ<>0xA⁇�"
    texts = ["".join(draw.choices(letters, k=draw.randint(0, 40))) for _ in range(3000)]
    texts += [" " * k + "x" + " " * (k // 2) for k in range(80)] + ["a" * 5000, "漢" * 500, "in" * 900]
    assert [ids.tolist() for ids in encoder.encode(texts)] == library.encode(texts)
    for _ in range(3000):
        ids = [draw.choice([0, 1, 2, 259, 28705, draw.randrange(32000), draw.randrange(3, 259)]) for _ in range(draw.randint(0, 9))]
        assert decoder.decode(ids) == library.decode(ids)


def test_little_memory_changes_no_ids(monkeypatch, library):
    from mapweave.llm import piece_model

    monkeypatch.setattr(piece_model, "REMEMBERED", 5)
    monkeypatch.setattr(piece_model, "LONG", 3)
    monkeypatch.setattr(piece_model, "PLACES", 4)
    encoder = PieceEncoder(piece_tokens.read_model())
    for text in ("the cat sat on the mat   and slept", "the mat   sat", "  internationalisation of the cat"):
        assert [ids.tolist() for ids in encoder.encode([text, text])] == library.encode([text, text])


def test_odd_rows_have_ids(odd, library):
    found = piece_tokens.encoded(odd, decode=True).collect()
    assert len(found) == odd.count()
    for r in found:
        assert r.ids == library.encode(r.row.text or "", add_eos=True)
        assert r.decoded == library.decode(r.ids)
    assert piece_tokens.encoded(odd.limit(0)).count() == 0
    back = piece_tokens.decoded(odd.sparkSession.createDataFrame([(1, [264, None, 2]), (2, None)], "row int, ids array<int>"))
    assert {(r.row.row, r.text) for r in back.collect()} == {(1, "a"), (2, None)}


def test_models_of_other_kinds_are_an_error():
    with pytest.raises(ValueError, match="merge type"):
        read_pieces(b"\x12\x02\x18\x01")
    with pytest.raises(ValueError, match="changes texts"):
        read_pieces(b"\x12\x02\x18\x02\x1a\x02\x20\x01")


# --- phrases -----------------------------------------------------------------


def brute_phrases(rows, support, first):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, 5):
                f[lang].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = set()
    for lang, counts in f.items():
        frequent = {p: c for p, c in counts.items() if c >= support and len(p) > 1}
        found = []
        for p, a in frequent.items():
            held = any(
                100 * c >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, c in frequent.items() if len(q) > len(p)
            )
            if not held:
                cuts = [(2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p))]
                score, _, l, r = min(cuts)
                found.append((score, a, " ".join(p), l, r))
        found.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out |= {(lang, i + 1, p, a, l, r, n[lang], s) for i, (s, a, p, l, r) in enumerate(found[:first])}
    return out


def test_phrases_are_those_of_brute_force(documents):
    got = phrases.collocations(documents, support=6, first=300).collect()
    expected = brute_phrases([(r.text, r.lang) for r in documents.collect()], 6, 300)
    assert len(got) == len(expected) and set(map(tuple, got)) == expected


def test_small_tasks_and_full_bitmaps_change_no_phrases(documents, monkeypatch):
    monkeypatch.setattr(phrases, "HELD", 2000)
    monkeypatch.setattr(phrases, "WORDS", 500)
    monkeypatch.setattr(phrases, "BYTES", 5000)
    monkeypatch.setattr(phrases, "BITS", 16)
    few = documents.limit(60)
    got = phrases.collocations(few.repartition(3), support=4, first=100).collect()
    assert set(map(tuple, got)) == brute_phrases([(r.text, r.lang) for r in few.collect()], 4, 100)


def test_shards_lose_no_phrase(spark, monkeypatch):
    # Each phrase reaches the support in all documents, but few of its occurrences lie in any shard.
    rows = [(i, "x y z. a b" if i % 2 else "p q", "en") for i in range(24)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    for shards in (1, 5, 24):
        monkeypatch.setattr(phrases, "SHARDS", shards)
        got = {r.phrase: r.f for r in phrases.frequent_phrases(docs, support=12).where("size > 1").collect()}
        assert got == {"x y": 12, "y z": 12, "x y z": 12, "a b": 12, "p q": 12}


@pytest.mark.parametrize("held, most", [(10, 3), (1 << 20, 1 << 20)])
def test_packed_sums_are_plain_counts(held, most):
    draw = np.random.default_rng(3)
    texts = [" ".join(f"w{i}" for i in draw.integers(0, 200, 30)) + "..  x\ty" for _ in range(40)]
    shards, langs = draw.integers(0, 3, 40).tolist(), draw.choice(["en", "de"], 40).tolist()
    batch = pa.RecordBatch.from_pydict({"shard": shards, "lang": langs, "text": texts})

    def each_word(words, numbers, name):
        yield phrases._phrase_hashes(words, numbers, name, 1)[1]

    rows = list(phrases._summed(iter([batch]), each_word, (1000, held, 50)))
    packed = sorted((r for b in rows for r in b.to_pylist()), key=lambda r: (r["shard"], r["lang"], r["bucket"]))
    ordered = pa.RecordBatch.from_pylist(packed, rows[0].schema)
    got = Counter()
    for shard, lang, _, hashes, counts in phrases._merged(iter([ordered.slice(0, 7), ordered.slice(7)]), most):
        assert len(set(hashes.tolist())) == len(hashes)
        got.update({(shard, lang, h): n for h, n in zip(hashes.tolist(), counts.tolist())})
    words, expected = phrases._Words(), Counter()
    for shard, lang, text in zip(shards, langs, texts):
        names = [w.encode() for w in re.split("[. \t]", text) if w]
        numbers = np.array([words[w] for w in names])
        found = phrases._phrase_hashes(words, numbers, lang, 1)[1] >> np.uint64(32)
        expected.update((shard, lang, h) for h in found.tolist())
    assert got == expected


def test_odd_rows_have_phrases(odd):
    got = phrases.collocations(odd, support=2, first=50).collect()
    assert set(map(tuple, got)) == brute_phrases([(r.text, r.lang) for r in odd.collect()], 2, 50)
    assert phrases.collocations(odd.limit(0)).count() == 0


# --- spelling ----------------------------------------------------------------


def brute_vocabulary(rows, length, least):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= length:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= least}


def one_edit(u, v):
    if len(u) > len(v):
        u, v = v, u
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v)) == 1
    return len(v) == len(u) + 1 and any(v[:i] + v[i + 1 :] == u for i in range(len(v)))


def brute_variants(counts, times=5):
    near = {w: [v for v in counts if abs(len(v) - len(w)) < 2 and one_edit(w, v)] for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= times * counts[w] else None
    out = set()
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, counts[w], len(near[w]), counts.get(form[w])))
    return out


def test_vocabulary_is_that_of_brute_force(documents, odd):
    for docs, least in ((documents, 5), (documents, 1), (odd, 1)):
        got = {r.word: r.n for r in spelling.vocabulary(docs, least=least).collect()}
        assert got == brute_vocabulary([(r.doc_id, r.text) for r in docs.collect()], 6, least)
    assert spelling.variants(spelling.vocabulary(odd.limit(0))).count() == 0


def test_variants_are_those_of_brute_force(documents):
    counts = {r.word: r.n for r in spelling.vocabulary(documents).collect()}
    got = set(map(tuple, spelling.variants(spelling.vocabulary(documents)).collect()))
    assert got == brute_variants(counts)
    assert any(r[1] is not None for r in got)


@pytest.mark.parametrize("limit", [1, 7, 10_000])
def test_partitions_of_any_size_give_each_pair_once(spark, limit):
    draw = random.Random(limit)
    words = {"".join(draw.choices("aab", k=draw.randint(0, 9))) for _ in range(400)} | {"a" * 40, "a" * 41, "b" + "a" * 40}
    counts = {w: draw.choice([1, 2, 10, 60, 400]) for w in words}
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = [(r.word, r.near, r.near_n) for r in spelling.near_pairs(table, limit).collect()]
    assert len(got) == len(set(got))
    assert set(got) == {(u, v, counts[v]) for u in words for v in words if one_edit(u, v)}
    assert set(map(tuple, spelling.variants(table, 3, limit).collect())) == brute_variants(counts, 3)


def test_long_chains_reach_their_root(spark):
    forms = [(f"w{i}", f"w{i + 1}") for i in range(27)]
    got = spelling.roots(spark.createDataFrame(forms, "word string, form string")).collect()
    assert sorted(map(tuple, got)) == sorted((w, "w27") for w, _ in forms)
