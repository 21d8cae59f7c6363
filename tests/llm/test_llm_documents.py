"""Operators over documents against brute force, with odd rows and empty tables."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from mapweave.llm import (
    common, decontaminate, labelled, masked_lm, mixing, quality, sharding, simhash, token_file, toxicity,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, score string, _hash string, nth string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows and columns named like internal ones."""
    common.share_code(spark)
    long = " ".join(f"Word{i % 977}" for i in range(60_000))
    texts = [None, "", " \t\n ", "A", "a b", "One two three four.", "One two three four.", long, "é è ß 漢 \x1c x", "AAA !!"]
    extra = ("x", "y", "z", "w")
    data = [(i, t, "en", f"s{i % 3}" if i % 4 else None, 7, *extra) for i, t in enumerate(texts)]
    data += [(5, texts[5], "en", "s2", 7, *extra)] * 3 + [(None, "no id here", None, None, None, *extra)]
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture(scope="module")
def documents(spark):
    return common.table(spark, SMALL, "documents")


@pytest.fixture(scope="module")
def nothing(odd):
    return odd.limit(0)


def words(text):
    return WORD.findall(text or "")


# --- decontamination ---------------------------------------------------------


def simple_words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute_hits(text, items, window=13):
    own = simple_words(text)
    hit, found = set(), set()
    for name, body in items:
        item = simple_words(body)
        n = min(window, len(item))
        windows = {tuple(item[i : i + n]) for i in range(len(item) - n + 1)} if n else set()
        for i in range(len(own) - n + 1):
            if tuple(own[i : i + n]) in windows:
                hit.update(range(i, i + n))
                found.add("" if name is None else str(name))
    return len(own), len(hit), sorted(found)


@pytest.mark.parametrize("part_bytes", [decontaminate.PART_BYTES, 60])
def test_hits_are_those_of_brute_force(spark, monkeypatch, part_bytes):
    monkeypatch.setattr(decontaminate, "PART_BYTES", part_bytes)
    draw = np.random.default_rng(4)
    letters = list("abcd")
    text = lambda n: " ".join(draw.choice(letters, n))
    items = [(i, text(int(n))) for i, n in enumerate((1, 2, 3, 4, 5, 6, 9, 12))] + [(None, "d a d"), (7, None), (9, " !"), (2, "b c")]
    docs = [(i, text(int(n))) for i, n in enumerate(draw.integers(0, 60, 40))] + [(99, None), (99, None), (100, "A-B,c d")]
    found = decontaminate.contamination(
        spark.createDataFrame([(*d, "kept") for d in docs], "doc_id long, text string, _row_key string"),
        spark.createDataFrame(items, "item_id long, text string"),
        window=5,
    )
    got = found.collect()
    assert {r.row._row_key for r in got} == {"kept"} and found.schema["row"].dataType.names == ["doc_id", "text", "_row_key"]
    want = Counter((d, *map(str, brute_hits(t, items, 5))) for d, t in docs)
    assert Counter((r.row.doc_id, str(r.n_words), str(r.n_hit), str(r.item_ids)) for r in got) == want
    for r in got:
        spans = [(s.start, s.end) for s in r.spans]
        assert sum(b - a for a, b in spans) == r.n_hit
        assert all(b < c for (_, b), (c, _) in zip(spans, spans[1:]))


def test_automaton_knows_all_substrings():
    draw = np.random.default_rng(5)
    items = [(i, [bytes([97 + int(x)]) for x in draw.integers(0, 3, 30)]) for i in range(8)]
    automaton = decontaminate.SuffixAutomaton(items, 4)
    for n in (1, 3, 6):
        for _ in range(100):
            wanted = [bytes([97 + int(x)]) for x in draw.integers(0, 3, n)]
            v = 0
            for w in wanted:
                v = automaton.next[v].get(automaton.vocabulary[w]) if v is not None else None
            inside = any(it[i : i + n] == wanted for _, it in items for i in range(len(it)))
            assert (v is not None) == inside


def test_contaminated_documents_go_and_spans_are_cut(spark, odd, nothing):
    items = spark.createDataFrame([(1, "one TWO three")], "item_id long, text string")
    kept = decontaminate.decontaminated(odd, items)
    assert kept.columns == odd.columns
    assert kept.count() == odd.count() - 5
    assert decontaminate.decontaminated(odd, items.limit(0)).count() == odd.count()
    assert decontaminate.decontaminated(nothing, items).count() == 0
    cut = decontaminate.without_spans(odd.where("doc_id = 6"), items)
    assert [r.text for r in cut.collect()] == ["four"]


# --- mixing ------------------------------------------------------------------


def test_targets_share_what_limits_cut_off(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 50), (None, 0), ("d", 400)], "source string, source_size long")
    got = {r.source: r for r in mixing.targets(sizes).collect()}
    left, limit, weights = 1.5 * 1460, {k: 2 * r.source_size for k, r in got.items()}, {"a": 3, "b": 1, "c": 2, "d": 3, None: 1}
    target = {}
    while len(target) < 5:
        open_ = [k for k in limit if k not in target]
        level = (left - sum(target.values())) / sum(weights[k] for k in open_)
        over = [k for k in open_ if level * weights[k] >= limit[k]]
        target |= {k: limit[k] for k in over} if over else {k: level * weights[k] for k in open_}
    assert {k: r.weight for k, r in got.items()} == weights
    assert {k: r.target for k, r in got.items()} == pytest.approx(target)


def test_mix_meets_targets_and_limits(documents):
    rows = mixing.mix(documents).collect()
    texts = {r.doc_id: r for r in documents.collect()}
    assert len(rows) == len(texts)
    by = defaultdict(lambda: [0, 0, 0, 0])
    for r in rows:
        assert r.size == len(words(texts[r.doc_id].text)) and 0 <= r.taken <= 2 * r.size
        mine = by[r.source]
        mine[0] += r.size
        mine[1] += r.taken
        mine[2:] = r.source_size, r.target
    for size, taken, whole, target in by.values():
        assert size == whole and abs(taken - target) <= 1
    assert sorted(mixing.mix(documents.repartition(5)).collect()) == sorted(rows)


def test_mix_of_odd_rows(odd, nothing):
    rows = mixing.mix(odd, block_words=16).collect()
    assert len(rows) == odd.count()
    assert all(r.taken <= 2 * r.size for r in rows)
    assert sum(r.taken for r in rows) == pytest.approx(1.5 * sum(r.size for r in rows), abs=4)
    assert {r.taken for r in rows if r.size == 0} == {0}
    assert mixing.mix(nothing).count() == 0


def test_mixed_documents_hold_the_words_taken(odd, nothing):
    taken = sum(r.taken for r in mixing.mix(odd, block_words=16).collect())
    mixed = mixing.mixed_documents(odd, block_words=16)
    assert mixed.columns == odd.columns
    rows = mixed.collect()
    assert abs(sum(len(words(r.text)) for r in rows) - taken) <= 4
    assert all(r.n_chars == len(r.text) for r in rows)
    assert mixing.mixed_documents(nothing).count() == 0


def test_shards_of_the_mix_draw_from_every_source(spark, documents):
    sources = spark.createDataFrame(
        [(0, 30_000, 0, 50_000), (1, 20_000, 30_000, 50_000)], "sid int, slots long, slot_base long, all_slots long"
    )
    draws = mixing.shard_draws(sources, 3, 1000, 1).collect()
    assert Counter(r.sid for r in draws) == {0: 50, 1: 50}
    assert sum(r["count"] for r in draws if r.sid == 0) == 30_000
    per = [r["count"] for r in draws if r.sid == 0]
    # About 1000 draws at 0.6.
    assert 540 < min(per) and max(per) < 660 and len(set(per)) > 20


@pytest.mark.parametrize("n", [1, 2, 7, 64, 1000])
def test_permutations_are_bijections(spark, n):
    moved = spark.range(n).select(common.permuted(F.col("id"), F.lit(n), seed=3).alias("p"))
    assert sorted(r.p for r in moved.collect()) == list(range(n))


def test_no_python_in_native_operators(documents):
    for df in (mixing.mix(documents), sharding.shard_documents(documents)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"))


# --- sharding ----------------------------------------------------------------


def check_shards(rows, shards):
    counts = Counter(r.shard for r in rows)
    sizes = [counts[s] for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    for s in counts:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))


def test_many_small_sources_spread_over_all_cells(spark, monkeypatch):
    docs = spark.range(4000).selectExpr("id AS doc_id", "'t' AS text", "concat('s', id) AS source")
    monkeypatch.setattr(common, "ROWS_PER_BUCKET", 250)
    seen = []
    numbered = common.numbered
    monkeypatch.setattr(common, "numbered", lambda df, group, bucket, *a: seen.append((df, bucket)) or numbered(df, group, bucket, *a))
    check_shards(sharding.shard_documents(docs).collect(), 16)
    df, cell = seen[-1]
    held = [r["count"] for r in df.groupBy(cell).count().collect()]
    assert len(held) == common.bucket_count(4000) and max(held) < 2 * 4000 / len(held)


def test_shards_match_the_mixture(documents):
    rows = sharding.shard_documents(documents).collect()
    texts = {r.doc_id: r.text for r in documents.collect()}
    check_shards(rows, 16)
    for source, n in Counter(r.source for r in rows).items():
        held = Counter(r.shard for r in rows if r.source == source)
        assert max(held.values()) <= n / 16 + 2
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(data) + 1, zlib.crc32(data))
    assert sorted(sharding.shard_documents(documents.repartition(7)).collect()) == sorted(rows)


def test_shards_of_odd_rows(odd, nothing):
    rows = sharding.shard_documents(odd).collect()
    assert len(rows) == odd.count()
    check_shards(rows, 16)
    assert sharding.shard_documents(nothing).count() == 0


def test_numbering_of_a_hot_group(spark):
    rows = spark.range(3000).select("id", F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise("cold").alias("g"))
    rows = rows.withColumn("h", F.xxhash64("id")).withColumn("b", common.hash_bucket("h", 16))
    got = common.numbered(rows, ["g"], "b", ["h"], amount="id").collect()
    for g in ("hot", "cold"):
        mine = sorted((r.h, r.nth, r.before, r.id, r.total) for r in got if r.g == g)
        before = 0
        for i, (_, nth, ahead, own, total) in enumerate(mine):
            assert (nth, ahead) == (i, before)
            before += own
        assert total == before


# --- SimHash -----------------------------------------------------------------


def test_fingerprint_by_hand():
    import xxhash

    def by_hand(text):
        own = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
        parts = [" ".join(own[i : i + 3]) for i in range(max(1, len(own) - 2))] if own else []
        hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    for text in ("", " \n", "A", "a B", "One two three", "É a b\x0bc  d\x1ce f", "x y z " * 9000):
        assert simhash.fingerprint(text) & (1 << 64) - 1 == by_hand(text)
    assert simhash.fingerprint(None) == 0


def brute_components(values, most):
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if bin(values[i] ^ values[j]).count("1") <= most:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(values))]


@pytest.mark.parametrize("most", [0, 1, 2, 3])
@pytest.mark.parametrize("limit", [5, 4096])
def test_components_are_those_of_brute_force(spark, most, limit):
    draw = np.random.default_rng(most)
    values = set()
    for _ in range(30):
        base = int(draw.integers(0, 1 << 63)) * 2
        for _ in range(int(draw.integers(1, 12))):
            values.add(base)
            for b in draw.integers(0, 64, int(draw.integers(1, 4))).tolist():
                base ^= 1 << int(b)
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    prints = spark.createDataFrame([(v,) for v in signed], "value long")
    stage = common.staging(prints)
    links = simhash.links(prints, stage, most, limit)
    found = {r.node: r.root for r in simhash.components(stage.cut(links), stage).collect()}
    want = brute_components(values, most)
    groups = defaultdict(set)
    for v, w in zip(signed, want, strict=True):
        groups[w].add(found.get(v, v))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_near_duplicates_of_odd_rows(spark, odd, nothing):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    by = {r.row.doc_id: r for r in rows}
    # Texts without words share fingerprint zero.
    assert {by[i].component_id for i in (0, 1, 2)} == {0}
    assert by[6].component_id == 5 and by[3].fingerprint == simhash.fingerprint("a")
    assert by[None].component_id is None
    kept = simhash.deduplicated(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id is None, r.doc_id) for r in kept.collect())[:2] == [(False, 0), (False, 3)]
    assert kept.groupBy("doc_id").count().where("count > 1").isEmpty()
    assert simhash.near_duplicates(nothing).count() == 0 and simhash.deduplicated(nothing).count() == 0


def test_near_duplicates_of_documents(documents):
    rows = simhash.near_duplicates(documents, keep=["doc_id"]).collect()
    ids = sorted(r.row.doc_id for r in rows)
    prints = {r.row.doc_id: r.fingerprint & (1 << 64) - 1 for r in rows}
    want = brute_components([prints[i] for i in ids], 2)
    assert {r.row.doc_id: r.component_id for r in rows} == {i: ids[w] for i, w in zip(ids, want, strict=True)}


# --- token files -------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(token_file.default_tokenizer())


def test_words_are_encoded_as_in_whole_texts(tokenizer):
    with open(token_file.default_tokenizer(), encoding="utf-8") as f:
        encoder = token_file.WordEncoder(f.read())
    assert encoder.by_piece
    draw = np.random.default_rng(6)
    letters = list("ab é'ß1²,. \n\t !#_<|>漢ſŉ\x1c　") + ["<|endoftext|>", "don't ", "word, ", " x"]
    texts = ["".join(draw.choice(letters, int(n))) for n in draw.integers(0, 14, 3000)] + [None, ""]
    got = [np.frombuffer(x, "<u2").tolist() for x in encoder.encode(texts)]
    assert got == [e.ids for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def check_tokens(rows, docs, tokenizer):
    rows = sorted(rows, key=lambda r: r.start)
    names = [(r.doc_id is not None, r.doc_id) for r in rows]
    assert names == sorted(names)
    start = 0
    want = Counter((d.doc_id, tuple(tokenizer.encode(d.text or "", add_special_tokens=False).ids + [2])) for d in docs)
    for r in rows:
        assert r.start == start and r.n_tokens == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        start += r.n_tokens
    assert Counter((r.doc_id, tuple(r.ids)) for r in rows) == want


@pytest.mark.parametrize("segment", [50, token_file.SEGMENT_TOKENS])
def test_tokens_survive_the_round_trip(spark, odd, nothing, tokenizer, monkeypatch, segment):
    monkeypatch.setattr(token_file, "SEGMENT_TOKENS", segment)
    for docs in (odd, nothing):
        path = common.staging(docs).folder("tokens")
        token_file.write_tokens(docs, path)
        check_tokens(token_file.read_tokens(spark, path, keep_ids=True).collect(), docs.collect(), tokenizer)


def test_damaged_segments_are_found():
    from mapweave.llm.huffman import Coder, code_lengths

    ids = np.array([3, 3, 4, 5, 2])
    coder = Coder(code_lengths(np.bincount(ids, minlength=9)))
    data = bytearray(token_file.segment_bytes(coder, 0, 0, [7, None], np.array([3, 2]), ids))
    file, segment, names, lengths, back = next(token_file.read_segments(coder, bytes(data)))
    assert (names, lengths.tolist(), back.tolist()) == ([7, None], [3, 2], ids.tolist())
    data[-8] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        next(token_file.read_segments(coder, bytes(data)))


@pytest.mark.parametrize("limit", [7, 10, 18])
def test_codes_are_prefix_free_limited_and_good(limit):
    from mapweave.llm.huffman import Coder, canonical_codes, code_lengths

    draw = np.random.default_rng(limit)
    counts = np.concatenate((np.zeros(5, int), 2 ** np.minimum(np.arange(90), 40), draw.integers(0, 3, 20)))
    lengths = code_lengths(counts, limit)
    used = counts > 0
    assert (lengths[used] > 0).all() and not lengths[~used].any() and lengths.max() <= limit
    assert sum(2.0 ** -int(x) for x in lengths[used]) <= 1
    codes = [format(int(c), f"0{n}b") for c, n in zip(canonical_codes(lengths)[used], lengths[used], strict=True)]
    assert not any(a != b and b.startswith(a) for a in codes for b in codes)
    symbols = draw.choice(np.flatnonzero(used), 1000)
    coder = Coder(lengths)
    payload, offsets = coder.encode(symbols, 64)
    assert coder.decode(payload, offsets, 1000, 64).tolist() == symbols.tolist()
    one = Coder(code_lengths(np.array([0, 5])))
    payload, offsets = one.encode(np.ones(9, int), 4)
    assert one.decode(payload, offsets, 9, 4).tolist() == [1] * 9


# --- classifiers and language model ------------------------------------------


@pytest.fixture(scope="module")
def labels(spark):
    return common.table(spark, SMALL, "labels")


def held_out_accuracy(scored, labels, label, cut):
    known = labels.where(labelled.is_held_out()).select(F.col("doc_id").alias("d"), F.col(label).alias("y"))
    rows = scored.select("row.doc_id", "score").join(known, F.col("doc_id") == F.col("d")).collect()
    return len(rows), sum((r.score >= cut) == (r.y == 1) for r in rows) / len(rows)


@pytest.mark.parametrize(
    ("module", "label", "least"), [(quality, "quality", 0.9), (toxicity, "toxic", 0.85)], ids=["quality", "toxic"]
)
def test_held_out_accuracy(spark, label, least, module):
    docs, labels = (common.table(spark, SMALL.replace("0.001", "0.01"), t) for t in ("documents", "labels"))
    scored = module.scored(docs, module.learned(docs, labels), keep=["doc_id"])
    n, accuracy = held_out_accuracy(scored, labels, label, module.CUT)
    assert n > 50 and accuracy >= least


@pytest.mark.parametrize("module", [quality, toxicity], ids=["quality", "toxic"])
def test_classifiers_score_odd_rows(spark, module, odd, nothing, documents, labels):
    model = module.learned(documents, labels)
    rows = module.scored(odd, model).collect()
    assert len(rows) == odd.count() and rows[0].row.asDict().keys() == set(odd.columns)
    assert all(0 <= r.score <= 1 for r in rows)
    assert module.scored(nothing, model).count() == 0
    # Nothing to learn from still gives scores.
    for none in (labels.limit(0), labels.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))):
        empty = module.learned(documents, none)
        assert all(0 <= r.score <= 1 for r in module.scored(odd, empty).collect())


def test_held_out_labels_are_never_learned(spark, documents, labels):
    flipped = labels.withColumn("quality", F.when(labelled.is_held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (quality.learned(documents, x) for x in (labels, flipped))
    assert np.array_equal(a.weights, b.weights) and a.shift == b.shift


def test_offending_sentences_are_located(spark):
    docs, labels = (common.table(spark, SMALL.replace("0.001", "0.01"), t) for t in ("documents", "labels"))
    model = toxicity.learned(docs, labels)
    text = "A good day to the. You are an idiot and a stupid moron!\nAll the and of."
    found = toxicity.offending_sentences(spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string"), model)
    assert [(r.row.doc_id, r.sentence) for r in found.collect()] == [(1, "You are an idiot and a stupid moron!")]


def test_noisy_or_of_sentences():
    model = toxicity.SentenceModel({f: 3.0 for f in toxicity.features_of(b"bad")[:1]}, -2.0)
    p, q = 1 / (1 + np.exp(2.0)), 1 / (1 + np.exp(-1.0))
    texts = ["bad bad. Fine", "fine", "", None, ". . bad!"]
    want = [1 - (1 - q) * (1 - p), p, 0.0, 0.0, q]
    assert model.documents(texts) == pytest.approx(want)


def test_network_learns_and_is_normalised(spark, odd, nothing, documents):
    network = masked_lm.WindowNetwork()
    every = np.arange(masked_lm.WORDS)
    context = [np.full(masked_lm.WORDS, w) for w in (3, 1, 4, 1)]
    assert np.exp(network.log_probabilities(every, context)).sum() == pytest.approx(1, abs=1e-4)
    ids = masked_lm.with_ids(documents, masked_lm.vocabulary(documents))
    before = masked_lm.scored(ids, network).agg(F.sum("log_likelihood"), F.sum("n_words")).first()
    after = masked_lm.scored(ids, masked_lm.trained(ids, 1)).agg(F.sum("log_likelihood")).first()
    assert after[0] > before[0] + 0.5 * before[1]
    rows = {r.row.doc_id: r for r in masked_lm.pseudo_likelihood(odd, rounds=1).collect()}
    assert [rows[i].n_words for i in (0, 1, 2, 3, 7)] == [0, 0, 0, 1, 60_000]
    assert rows[0].log_likelihood == 0 and rows[3].log_likelihood < 0
    assert masked_lm.pseudo_likelihood(nothing).count() == 0


def test_moves_of_tasks_are_averaged_by_their_words(spark):
    draw = np.random.default_rng(2)
    size = 2 * masked_lm.BLOCK + 77
    moves = [draw.normal(0, 1, size).astype(np.float32) for _ in range(3)]
    moves[1][: masked_lm.BLOCK] = 0
    counts = [5, 1, 10]
    rows = [r for m, c in zip(moves, counts) for r in masked_lm._moved(m, c).to_pylist()]
    assert len(rows) == 3 * 4 - 1
    table = spark.createDataFrame([(r["block"], r["words"], bytearray(r["values"])) for r in rows], masked_lm.MOVED)
    got = {r.block: r for r in masked_lm._averaged(table.repartition(5)).collect()}
    assert got[-1].words == 16
    total = np.concatenate([np.frombuffer(got[b].values, np.float64) for b in range(3)])[:size]
    assert total == pytest.approx(sum(m.astype(np.float64) * c for m, c in zip(moves, counts)))


def test_a_document_scores_what_its_words_say(documents):
    """Each word's probability worked out one by one, from the counts and the parameters."""
    counts = {bytes(r.word): r.n for r in masked_lm.word_counts(documents).collect()}
    listed = masked_lm.vocabulary(documents)
    groups = masked_lm.groups_for(listed)
    flat = np.random.default_rng(7).normal(0, 0.3, len(masked_lm.WindowNetwork(groups=groups).flat))
    network = masked_lm.WindowNetwork(flat, groups)
    classes = masked_lm.rare_classes(groups)
    totals = Counter()
    for word, n in counts.items():
        if word not in set(listed):
            totals[zlib.crc32(word) % classes] += n

    def number(word):
        return listed.index(word) + 1 if word in listed else len(listed) + 1 + zlib.crc32(word) % classes

    def log_probability(numbers, at):
        hidden = network.parts["hidden"].astype(float)
        for table, offset in zip(network.parts["inputs"], masked_lm.OFFSETS):
            there = at + offset
            hidden = hidden + table[numbers[there] if 0 <= there < len(numbers) else 0]
        hidden = np.append(np.tanh(hidden), 1)
        g, m = divmod(numbers[at], groups)
        out = 0.0
        for weights, chosen in ((network.parts["group"], g), (network.parts["member"][g], m)):
            logits = hidden @ weights.astype(float)
            out += logits[chosen] - np.log(np.exp(logits).sum())
        return out

    few = documents.orderBy(F.length("text")).where("length(text) > 60").limit(6)
    ids = masked_lm.with_ids(few, listed, keep=["doc_id", "text"]).withColumn("key", F.col("row.doc_id"))
    shares = masked_lm.class_shares(masked_lm.word_counts(documents), listed)
    inside = {r.key: r.inside for r in masked_lm.within_classes(ids, shares).collect()}
    for r in masked_lm.scored(ids, network).collect():
        words = r.row.text.encode().lower().split()
        numbers = [number(w) for w in words]
        want = sum(log_probability(numbers, i) for i in range(len(words)))
        want_inside = sum(np.log(counts[w] / totals[zlib.crc32(w) % classes]) for w in words if w not in listed)
        assert r.n_words == len(words)
        assert r.log_likelihood == pytest.approx(want, rel=1e-4)
        assert inside.get(r.row.doc_id, 0.0) == pytest.approx(want_inside)


def test_gradient_of_the_network():
    draw = np.random.default_rng(1)
    words = draw.integers(1, masked_lm.WORDS, 40)
    context = [draw.integers(0, masked_lm.WORDS, 40) for _ in masked_lm.OFFSETS]
    base = masked_lm.WindowNetwork()
    stepped = masked_lm.WindowNetwork(base.flat.copy())
    stepped.step(words, context)
    moved = np.flatnonzero(stepped.flat != base.flat)
    for at in draw.choice(moved, 12).tolist():
        slopes = []
        for sign in (1, -1):
            flat = base.flat.astype(np.float64)
            flat[at] += sign * 1e-2
            slopes.append(masked_lm.WindowNetwork(flat).log_probabilities(words, context).mean())
        slope = (slopes[1] - slopes[0]) / 2e-2
        # The first step goes against the slope.
        if abs(slope) > 1e-4:
            assert np.sign(stepped.flat[at] - base.flat[at]) == -np.sign(slope)


def test_rare_words_have_their_own_probability(spark):
    classes = masked_lm.rare_classes(masked_lm.GROUPS)
    by_class = {}
    for i in range(200):
        by_class.setdefault(zlib.crc32(b"rare%d" % i) % classes, []).append(f"rare{i}")
    a, b = next(c for c in by_class.values() if len(c) > 1)[:2]
    often = " ".join(f"often{i}" for i in range(masked_lm.most_words(masked_lm.GROUPS)))
    texts = [often] * 10 + [f"often1 {a} often2", f"often1 {b} often2", *[f"often3 {a}"] * 4]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.row.doc_id: r.log_likelihood for r in masked_lm.pseudo_likelihood(docs, rounds=1).collect()}
    assert len(rows) == len(texts)
    # The contexts and the class are the same; five occurrences stand against one.
    assert rows[10] - rows[11] == pytest.approx(np.log(5), abs=1e-4)
    counts = masked_lm.word_counts(docs)
    shares = masked_lm.class_shares(counts, masked_lm.frequent(counts)).collect()
    assert {r.word.decode(): np.exp(r.log_share) for r in shares} == pytest.approx({a: 5 / 6, b: 1 / 6})


def test_words_of_a_text_are_told_apart_side_by_side():
    """Numbers, known shares and rare words of texts against plain loops; each distinct word is looked up once."""
    texts = [None, "", "  ", " B a\tb  zz\x0bC é É a", "zz", "rare1 RARE2 rare1 \x1c x\x85y", "b rare2 \n"]
    listed, known = [b"a", b"b"], {b"zz": -0.5, b"rare2": -2.0}
    numbers = masked_lm.Numbers(listed, pa.table({"word": [*known], "log_share": [*known.values()]}))
    looked_up, of = [], numbers.of
    numbers.of = lambda distinct: looked_up.extend(distinct.to_pylist()) or of(distinct)
    ids, shares, rare = masked_lm._numbered(numbers, pa.array(["x", *texts, "x"]).slice(1, len(texts)))
    plain = [(t or "").encode().lower().split() for t in texts]
    assert len(looked_up) == len(set(looked_up)) and set(looked_up) >= {w for p in plain for w in p}
    classes = masked_lm.rare_classes(masked_lm.GROUPS)
    want = [[listed.index(w) + 1 if w in listed else 3 + zlib.crc32(w) % classes for w in p] for p in plain]
    assert [np.frombuffer(b, np.uint32).tolist() for b in ids.to_pylist()] == want
    assert shares.to_pylist() == [sum(known.get(w, 0) for w in p) for p in plain]
    other = [Counter(w for w in p if w not in listed and w not in known) for p in plain]
    assert [{r["word"]: r["times"] for r in doc} for doc in rare.to_pylist()] == other
    for none in ([], [None], [""]):
        assert masked_lm._numbered(numbers, pa.array(none, pa.string()))[0].to_pylist() == [b""] * len(none)


def test_scores_do_not_depend_on_which_shares_are_broadcast(spark, monkeypatch):
    texts = ["one two three one", "two four five five", None, "six one seven"] * 3 + ["eight nine one"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(masked_lm, "frequent", lambda counts: [b"one"])
    got = []
    for most in (0, 2, 100):
        monkeypatch.setattr(masked_lm.known_shares, "__defaults__", (most,))
        rows = {r.row.doc_id: (r.n_words, r.log_likelihood) for r in masked_lm.pseudo_likelihood(docs).collect()}
        got.append([x for i in range(len(texts)) for x in rows[i]])
    assert got[1] == pytest.approx(got[0]) and got[2] == pytest.approx(got[0])
    counts = masked_lm.word_counts(docs)
    known = masked_lm.known_shares(masked_lm.class_shares(counts, [b"one"]), 4)
    assert 0 < len(known) <= 4


def test_a_step_takes_the_softmaxes_of_many_groups_at_once(monkeypatch):
    """Far fewer exponentials than groups, and the same step however the rows are cut into blocks."""
    draw = np.random.default_rng(5)
    words = draw.integers(1, masked_lm.WORDS, 900)
    context = [draw.integers(0, masked_lm.WORDS, 900) for _ in masked_lm.OFFSETS]
    plain, calls = np.exp, []
    monkeypatch.setattr(np, "exp", lambda *args, **kw: calls.append(1) or plain(*args, **kw))
    whole = masked_lm.WindowNetwork()
    whole.step(words, context)
    assert len(calls) < masked_lm.GROUPS // 2
    scores = whole.log_probabilities(words, context)
    monkeypatch.setattr(masked_lm, "LOGITS", 7 * masked_lm.GROUPS)
    cut = masked_lm.WindowNetwork()
    cut.step(words, context)
    assert cut.flat == pytest.approx(whole.flat, abs=1e-4)
    assert cut.log_probabilities(words, context) == pytest.approx(scores, abs=1e-2)
    wide = masked_lm.WindowNetwork(whole.flat * 200)
    every = np.arange(masked_lm.WORDS)
    assert np.isfinite(wide.log_probabilities(every, [every] * len(masked_lm.OFFSETS))).all()


def test_listed_words_grow_with_the_corpus(spark):
    counts = spark.range(1, 5001).selectExpr("cast(cast(id AS string) AS binary) AS word", "10000000 div id AS n")
    words = masked_lm.frequent(counts)
    total = sum(10_000_000 // i for i in range(1, 5001))
    assert 2000 < masked_lm.most_words(masked_lm.GROUPS) * 3 < len(words) < total**0.5
    assert words[:3] == [b"1", b"2", b"3"] and len(set(words)) == len(words)
    assert masked_lm.most_words(masked_lm.groups_for(words)) >= len(words)
    few = masked_lm.frequent(counts.selectExpr("word", "1L AS n"))
    assert few == sorted(str(i).encode() for i in range(1, 5001))[: masked_lm.most_words(masked_lm.GROUPS)]


def test_components_that_share_their_id_stay_apart(spark):
    texts = [" ".join(f"{topic}{i}" for i in range(60)) for topic in ("sea", "hill", "town")]
    docs = spark.createDataFrame([(1, t) for t in texts] + [(2, texts[0])], "doc_id long, text string")
    assert sorted(r.text for r in simhash.deduplicated(docs).collect()) == sorted(texts)
    # Two fingerprints, linked, without any id: one row.
    linked = spark.createDataFrame([(None, texts[0]), (None, texts[0] + " sea60")], docs.schema)
    found = simhash.near_duplicates(linked, most_bits=63).collect()
    assert len({r.fingerprint for r in found}) == 2 and len({r.root for r in found}) == 1
    assert simhash.deduplicated(linked, most_bits=63).count() == 1


def test_repeated_items_are_held_once(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "PART_BYTES", 60)
    items = spark.createDataFrame([("a", "one two three")] * 500 + [("b", "four five six")], "item_id string, text string")
    split, parts = decontaminate.item_parts(items, "item_id", "text")
    assert parts == 1 and sorted((r["item"], r["text"]) for r in split.collect()) == [("a", "one two three"), ("b", "four five six")]


def test_one_training_row_for_each_labelled_id(spark):
    named = next(i for i in range(1, 100) if zlib.crc32(str(i).encode()) % labelled.FOLDS)
    docs = spark.createDataFrame([(named, f"text {i}") for i in range(300)], "doc_id long, text string")
    labels = spark.createDataFrame([(named, 1)], "doc_id long, quality int")
    rows = labelled.training_rows(docs, labels, "quality").collect()
    again = labelled.training_rows(docs.repartition(7), labels, "quality").collect()
    assert len(rows) == 1 and rows == again and rows[0].label == 1


def test_encoding_tasks_give_their_memory_back(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a few words")], "doc_id long, text string")
    tasks, given = [], []
    made = type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda df, run, schema: tasks.append(run) or made(df, run, schema))
    monkeypatch.setattr(common, "give_back", lambda: given.append(True))
    with open(token_file.default_tokenizer(), encoding="utf-8") as f:
        token_file.token_segments(docs, f.read(), "doc_id", "text", 2)
    batch = pa.RecordBatch.from_pydict({"doc_id": [1], "text": ["a few words"], "file": [0]})
    assert len(list(tasks[0](iter([batch])))) == 1 and given


def test_tasks_of_one_worker_learn_words_once(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a few words")], "doc_id long, text string")
    tasks, learned = [], []
    made, tokenized = type(docs).mapInArrow, token_file.WordEncoder._word_ids
    monkeypatch.setattr(type(docs), "mapInArrow", lambda df, run, schema: tasks.append(run) or made(df, run, schema))
    monkeypatch.setattr(token_file.WordEncoder, "_word_ids", lambda self, words: learned.extend(words) or tokenized(self, words))
    with open(token_file.default_tokenizer(), encoding="utf-8") as f:
        token_file.token_segments(docs, f.read(), "doc_id", "text", 2)
    token_file.encoder_for.cache_clear()
    batch = pa.RecordBatch.from_pydict({"doc_id": [1], "text": ["a few words, a few"], "file": [0]})
    first, second = (list(tasks[0](iter([batch])))[0] for _ in range(2))
    assert first.equals(second) and sorted(learned) == ["a", "few", "words"]


@pytest.mark.parametrize("remembered, characters", [(0, 1), (200, 40), (1 << 20, 1 << 20)])
def test_what_is_remembered_does_not_change_ids(tokenizer, monkeypatch, remembered, characters):
    monkeypatch.setattr(token_file, "REMEMBERED", remembered)
    monkeypatch.setattr(token_file, "CHARACTERS", characters)
    with open(token_file.default_tokenizer(), encoding="utf-8") as f:
        encoder = token_file.WordEncoder(f.read())
    draw = np.random.default_rng(7)
    parts = ["word", "wörd", "words.", "it's", "(x)", "12", "漢字", "\nnext", "\n\n", "  two", "a!?", ""]
    texts = [" ".join(draw.choice(parts, int(n))) for n in draw.integers(0, 9, 400)] + [None]
    for some in (texts, texts[::-1], []):
        got = [np.frombuffer(x, "<u2").tolist() for x in encoder.encode(some)]
        assert got == [e.ids for e in tokenizer.encode_batch([t or "" for t in some], add_special_tokens=False)]
