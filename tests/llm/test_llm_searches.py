"""Top-k search, WARC archives, the registered queries and the pipeline."""

import base64
import gzip
import hashlib
import math
from collections import Counter

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from conftest import SMALL
from mapweave.llm import binary_files, common, queries, topk, warc


# --- top-k -------------------------------------------------------------------


def brute_top(rows, k, every):
    fine = [(i, [math.floor(64.0 * x) for x in v]) for i, v in rows if i is not None and v is not None
            and all(x is not None and math.isfinite(x) for x in v)]
    out = Counter()
    asked = {(i, tuple(v)) for i, v in fine if i % every == 0}
    for i, q in asked:
        products = ((sum(a * b for a, b in zip(q, v)), j) for j, v in fine if j != i)
        scores = sorted((-max(topk.LOWEST, min(topk.HIGHEST, s)), j) for s, j in products)
        out.update((i, n, j, -s) for n, (s, j) in enumerate(scores[:k], 1))
    return out


@pytest.mark.parametrize("scale", [1.0, 1e9, 1e12])
def test_top_k_is_that_of_brute_force(spark, monkeypatch, scale):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 40)
    draw = np.random.default_rng(3)
    rows = [(i, (draw.normal(size=6) * scale / 64).tolist()) for i in range(150)]
    same = [0.5 * scale] * 6
    rows += [(i, same) for i in range(200, 260)] + [(200, same), (3, rows[3][1])]
    rows += [(400, None), (420, [1.0, None]), (440, [float("nan")]), (460, [float("inf")]), (480, []), (None, same), (500, [1.0, 2.0])]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=7)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert Counter(map(tuple, got.collect())) == brute_top(rows, 7, 20)


def test_top_k_of_few_rows(spark):
    schema = "vec_id long, embedding array<float>, score long, vec string"
    rows = [(0, [1.0], 1, "a"), (1, [2.0], 2, "b")]
    assert list(map(tuple, topk.top_k(spark.createDataFrame(rows, schema)).collect())) == [(0, 1, 1, 8192)]
    assert topk.top_k(spark.createDataFrame(rows[:1], schema)).count() == 0
    assert topk.top_k(spark.createDataFrame([], schema)).count() == 0


# --- WARC --------------------------------------------------------------------


PAGES = "page_id long, url string, html string, payload string, page string"


def test_archives_survive_the_round_trip(spark, monkeypatch):
    common.share_code(spark)
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 1000)
    texts = ["<p>é</p>", None, "", "<p>é</p>", "x" * 300_000, "a\r\n\r\nb", "<p>é</p>", "WARC/1.1\r\n\r\n"]
    rows = [(i, f"http://h/{i}\r\nX: y" if i % 2 else None, t, "p", "q") for i, t in enumerate(texts)]
    rows += [rows[6], (None, "u", "<p>é</p>", "p", "q"), (None, None, "alone", "p", "q")]
    pages = spark.createDataFrame(rows, PAGES)
    path = common.staging(pages).folder("archives")
    warc.write_archives(pages, path)
    got = warc.read_archives(spark, path, keep_payload=True).collect()
    assert len(got) == len(rows)
    largest = {}
    for i, _, t, *_ in rows:
        largest[t or ""] = max(largest.get(t or "", -1), -1 if i is None else i)
    want = Counter()
    for i, _, t, *_ in rows:
        data = (t or "").encode()
        own = largest[t or ""] == (-1 if i is None else i)
        sums = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want[i, len(data), sums, "response" if own else "revisit", None if own else largest[t or ""], data if own else None] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to,
                    None if r.payload is None else bytes(r.payload)) for r in got) == want
    for r in binary_files.read_files(spark, path).collect():
        whole = gzip.decompress(bytes(r.content))
        assert whole.startswith(b"WARC/1.1\r\n") and whole.endswith(b"\r\n\r\n")


def test_archives_are_bounded_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 50_000)
    noise = np.random.default_rng(1).integers(97, 123, (40, 9000), dtype=np.uint8)
    pages = spark.createDataFrame([(i, None, n.tobytes().decode(), "p", "q") for i, n in enumerate(noise)], PAGES).coalesce(1)
    path = common.staging(pages).folder("archives")
    warc.write_archives(pages, path)
    sizes = [len(r.content) for r in binary_files.read_files(spark, path).collect()]
    largest = max(len(warc.record_bytes(str(i), None, n.tobytes(), None)) for i, n in enumerate(noise))
    assert len(sizes) > 3 and max(sizes) < 50_000 + largest
    assert warc.read_archives(spark, path).count() == 40


def test_no_pages_give_no_records(spark):
    pages = spark.createDataFrame([], PAGES)
    path = common.staging(pages).folder("archives")
    warc.write_archives(pages, path)
    assert warc.read_archives(spark, path).count() == 0


def test_large_records_end_in_a_zero_byte():
    data = np.random.default_rng(0).bytes(17 << 20)
    record = warc.record_bytes("1", None, data, None)
    assert record.endswith(b"\0")
    (read,) = warc.read_records(record, keep_payload=True)
    assert read["payload"] == data


@pytest.mark.parametrize("fault", ["digest", "cut", "length"])
def test_faults_are_found(fault):
    record = warc.record_bytes("1", "u", b"payload", None)
    if fault == "cut":
        record = record[:-20]
    else:
        plain = gzip.decompress(record)
        changed = plain.replace(b"\r\n\r\npayload", b"\r\n\r\npayloaD") if fault == "digest" else plain[:-6] + plain[-4:]
        record = gzip.compress(changed)
    with pytest.raises(ValueError):
        list(warc.read_records(record))


# --- queries and pipeline ----------------------------------------------------


@pytest.mark.parametrize("name", queries.oracle_sql())
def test_query_matches_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    result = connection.execute(queries.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    got = entry_points.queries()[name](spark, SMALL).select(*columns).collect()
    assert Counter(map(tuple, got)) == Counter(result.fetchall())
    assert got


def test_one_query_for_each_operator():
    names = entry_points.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10
    assert "pipeline" in names


def test_pipeline_stages_keep_columns_and_take_effect(spark):
    docs = common.table(spark, SMALL, "documents")
    stage = common.staging(docs)
    counts = [docs.count()]
    before = docs
    for number, (_, function) in enumerate(corpus_pipeline.STAGES):
        after = stage.table(function(spark, before, SMALL), f"s{number}")
        if number < 4:
            assert after.columns == docs.columns
        counts.append(after.count())
        if number < 3:
            assert after.join(before, docs.columns, "left_anti").isEmpty()
        before = after
    assert counts[0] > counts[1] > counts[2] >= counts[3] and counts[4] == counts[5]
    assert corpus_pipeline.run(spark, SMALL).count() == counts[5]


@pytest.mark.parametrize("number", range(5))
def test_pipeline_stages_take_odd_and_no_rows(spark, number):
    schema = common.table(spark, SMALL, "documents").schema
    rows = [(1, None, None, None, None), (1, None, None, None, None), (2, "", "en", "s", 0), (None, "a b c", "en", "s", 5)]
    _, function = corpus_pipeline.STAGES[number]
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        assert function(spark, docs, SMALL).count() <= 2 * docs.count()
