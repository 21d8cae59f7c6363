from pyspark.sql import functions as F

from conftest import rows
from mapweave.operators import filters, lists
from mapweave.sources.storage import Staging

RECORDS = "id int, instrument string, instance int"


def test_primary_records(spark):
    df = spark.createDataFrame(
        [(1, "", None), (2, "visit", None), (3, "", 1), (4, None, None)], RECORDS
    )
    kept, rejected = filters.primary_records("instrument", "instance")(df)
    assert [r["id"] for r in kept.collect()] == [1]
    assert [r["id"] for r in rejected.orderBy("id").collect()] == [2, 3, 4]


def test_trim_only_spaces_of_existing_columns(spark):
    df = spark.createDataFrame([(" MARY ", "\tSmith "), (None, "")], "first string, last string")
    got = filters.trim_columns(df, ["first", "last", "absent"])
    assert rows(got) == [(None, ""), ("MARY", "\tSmith")]


TEST_RECORDS = {
    ("A pilot study", "MARY", "SMITH"): False,
    ("", "Mary", "Smith"): True,
    (None, "Mary", "Smith"): True,
    ("Untitled", "Mary", "Smith"): True,
    ("A pilot study", "x1", "SMITH"): False,
    ("A pilot study", "x1", "y2"): True,
    ("A pilot study", "x1", ""): False,
    ("A pilot study", "x1", None): False,
    ("A pilot study", "", "y2"): False,
    ("A pilot study", None, None): False,
    ("A pilot study", "J", "J"): False,
    ("A pilot study", "mary ann", "s"): True,
}


def test_test_records_are_split(spark):
    df = spark.createDataFrame(list(TEST_RECORDS), "title string, first string, last string")
    kept, rejected = filters.split_test_records("title", "first", "last")(df)
    assert set(map(tuple, kept.collect())) == {k for k, v in TEST_RECORDS.items() if not v}
    assert set(map(tuple, rejected.collect())) == {k for k, v in TEST_RECORDS.items() if v}
    assert kept.count() + rejected.count() == len(TEST_RECORDS)


def test_stages_run_in_order_and_keep_rejects_by_name(spark):
    df = spark.range(10)

    def below(limit):
        def stage(data):
            return filters.Filtered(data.where(data.id < limit), data.where(data.id >= limit))

        return stage

    kept, rejects = filters.run_stages(
        df, [("first", below(8)), ("same", filters.keep_all), ("second", below(3))]
    )
    assert rows(kept) == [(0,), (1,), (2,)]
    assert list(rejects) == ["first", "second"]
    assert rows(rejects["first"]) == [(8,), (9,)]
    assert rows(rejects["second"]) == [(3,), (4,), (5,), (6,), (7,)]


def chain(spark):
    listed = spark.createDataFrame([("a", "p"), ("a", "q"), ("b", "r"), (None, "s")], "seg string, x string")
    blocked = spark.createDataFrame([("a", None), ("a", None), ("b", "7")], "seg string, n string")
    known = spark.createDataFrame([("a",), ("b",), ("b",)], "seg string")
    return [
        ("primary", filters.primary_records("instrument", "instance")),
        ("enrich", lists.enrich_all([listed])),
        ("restrict", lists.restrict_all([known])),
        ("same", filters.keep_all),
        ("block", lists.block_all([blocked])),
    ]


def test_marked_stages_give_what_plain_ones_give(spark):
    data = [
        (i, seg, n, instrument, None)
        for i, (seg, n, instrument) in enumerate(
            [("a", 7, ""), ("a", None, ""), ("b", 7, ""), ("b", None, ""), (None, 7, ""), ("c", 1, ""), ("a", 7, "x"), ("b", 7, None)]
        )
    ]
    df = spark.createDataFrame(data, "id int, seg string, n int, instrument string, instance int")
    df = df.union(df.where("id IN (1, 4)"))
    plain, plain_rejects = filters.run_stages(df, chain(spark))
    staging, tables, counts = Staging(spark), [], {}

    def cut(marked, by):
        tables.append(by)
        return staging.table(marked, "marked", by)

    kept, rejects = filters.run_stages(df, chain(spark), cut, counts)
    assert len(tables) == 1 and kept.columns == plain.columns and rows(kept) == rows(plain)
    assert list(rejects) == list(plain_rejects) == ["primary", "restrict", "block"]
    for name, rejected in rejects.items():
        assert rejected.columns == plain_rejects[name].columns
        assert rows(rejected) == rows(plain_rejects[name]) and rejected.count()
    # Every record is kept or rejected once by primary; those behind it are multiplied by the lists.
    assert rejects["primary"].count() == 2
    found = {name: count.get["rows"] for name, count in counts.items()}
    assert found["primary"] == 8 and found["block"] == kept.count()
    assert found["restrict"] - found["block"] == rejects["block"].count()


def test_marked_stages_do_not_depend_on_the_join(spark, small_limits, monkeypatch):
    from mapweave.operators import skew

    monkeypatch.setattr(skew, "ROWS_PER_SLICE", 1)
    monkeypatch.setattr(lists, "will_broadcast", lambda df: False)
    test_marked_stages_give_what_plain_ones_give(spark)


def test_marked_stages_sift_rows_before_a_large_list(spark, small_limits, monkeypatch):
    staging = Staging(spark)
    monkeypatch.setattr(lists, "will_broadcast", lambda df: False)
    df = spark.range(2000).selectExpr("id", "concat('k', id) AS k", "if(id % 9 = 0, null, id % 40) AS n", "'x' AS same")
    listed = spark.createDataFrame([("k3", "a"), ("k3", "b"), ("k1999", "c"), ("none", "d"), (None, "e")], "k string, v string")
    blocked = spark.createDataFrame([("7", "x"), (None, "x"), ("8", "y")], "n string, same string")
    for stage, plain in ((lists.enrich_all, lists.enrich), (lists.restrict_all, lists.restrict), (lists.block_all, lists.block)):
        entries = blocked if plain is lists.block else listed
        marked = stage([entries], staging.cut).mark(staging.cut(df.withColumn("alive", F.col("id") < 1990)), "alive")
        kept = marked.where("alive").drop("alive")
        assert rows(kept) == rows(plain(df.where("id < 1990"), entries))
        assert marked.select("id").distinct().count() == 2000
        assert "bitmap_construct_agg" in marked._jdf.queryExecution().analyzed().toString()


def test_most_rows_pass_by_the_join(spark):
    from mapweave.operators.sift import can_sift, may_match

    df = spark.range(20_000).selectExpr("id", "cast(id AS string) AS k", "cast(id AS double) AS d")
    few = spark.range(0, 20_000, 100).selectExpr("cast(id AS string) AS lk", "id AS li")
    told = may_match(df, few, [("k", "lk")], "maybe").where("maybe")
    assert 200 <= told.count() < 300
    assert told.where("id % 100 = 0").count() == 200
    assert can_sift(df, few, [("k", "lk"), ("id", "li")]) and not can_sift(df, few, [("d", "li")])


def test_lists_on_one_key_shuffle_the_records_once(spark, small_limits, monkeypatch):
    staging = Staging(spark)
    monkeypatch.setattr(lists, "will_broadcast", lambda df: False)
    data = spark.range(300).selectExpr("id", "concat('k', id % 50) AS k")
    one = spark.createDataFrame([("k3", "a"), ("k3", "b"), ("k7", "c"), (None, "e")], "k string, v string")
    two = spark.createDataFrame([("k3", "x"), ("k9", "y")], "k string, w string")
    other = spark.createDataFrame([("a", "r")], "v string, z string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for stage, plain in ((lists.enrich_all, lists.enrich), (lists.restrict_all, lists.restrict)):
            marked = stage([one, two], staging.cut).mark(staging.cut(data.withColumn("alive", F.col("id") < 290)), "alive")
            # The records and each of the lists.
            assert marked._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 3
            kept = marked.where("alive").drop("alive")
            assert rows(kept) == rows(plain(plain(data.where("id < 290"), one), two))
            assert marked.select("id").distinct().count() == 300
        marked = lists.enrich_all([one, two, other], staging.cut).mark(staging.cut(data.withColumn("alive", F.lit(True))), "alive")
        assert rows(marked.drop("alive")) == rows(lists.enrich(lists.enrich(lists.enrich(data, one), two), other))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
