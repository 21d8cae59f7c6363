from datetime import date

import pytest

from conftest import rows
from mapweave.operators import lists

RECORDS = "id int, seg string, n int, day date, ok boolean"
DATA = [
    (1, "a", 1, date(2020, 1, 2), True),
    (2, "a", None, None, None),
    (3, None, 3, date(2020, 1, 2), False),
    (4, "", 4, date(2021, 1, 2), True),
]


@pytest.fixture(params=["plain", "split"])
def data(spark, request):
    if request.param == "split":
        request.getfixturevalue("small_limits")
    return spark.createDataFrame(DATA, RECORDS)


def entries(spark, columns, *values):
    return spark.createDataFrame(list(values), ", ".join(f"{c} string" for c in columns))


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_enrich_keeps_all_records_and_multiplies_duplicates(spark, data):
    got = lists.enrich(data, entries(spark, ["seg", "x"], ("a", "p"), ("a", "q"), ("z", "r"), (None, "s")))
    assert got.columns == data.columns + ["x"]
    assert [(r[0], r[-1]) for r in rows(got)] == [
        (1, "p"), (1, "q"), (2, "p"), (2, "q"), (3, None), (4, None),
    ]


def test_later_lists_use_columns_of_earlier_ones(spark, data):
    first = entries(spark, ["n", "nation"], ("1", "N1"), ("3", "N3"))
    second = entries(spark, ["nation", "region"], ("N3", "R"))
    got, rejected = lists.enrich_all([first, second])(data)
    assert [(r["id"], r["nation"], r["region"]) for r in got.orderBy("id").collect()] == [
        (1, "N1", None), (2, None, None), (3, "N3", "R"), (4, None, None),
    ]
    assert rejected is None


def test_restrict_keeps_listed_records(spark, data):
    got = lists.restrict(data, entries(spark, ["seg", "n"], ("a", "1"), ("", "4"), (None, "3")))
    assert ids(got) == [1, 4]


def test_keys_of_other_types(spark, data):
    assert ids(lists.restrict(data, entries(spark, ["n"], ("1.5",), ("bad",), ("4",)))) == [1, 4]
    assert ids(lists.restrict(data, entries(spark, ["ok"], ("yes",), ("maybe",)))) == [1, 4]
    days = entries(spark, ["day"], ("2020-01-02",), ("2021-1-2",), ("bad",))
    assert ids(lists.restrict(data, days)) == [1, 3]
    assert ids(lists.block(data, days)) == [2, 4]


def test_block_is_null_safe_on_all_columns(spark, data):
    blocked = entries(spark, ["seg", "n"], ("a", None), (None, "3"), ("a", "7"), ("a", None))
    got = lists.block(data, blocked)
    assert ids(got) == [1, 4]
    assert got.columns == data.columns
    assert ids(lists.block(got, blocked)) == [1, 4]


def test_bad_number_in_a_block_list_counts_as_blank(spark, data):
    assert ids(lists.block(data, entries(spark, ["n"], ("bad",)))) == [1, 3, 4]


def test_lists_that_do_not_fit(spark, data):
    with pytest.raises(ValueError, match="shares no column"):
        lists.enrich(data, entries(spark, ["other"], ("a",)))
    with pytest.raises(ValueError, match="records lack"):
        lists.block(data, entries(spark, ["seg", "other"], ("a", "b")))


def test_records_are_cut_before_a_large_list(spark, data, monkeypatch):
    cuts = []

    def cut(df):
        cuts.append(df)
        return df

    listed = entries(spark, ["n"], ("1",))
    monkeypatch.setattr(lists, "will_broadcast", lambda df: True)
    assert ids(lists.restrict_all([listed], cut)(data).kept) == [1] and not cuts
    monkeypatch.setattr(lists, "will_broadcast", lambda df: False)
    other = entries(spark, ["seg"], ("a",))
    assert ids(lists.restrict_all([listed, other], cut)(data).kept) == [1] and len(cuts) == 2
    # Lists on one key meet the records where the first has placed them.
    assert ids(lists.restrict_all([listed, listed], cut)(data).kept) == [1] and len(cuts) == 3


def test_no_lists(spark, data):
    assert ids(lists.block_all([])(data).kept) == [1, 2, 3, 4]
