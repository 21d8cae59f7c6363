import pytest

from conftest import rows
from mapweave.plans import rules as rule_plans
from mapweave.plans.expression_columns import expression_columns, with_sources
from mapweave.plans.rules import Rule, check_rules, declared_types, rules_frame

COLUMNS = ["rid", "name", "note", "t___a", "t___b", "redcap_repeat_instance"]
KEY = Rule("main", "id", "field", ("rid",), "int", primary=True)
TICK = Rule("main", "tag", "field", ("t",))


def test_sources_keep_order_and_repeats():
    assert Rule("t", "c", "if_equal", ("a", '"x"', "b", "a")).sources == ["a", "b", "a"]
    assert Rule("t", "c", "expr", ("upper(a)",), reads=("a",)).sources == ["a"]
    assert Rule("t", "c", "literal", ('"a"',)).sources == []
    inner = rule_plans.node("first_nonblank", "b", '"x"', rule_plans.node("first_name", "a"))
    assert Rule("t", "c", "if_equal", (inner, '"x"', "b", "a")).sources == ["b", "a", "b", "a"]
    # As a JSON reader gives it, with an object among the strings.
    assert rule_plans.sources_of('{"kind":"if_equal","args":["a",{"kind":"field","args":["z"]},"b","\\"c\\""]}') == ["a", "z", "b"]
    assert Rule("t", "c", "none").sources == []


def test_routing(spark):
    rules = rules_frame(
        spark,
        [
            KEY,
            TICK,
            Rule(None, "loose", "field", ("rid",)),
            Rule("other", "x", "first_nonblank", ("gone", "rid")),
            Rule("other", "y", "field", ("gone",)),
            Rule("other", "z", "literal", ('"rid"',)),
        ],
    )
    assert [r[0] for r in rows(rule_plans.route(rules, ["rid", "name"]).select("column"))] == ["id", "x"]
    assert [r[0] for r in rows(rule_plans.route(rules, ["t"]).select("column"))] == ["tag"]
    assert rows(rule_plans.route(rules, [])) == []


def test_lists_per_table_follow_rule_order(spark):
    rules = [Rule("b", "z", "field", ("q",), primary=True), Rule("a", "x", "field", ("r",)),
             Rule("b", "y", "field", ("p",), "int", primary=True)]
    frame = rules_frame(spark, rules)
    lists = {r["table"]: [c["column"] for c in r["columns"]] for r in rule_plans.column_lists(frame, "column").collect()}
    assert lists == {"a": ["x"], "b": ["z", "y"]}
    keys = rule_plans.primary_keys(frame).collect()
    assert [(r["table"], [(c["sources"], c["column"], c["type"]) for c in r["columns"]]) for r in keys] == [
        ("b", [(["q"], "z", "text"), (["p"], "y", "int")])
    ]


def test_lineage_and_mapped_fields(spark):
    twice = Rule("a", "x", "first_nonblank", ("p", "q"))
    frame = rules_frame(spark, [twice, Rule("b", "y", "first_nonblank", ("p", "q")), Rule("b", "z", "field", ("p",))])
    assert [r["source"] for r in rule_plans.lineage(frame).collect()] == ["p", "q", "p", "q", "p"]
    # The same expression counts once, different ones add up.
    assert rows(rule_plans.mapped_fields(frame)) == [("p",), ("p",), ("q",)]


def test_counted_above(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
    assert rows(rule_plans.counted_above(df, ["k"])) == [(None, 2), ("a", 2)]


def test_declared_types():
    rules = [KEY, Rule("t", "n", "field", ("name",), "text"), Rule("u", "n", "field", ("name",), "date"),
             Rule("t", "m", "first_nonblank", ("note", "name"), "bogus"), Rule("t", "g", "field", ("gone",), "bogus")]
    assert declared_types(rules, COLUMNS) == [
        ("redcap_repeat_instance", "int"), ("rid", "int"), ("name", "text"), ("name", "date"),
    ]


def test_good_rules_pass():
    check_rules([KEY, TICK, Rule("main", "gid", "generate_id", ("name", '"x"')), Rule("main", "na", "none")], COLUMNS)


BAD = {
    "unknown kind": [Rule("t", "c", "median", ("rid",))],
    "unknown kind None": [Rule("t", "c", None)],
    "wrong number of args": [Rule("t", "c", "first_nonblank", ("rid",))],
    "wrong number of args for generate_id": [Rule("t", "c", "generate_id", ())],
    "double quotes": [Rule("t", "c", "literal", ("rid",))],
    "a field is a column": [Rule("t", "c", "field", ('"rid"',))],
    "cannot be nested": [Rule("t", "c", "first_name", (rule_plans.node("generate_id", "rid"),))],
    "wrong number of args for if_equal": [Rule("t", "c", "first_name", (rule_plans.node("if_equal", "rid"),))],
    "generate_id for n reads missing": [Rule(None, "n", "generate_id", (rule_plans.node("first_name", "lost"),))],
    "unsupported type": [Rule("t", "c", "field", ("rid",), "float")],
    "unsupported type None": [Rule("t", "c", "field", ("rid",), None)],
    "two different generate_id": [Rule("t", "g", "generate_id", ("rid",)), Rule("u", "g", "generate_id", ("name",))],
    "already exist": [Rule("t", "note", "generate_id", ("rid",))],
    "reads missing": [Rule("t", "c", "first_nonblank", ("rid", "gone"))],
    "generate_id for g reads missing": [Rule(None, "g", "generate_id", ("gone",))],
    "several rules for": [Rule("t", "c", "field", ("rid",)), Rule("t", "c", "field", ("name",))],
    "written by the job itself": [Rule("name", "c", "field", ("rid",))],
    "more than one checkbox rule": [KEY, TICK, Rule("main", "other", "field", ("t",))],
    "must be a plain field": [KEY, Rule("main", "tag", "first_nonblank", ("t", '"x"'))],
    "type must be text": [KEY, Rule("main", "tag", "field", ("t",), "int")],
    "no copied columns": [Rule("main", "tag", "field", ("t",))],
    "no primary key": [Rule("main", "id", "field", ("rid",)), TICK],
    "key main.id of a checkbox table must be a field": [
        Rule("main", "id", "first_nonblank", ("rid", "name"), primary=True), TICK],
    "must be a copied record column": [Rule("main", "x", "field", ("name",)),
                                       Rule("main", "id", "field", ("gone",), primary=True), TICK],
    "filled by a copied column": [KEY, Rule("main", "tag", "field", ("name",)), TICK],
}


@pytest.mark.parametrize("message", BAD)
def test_bad_rules_are_refused(message):
    with pytest.raises(ValueError, match=message):
        check_rules(BAD[message], COLUMNS)


READABLE = ["a", "b", "Mixed", "s", "dotted.name", "quo`ted", "x"]
READ = {
    "upper(a) || b || a": ["a", "b", "a"],
    "mixed + 1": ["Mixed"],
    "s.field.inner + s['k']": ["s", "s"],
    "`dotted.name` = `quo``ted`": ["dotted.name", "quo`ted"],
    "transform(split(a, ','), x -> x || b)": ["a", "b"],
    "aggregate(s.list, x, (acc, v) -> acc + v, acc -> acc || b)": ["s", "x", "b"],
    "filter(s.list, x -> exists(s.other, y -> y = x and y <> a)) ": ["s", "s", "a"],
    "CASE WHEN a = 'b' THEN `b` ELSE 'x' END": ["a", "b"],
    "sum(a) FILTER (WHERE b > 0) OVER (PARTITION BY x ORDER BY s)": ["a", "b", "x", "s"],
    "cast(a AS int) IN (1, 2) AND later IS NULL": ["a", "later"],
    "'a' || \"b\"": [],
}


@pytest.mark.parametrize("text", READ)
def test_columns_of_an_expression(spark, text):
    assert expression_columns(spark, text, READABLE) == READ[text]


def test_sources_of_expr_may_be_left_out(spark):
    rules = [
        Rule("t", "one", "expr", ("upper(A)",)),
        Rule("t", "two", "expr", ("upper(a)",), reads=("b",)),
        Rule("t", "three", "field", ("a",)),
    ]
    assert [r.sources for r in with_sources(spark, rules, READABLE)] == [["a"], ["b"], ["a"]]
    for text in ("a +", "*", "count(*) + (SELECT 1)"):
        with pytest.raises(ValueError, match="rule for t.one"):
            with_sources(spark, [Rule("t", "one", "expr", (text,))], READABLE)
