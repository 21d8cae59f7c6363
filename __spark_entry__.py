"""

Every query works on the whole of the given tables. Records, lists, rules and
dictionaries are derived from them by plain projections.
"""

from __future__ import annotations

import importlib
import importlib.util
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapweave.functions import expressions as ex
from mapweave.operators import dictionary, filters, keys, lists, reports, reshape
from mapweave.operators.key_registry import KeyRegistry
from mapweave.plans import rules as rule_plans
from mapweave.plans.job import Inputs, MappedRecords, cast_records
from mapweave.plans.rules import Rule, node, project_rules
from mapweave.sources.readers import read_csv, read_json_strings, read_lists
from mapweave.sources.storage import Staging
from mapweave.sources.writers import write_csv, write_report, write_tables

SMOKE_DIR = "/root/testdata/sf0.001"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- casts and expressions ---------------------------------------------------


def cast_declared(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "left(o_orderpriority, 1) AS level",
        "o_orderpriority AS bad_level",
        "cast(o_totalprice AS string) AS price",
        "'' AS blank",
        "date_format(o_orderdate, 'yyyy-MM-dd') AS day",
        "o_orderpriority AS bad_day",
        "CASE o_orderstatus WHEN 'F' THEN 'yes' WHEN 'O' THEN '0' ELSE 'maybe' END AS done",
        "CASE o_orderstatus WHEN 'P' THEN ' Y ' ELSE o_orderpriority END AS bad_done",
        "'' AS blank_done",
        "'' AS blank_day",
        "o_orderstatus AS status",
    )
    types = {
        "level": "int",
        "bad_level": "int",
        "price": "int",
        "blank": "int",
        "day": "date",
        "bad_day": "date",
        "done": "boolean",
        "bad_done": "boolean",
        "blank_done": "boolean",
        "blank_day": "date",
        "status": "text",
    }
    rules = [Rule("t", c, "field", (c,), t) for c, t in types.items()]
    return cast_records(records, rules)


CAST_DECLARED = """
SELECT o_orderkey, cast(left(o_orderpriority, 1) AS int) AS level, cast(NULL AS int) AS bad_level,
       cast(trunc(o_totalprice) AS int) AS price, cast(NULL AS int) AS blank,
       cast(o_orderdate AS date) AS day, cast(NULL AS date) AS bad_day,
       CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS done,
       CASE o_orderstatus WHEN 'P' THEN true END AS bad_done, cast(NULL AS boolean) AS blank_done,
       cast(NULL AS date) AS blank_day,
       o_orderstatus AS status
FROM orders
"""


def _order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "CASE o_orderstatus WHEN 'P' THEN '' WHEN 'O' THEN o_orderpriority END AS note",
        "o_orderstatus AS status",
        "o_orderpriority AS priority",
        "try_cast(left(o_orderpriority, 1) AS int) AS level",
        "try_cast(nullif(left(o_orderpriority, 1), '4') AS int) AS known_level",
        "cast(o_orderdate AS date) AS day",
        "date_format(o_orderdate, 'yyyy-MM-dd') AS day_text",
    )


def blank_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [
        Rule("t", "o_orderkey", "field", ("o_orderkey",)),
        Rule("t", "label", "first_nonblank", ("note", "status")),
        Rule("t", "chained", "first_nonblank", ("note", '""', "priority")),
        Rule("t", "level", "first_nonblank", ("known_level", "level")),
        Rule("t", "mixed", "first_nonblank", ("known_level", '"unknown"')),
        Rule("t", "nested", "first_nonblank", ("note", node("first_nonblank", '""', "status"))),
    ]
    return project_rules(_order_records(spark, sf_dir), rules)


def nested_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [
        Rule("t", "o_orderkey", "field", ("o_orderkey",)),
        Rule("t", "level", "first_nonblank", ("known_level", node("first_nonblank", "known_level", "level"))),
        Rule("t", "same", "if_equal", (node("first_nonblank", "known_level", "level"), '"five"', '"yes"', '"no"')),
        Rule("t", "low", "if_equal", (node("first_nonblank", "known_level", "level"), '"5"', node("literal", '"low"'), "status")),
        Rule("t", "name", "last_name", (node("first_nonblank", "note", node("if_equal", "status", '"P"', '"Mary Smith"', "status")),)),
    ]
    return project_rules(_order_records(spark, sf_dir), rules)


_ORDER_RECORDS = """
WITH rec AS (SELECT o_orderkey,
    CASE o_orderstatus WHEN 'P' THEN '' WHEN 'O' THEN o_orderpriority END AS note,
    o_orderstatus AS status, o_orderpriority AS priority,
    cast(left(o_orderpriority, 1) AS int) AS level,
    cast(nullif(left(o_orderpriority, 1), '4') AS int) AS known_level
  FROM orders)
"""
BLANK_COALESCE = _ORDER_RECORDS + """
SELECT DISTINCT o_orderkey, coalesce(nullif(note, ''), status) AS label,
       coalesce(nullif(note, ''), priority) AS chained, coalesce(known_level, level) AS level,
       coalesce(cast(known_level AS varchar), 'unknown') AS mixed,
       coalesce(nullif(note, ''), status) AS nested
FROM rec
"""


NESTED_RULES = _ORDER_RECORDS + """
SELECT DISTINCT o_orderkey, coalesce(known_level, level) AS level, 'no' AS same,
       CASE WHEN coalesce(known_level, level) = 5 THEN 'low' ELSE status END AS low,
       CASE WHEN status = 'P' THEN 'Smith' WHEN nullif(note, '') IS NULL THEN status
         ELSE note END AS name
FROM rec
"""


def if_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [
        Rule("t", "o_orderkey", "field", ("o_orderkey",)),
        Rule("t", "rush", "if_equal", ("priority", '"1-URGENT"', '"rush"', "status")),
        Rule("t", "null_condition", "if_equal", ("note", '"2-HIGH"', '"high"', '"other"')),
        Rule("t", "by_number", "if_equal", ("level", '"5"', '"low"', "level")),
        Rule("t", "bad_number", "if_equal", ("level", '"five"', '"low"', '"not low"')),
        Rule("t", "same_day", "if_equal", ("day", "day_text", '"same"', '"different"')),
        Rule("t", "fixed", "literal", ('"orders"',)),
    ]
    return project_rules(_order_records(spark, sf_dir), rules)


IF_EQUAL = _ORDER_RECORDS + """
SELECT DISTINCT o_orderkey, CASE WHEN priority = '1-URGENT' THEN 'rush' ELSE status END AS rush,
       CASE WHEN note = '2-HIGH' THEN 'high' ELSE 'other' END AS null_condition,
       CASE WHEN level = 5 THEN 'low' ELSE cast(level AS varchar) END AS by_number,
       'not low' AS bad_number, 'same' AS same_day, 'orders' AS fixed
FROM rec
"""

# Spellings of the two words of a part name, with the names they should give.
# "@f" stands for the first word, "@l" for the last, "@i" for an initial.
_SPELLINGS = [
    (4, "@f @l", "@f", "@l"),
    (8, "@l, @f", "@f", "@l"),
    (12, "Dr. @f A. @l PhD", "@f", "@l"),
    (16, "@i. @l, MD, PhD", "@i.", "@l"),
    (20, "@f (@l) @l-@f", "@f", "@l-@f"),
    (24, "7 of 9 - @f @l, M.D. - lab", "@f", "@l"),
    (28, "@f @l/lab 3", "@f", "@l"),
    (32, "@l, 3rd", None, "@l"),
    (35, "@f @l for 2 others", "@f", "@l"),
    (38, "@l", None, "@l"),
    (41, "@f @l PhD", None, "@f @l PhD"),
    (44, "@f  @l", None, "@f  @l"),
    (46, "unknown", "unknown", "unknown"),
    (48, "@f-", None, "@f-"),
]


def _spelled(position: int, quote: str) -> str:
    """CASE over p_size giving one column of the spelling table in SQL."""
    branches = []
    for spelling in _SPELLINGS:
        text = spelling[position]
        value = "NULL" if text is None else f"{quote}{text}{quote}"
        branches.append(f"WHEN p_size <= {spelling[0]} THEN {value}")
    last = "''" if position in (1, 3) else "NULL"
    case = f"CASE {' '.join(branches)} WHEN p_size = 49 THEN {last} END"
    return f"replace(replace(replace({case}, '@f', f), '@l', l), '@i', left(f, 1))"


_NAME_WORDS = """
SELECT p_partkey, p_size,
       concat(upper(left(split_part(p_name, ' ', 1), 1)), substr(split_part(p_name, ' ', 1), 2)) AS f,
       concat(upper(left(split_part(p_name, ' ', 2), 1)), substr(split_part(p_name, ' ', 2), 2)) AS l
"""


def person_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spark.sql(_NAME_WORDS + " FROM {part}", part=_table(spark, sf_dir, "part"))
    names = words.selectExpr("p_partkey", f"{_spelled(1, chr(39))} AS full_name")
    rules = [
        Rule("t", "p_partkey", "field", ("p_partkey",)),
        Rule("t", "first", "first_name", ("full_name",)),
        Rule("t", "last", "last_name", ("full_name",)),
        Rule("t", "first_of_nested", "first_name", (node("first_nonblank", '""', "full_name"),)),
    ]
    return project_rules(names, rules)


PERSON_NAME = f"""
SELECT p_partkey, {_spelled(2, chr(39))} AS first, {_spelled(3, chr(39))} AS last,
       {_spelled(2, chr(39))} AS first_of_nested
FROM ({_NAME_WORDS} FROM part)
"""


def copy_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [
        Rule("t", "flag", "field", ("l_returnflag",)),
        Rule("t", "status", "field", ("l_linestatus",)),
        Rule("t", "supplier", "field", ("l_suppkey",)),
        Rule("t", "line", "field", ("l_linenumber",)),
    ]
    return project_rules(_table(spark, sf_dir, "lineitem"), rules)


COPY_DISTINCT = """
SELECT DISTINCT l_returnflag AS flag, l_linestatus AS status, l_suppkey AS supplier,
       l_linenumber AS line
FROM lineitem
"""

# --- filters -----------------------------------------------------------------


def trim_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = _table(spark, sf_dir, "part").selectExpr(
        "p_partkey",
        "concat(repeat(' ', p_size), p_name, '  ') AS pi_firstname",
        "CASE WHEN p_type = 'PROMO' THEN NULL ELSE concat(' ', p_brand, chr(9)) END AS pi_lastname",
    )
    return filters.trim_columns(names, ["pi_firstname", "pi_lastname"])


TRIM_COLUMNS = """
SELECT p_partkey, p_name AS pi_firstname,
       CASE WHEN p_type <> 'PROMO' THEN concat(p_brand, chr(9)) END AS pi_lastname
FROM part
"""


def primary_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "user_id",
        "CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'click' THEN 'visit' ELSE '' END"
        " AS instrument",
        "try_cast(CASE WHEN value < 5 THEN '' ELSE cast(floor(value) AS string) END AS int) AS instance",
    )
    return filters.primary_records("instrument", "instance")(events).kept


PRIMARY_FILTER = """
SELECT event_id, user_id, '' AS instrument, cast(NULL AS int) AS instance
FROM events WHERE event_type NOT IN ('error', 'click') AND value < 5
"""


def test_record_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _table(spark, sf_dir, "part").selectExpr(
        "p_partkey",
        "CASE p_type WHEN 'PROMO' THEN '' WHEN 'SMALL' THEN p_brand WHEN 'LARGE' THEN NULL"
        " ELSE p_name END AS title",
        "CASE WHEN p_size <= 10 THEN '' WHEN p_size <= 20 THEN NULL"
        " WHEN p_size <= 35 THEN upper(split_part(p_name, ' ', 1)) ELSE p_brand END AS first",
        "CASE WHEN p_retailprice < 950 THEN '' WHEN p_retailprice < 1000 THEN p_brand"
        " ELSE upper(split_part(p_name, ' ', 2)) END AS last",
    )
    kept, rejected = filters.split_test_records("title", "first", "last")(parts)
    sides = [kept.withColumn("side", F.lit("kept")), rejected.withColumn("side", F.lit("test"))]
    return sides[0].unionByName(sides[1])


TEST_RECORD_SPLIT = """
SELECT p_partkey,
       CASE p_type WHEN 'PROMO' THEN '' WHEN 'SMALL' THEN p_brand WHEN 'LARGE' THEN NULL
         ELSE p_name END AS title,
       CASE WHEN p_size <= 10 THEN '' WHEN p_size <= 20 THEN NULL
         WHEN p_size <= 35 THEN upper(split_part(p_name, ' ', 1)) ELSE p_brand END AS first,
       CASE WHEN p_retailprice < 950 THEN '' WHEN p_retailprice < 1000 THEN p_brand
         ELSE upper(split_part(p_name, ' ', 2)) END AS last,
       CASE WHEN p_type IN ('PROMO', 'SMALL', 'LARGE')
              OR (p_size > 35 AND p_retailprice >= 950 AND p_retailprice < 1000)
         THEN 'test' ELSE 'kept' END AS side
FROM part
"""

# --- lists -------------------------------------------------------------------


def enrich_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS rid", "cast(o_custkey AS int) AS custkey", "o_orderstatus AS status"
    )
    # Entries with a blank key match nothing, so some records stay unmatched.
    by_customer = _table(spark, sf_dir, "customer").selectExpr(
        "CASE WHEN c_acctbal > 0 THEN cast(c_custkey AS string) END AS custkey",
        "cast(c_nationkey AS string) AS nk",
        "explode(CASE WHEN c_mktsegment = 'BUILDING' THEN array('a', 'b') ELSE array('a') END) AS copy",
    )
    by_nation = _table(spark, sf_dir, "nation").selectExpr(
        "CASE WHEN n_regionkey < 3 THEN cast(n_nationkey AS string) END AS nk", "n_name AS nation"
    )
    return lists.enrich_all([by_customer, by_nation])(records).kept


ENRICH_LEFT = """
WITH c AS (
  SELECT cast(c_custkey AS int) AS custkey, cast(c_nationkey AS varchar) AS nk, 'a' AS copy
  FROM customer WHERE c_acctbal > 0
  UNION ALL
  SELECT cast(c_custkey AS int), cast(c_nationkey AS varchar), 'b'
  FROM customer WHERE c_acctbal > 0 AND c_mktsegment = 'BUILDING'),
n AS (SELECT cast(n_nationkey AS varchar) AS nk, n_name AS nation FROM nation WHERE n_regionkey < 3)
SELECT o_orderkey AS rid, cast(o_custkey AS int) AS custkey, o_orderstatus AS status,
       c.nk, c.copy, n.nation
FROM orders LEFT JOIN c ON c.custkey = o_custkey LEFT JOIN n ON n.nk = c.nk
"""


def restrict_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "cast(l_partkey AS int) AS partkey", "l_quantity"
    )
    promoted = _table(spark, sf_dir, "part").where("p_type = 'PROMO'")
    entries = promoted.selectExpr("cast(p_partkey AS string) AS partkey", "p_brand AS brand")
    return lists.restrict_all([entries])(records).kept


RESTRICT_INNER = """
SELECT l_orderkey, l_linenumber, cast(l_partkey AS int) AS partkey, l_quantity, p_brand AS brand
FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_type = 'PROMO'
"""


def block_nullsafe(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "cast(l_suppkey AS int) AS suppkey",
        "nullif(l_returnflag, 'N') AS flag", "cast(l_shipdate AS date) AS shipped",
    )
    low = _table(spark, sf_dir, "supplier").where("s_acctbal < 2000")
    by_flag = low.selectExpr(
        "cast(s_suppkey AS string) AS suppkey", "CASE WHEN s_nationkey < 12 THEN NULL ELSE 'A' END AS flag"
    )
    days = _table(spark, sf_dir, "orders").selectExpr(
        "CASE WHEN o_totalprice > 499000 THEN date_format(o_orderdate, 'yyyy-MM-dd')"
        " ELSE date_format(o_orderdate, 'yyyy/MM/dd') END AS shipped"
    )
    return lists.block_all([by_flag.union(by_flag), days])(records).kept


BLOCK_NULLSAFE = """
WITH rec AS (SELECT l_orderkey, l_linenumber, cast(l_suppkey AS int) AS suppkey,
    nullif(l_returnflag, 'N') AS flag, cast(l_shipdate AS date) AS shipped FROM lineitem)
SELECT * FROM rec
WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_acctbal < 2000 AND s_suppkey = rec.suppkey
    AND CASE WHEN s_nationkey < 12 THEN NULL ELSE 'A' END IS NOT DISTINCT FROM rec.flag)
  AND NOT EXISTS (SELECT 1 FROM orders WHERE o_totalprice > 499000
    AND cast(o_orderdate AS date) = rec.shipped)
"""

# --- keys --------------------------------------------------------------------


def generate_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "nullif(l_returnflag, 'N') AS flag"
    )
    parts = [ex.field("l_partkey"), ex.field("l_suppkey"), ex.field("flag")]
    return keys.generate_ids(records, parts, "gid")


GENERATE_ID = """
WITH rec AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, nullif(l_returnflag, 'N') AS flag
  FROM lineitem),
k AS (SELECT DISTINCT l_partkey, l_suppkey, flag FROM rec WHERE flag IS NOT NULL),
i AS (SELECT *, row_number() OVER (ORDER BY
    md5(concat_ws(chr(31), l_partkey, l_suppkey, flag)), l_partkey, l_suppkey, flag) - 1
    AS gid FROM k)
SELECT rec.*, gid FROM rec LEFT JOIN i USING (l_partkey, l_suppkey, flag)
"""

# --- reshapes ----------------------------------------------------------------

_ORDER_FLAGS = (
    "CASE WHEN o_orderstatus = 'F' THEN '1' ELSE '0' END AS mark___done",
    "CASE WHEN o_totalprice > 250000 THEN 1 END AS mark___big",
    "CASE WHEN o_orderdate < '1996-01-01' THEN '1' ELSE '' END AS mark___old",
)


def checkbox_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_custkey", "o_orderpriority", *_ORDER_FLAGS
    )
    flags = reshape.checkbox_groups(records.columns)["mark"]
    pairs = [("o_orderkey", "order_id"), ("o_custkey", "customer_id")]
    ticks = reshape.unpivot_ticks(records, pairs, flags, "mark")
    copied = project_rules(
        records,
        [
            Rule("t", "order_id", "field", ("o_orderkey",)),
            Rule("t", "customer_id", "field", ("o_custkey",)),
            Rule("t", "priority", "field", ("o_orderpriority",)),
        ],
    )
    return reshape.attach_copied(ticks, copied, ["order_id", "customer_id"])


CHECKBOX_UNPIVOT = """
WITH t AS (
  SELECT o_orderkey, 'mark___done' AS mark FROM orders WHERE o_orderstatus = 'F'
  UNION ALL SELECT o_orderkey, 'mark___big' FROM orders WHERE o_totalprice > 250000
  UNION ALL SELECT o_orderkey, 'mark___old' FROM orders WHERE o_orderdate < '1996-01-01')
SELECT o_orderkey AS order_id, o_custkey AS customer_id, mark, o_orderpriority AS priority
FROM t JOIN orders USING (o_orderkey)
"""


def unpivot_bag(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _table(spark, sf_dir, "lineitem").selectExpr(
        "l_suppkey",
        "l_returnflag",
        "CASE WHEN l_quantity > 25 THEN '1' ELSE '0' END AS kind___many",
        "CASE WHEN l_discount > 0.05 THEN '1' END AS kind___cheap",
        "CASE WHEN l_linestatus = 'O' THEN '1' ELSE '' END AS kind___open",
    )
    flags = reshape.checkbox_groups(records.columns)["kind"]
    pairs = [("l_suppkey", "supplier"), ("l_returnflag", "flag")]
    return reshape.unpivot_ticks(records, pairs, flags, "kind")


UNPIVOT_BAG = """
WITH d AS (SELECT DISTINCT l_suppkey AS supplier, l_returnflag AS flag, l_quantity > 25 AS many,
    l_discount > 0.05 AS cheap, l_linestatus = 'O' AS open FROM lineitem)
SELECT supplier, flag, 'kind___many' AS kind FROM d WHERE many
UNION ALL SELECT supplier, flag, 'kind___cheap' FROM d WHERE cheap
UNION ALL SELECT supplier, flag, 'kind___open' FROM d WHERE open
"""


def prefix_to_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "CASE WHEN o_orderstatus = 'F' THEN concat('Reviewer ', o_custkey) ELSE '' END"
        " AS reviewer_name_north",
        "CASE WHEN o_orderpriority = '5-LOW' THEN concat('Reviewer ', o_custkey) END"
        " AS reviewer_name_south_east",
        "o_orderpriority AS reviewer_name_w",
    )
    return reshape.prefixed_to_long(records, "reviewer_name_", "reviewer", "organization")


PREFIX_TO_LONG = """
SELECT DISTINCT concat('Reviewer ', o_custkey) AS reviewer, 'north' AS organization
FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT DISTINCT concat('Reviewer ', o_custkey), 'south_east' FROM orders WHERE o_orderpriority = '5-LOW'
UNION ALL
SELECT DISTINCT o_orderpriority, 'w' FROM orders
"""

# --- dictionary --------------------------------------------------------------


def choice_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = _table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        # A blank list, a malformed one (no space after a comma), or three choices.
        "CASE WHEN l_discount = 0 THEN '' ELSE concat(' 1_', l_suppkey,"
        " CASE WHEN l_discount = 0.1 THEN ',' ELSE ', ' END, l_returnflag, ', part ', l_partkey,"
        " ' | 2 , ', l_linestatus, chr(9), '|  3, ') END AS choices",
    )
    return dictionary.explode_choices(entries, "choices")


CHOICE_EXPLODE = """
WITH c AS (SELECT * FROM lineitem WHERE l_discount <> 0 AND l_discount <> 0.1)
SELECT l_orderkey, l_linenumber, concat('1_', l_suppkey) AS index,
       concat(l_returnflag, ', part ', l_partkey) AS description FROM c
UNION ALL SELECT l_orderkey, l_linenumber, '2', l_linestatus FROM c
UNION ALL SELECT l_orderkey, l_linenumber, '3', '' FROM c
"""


def label_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = _table(spark, sf_dir, "orders").selectExpr(
        "concat('order_', o_orderkey) AS field_name",
        "'' AS field_label",
        "CASE o_orderstatus WHEN 'P' THEN '' ELSE concat('1, ', o_orderpriority, '| 2, ', o_custkey) END"
        " AS select_choices_or_calculations",
    )
    members = _table(spark, sf_dir, "supplier").selectExpr(
        "concat('ctsa_', s_suppkey)", "s_name", "''"
    )
    rules = _table(spark, sf_dir, "lineitem").selectExpr(
        "array(concat('order_', l_orderkey), 'order_1') AS sources",
        "nullif(l_returnflag, 'N') AS table",
        "l_linestatus AS column",
    )
    return dictionary.label_dimension(fields.union(members), rules)


LABEL_DIM = """
WITH c AS (SELECT o_orderkey, '1' AS index, o_orderpriority AS description FROM orders
    WHERE o_orderstatus <> 'P'
  UNION ALL SELECT o_orderkey, '2', cast(o_custkey AS varchar) FROM orders WHERE o_orderstatus <> 'P')
SELECT nullif(l_returnflag, 'N') AS "table", l_linestatus AS "column", index, description,
       concat('order_', o_orderkey, '___', index) AS id
FROM c JOIN lineitem ON o_orderkey = l_orderkey
UNION ALL
SELECT 'Submitter', 'submitterInstitution', cast(s_suppkey AS varchar), s_name,
       concat('org_name___', s_suppkey)
FROM supplier
"""


def member_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = _table(spark, sf_dir, "supplier").selectExpr(
        "CASE WHEN s_nationkey < 12 THEN concat('ctsa_', s_suppkey)"
        " WHEN s_nationkey < 18 THEN concat('ctsa_x', s_suppkey) ELSE s_name END AS field_name",
        "s_name AS field_label",
    )
    return dictionary.member_rows(fields)


MEMBER_ROWS = """
SELECT 'org_name' AS field_name, 'Submitter' AS "table", 'submitterInstitution' AS "column",
       cast(s_suppkey AS varchar) AS index, s_name AS description
FROM supplier WHERE s_nationkey < 12
"""

# --- rules as rows -----------------------------------------------------------


def _part_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "part").selectExpr(
        "cast(p_partkey AS int) AS ordinal",
        "nullif(p_brand, 'Brand#1') AS table",
        "p_type AS column",
        "split(p_name, ' ') AS sources",
    )


def rule_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = rule_plans.route(_part_rules(spark, sf_dir), ["red", "ring", "hot"])
    return routed.select("ordinal", "table", "column")


RULE_ROUTING = """
SELECT cast(p_partkey AS int) AS ordinal, p_brand AS "table", p_type AS "column" FROM part
WHERE p_brand <> 'Brand#1' AND (split_part(p_name, ' ', 1) IN ('red', 'hot')
  OR split_part(p_name, ' ', 2) = 'ring')
"""


def rule_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_plans.lineage(_part_rules(spark, sf_dir))


RULE_LINEAGE = """
WITH r AS (SELECT cast(p_partkey AS int) AS ordinal, nullif(p_brand, 'Brand#1') AS "table",
    p_type AS "column", p_name FROM part)
SELECT ordinal, "table", "column", split_part(p_name, ' ', 1) AS source FROM r
UNION ALL SELECT ordinal, "table", "column", split_part(p_name, ' ', 2) FROM r
"""


def pk_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = _table(spark, sf_dir, "part").selectExpr(
        "p_size AS ordinal",
        "p_brand AS table",
        "p_type AS column",
        "array(p_type) AS sources",
        "'text' AS type",
        "p_size > 30 AS primary",
    )
    listed = F.transform("columns", lambda c: F.concat_ws(":", c["ordinal"].cast("string"), c["column"]))
    key_lists = rule_plans.primary_keys(rules.distinct())
    return key_lists.select("table", F.array_join(listed, ",").alias("columns"))


PK_LISTS = """
WITH r AS (SELECT DISTINCT p_size, p_brand, p_type FROM part WHERE p_size > 30)
SELECT p_brand AS "table", string_agg(concat(p_size, ':', p_type), ',' ORDER BY p_size, p_type) AS columns
FROM r GROUP BY p_brand
"""


def having(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_plans.counted_above(_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


HAVING = """
SELECT l_orderkey, l_linenumber, count(*) AS count FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
"""


def bag_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = _table(spark, sf_dir, "lineitem")
    present = lineitem.selectExpr("concat('part_', l_partkey) AS column")
    mapped = lineitem.selectExpr("concat(CASE l_returnflag WHEN 'R' THEN 'part_' ELSE 'other_' END, l_partkey) AS column")
    mapped = mapped.union(_table(spark, sf_dir, "part").selectExpr("p_name"))
    unknown = reports.bag_difference(present, mapped).withColumn("report", F.lit("unknown"))
    missing = reports.bag_difference(mapped, present).withColumn("report", F.lit("missing"))
    return unknown.unionByName(missing)


BAG_DIFF = """
WITH p AS (SELECT concat('part_', l_partkey) AS "column" FROM lineitem),
m AS (SELECT concat(CASE l_returnflag WHEN 'R' THEN 'part_' ELSE 'other_' END, l_partkey) AS "column" FROM lineitem
  UNION ALL SELECT p_name FROM part)
SELECT "column", 'unknown' AS report FROM (SELECT * FROM p EXCEPT ALL SELECT * FROM m)
UNION ALL SELECT "column", 'missing' FROM (SELECT * FROM m EXCEPT ALL SELECT * FROM p)
"""


def set_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = _table(spark, sf_dir, "orders").selectExpr("o_custkey AS column")
    known = _table(spark, sf_dir, "customer").selectExpr("CASE WHEN c_acctbal > 0 THEN c_custkey ELSE -c_custkey END")
    return reports.set_difference(ordered, known)


SET_DIFF = """
SELECT o_custkey AS "column" FROM orders EXCEPT SELECT c_custkey FROM customer WHERE c_acctbal > 0
"""

# --- sources and sinks -------------------------------------------------------


def json_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "nullif(o_orderstatus, 'P') AS status",
        "o_totalprice AS price",
        "o_totalprice > 250000 AS big",
        "named_struct('c', o_custkey) AS customer",
    )
    path = Staging(spark).folder("records_json")
    records.write.json(path)
    return read_json_strings(spark, path, lines=True)


JSON_STRINGS = """
SELECT cast(o_orderkey AS varchar) AS o_orderkey, nullif(o_orderstatus, 'P') AS status,
       cast(o_totalprice AS varchar) AS price, CASE WHEN o_totalprice > 250000 THEN 'true' ELSE 'false'
       END AS big, concat('{"c":', o_custkey, '}') AS customer
FROM orders
"""


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _table(spark, sf_dir, "part").selectExpr(
        "p_partkey",
        "CASE p_type WHEN 'PROMO' THEN '' WHEN 'SMALL' THEN NULL"
        " WHEN 'LARGE' THEN concat('say \"', p_name, '\", twice\\n', p_size) ELSE p_name END AS label",
        "concat(p_brand, ',', p_size) AS brand",
    )
    path = Staging(spark).folder("parts_csv")
    write_csv(table, path)
    return read_csv(spark, path, split_bytes=0)


CSV_ROUNDTRIP = """
SELECT cast(p_partkey AS varchar) AS p_partkey,
       CASE WHEN p_type IN ('PROMO', 'SMALL') THEN NULL
         WHEN p_type = 'LARGE' THEN concat('say "', p_name, '", twice' || chr(10), p_size) ELSE p_name END AS label,
       concat(p_brand, ',', p_size) AS brand
FROM part
"""

# --- the job -----------------------------------------------------------------


def _job_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    records = _table(spark, sf_dir, "orders").selectExpr(
        "cast(o_orderkey AS string) AS rid",
        "cast(o_custkey AS string) AS custkey",
        "o_orderstatus AS status",
        "CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE o_orderpriority END AS note",
        "CASE WHEN o_orderstatus = 'P' THEN 'visit' ELSE '' END AS redcap_repeat_instrument",
        "CASE WHEN o_orderpriority = '1-URGENT' THEN '2' ELSE '' END AS redcap_repeat_instance",
        "CASE WHEN o_totalprice > 250000 THEN '1' ELSE '0' END AS mark___big",
        "CASE WHEN o_orderdate < '1998-01-01' THEN '1' ELSE '' END AS mark___old",
    )
    customers = _table(spark, sf_dir, "customer").selectExpr(
        "cast(c_custkey AS string) AS custkey",
        "cast(c_nationkey AS string) AS nk",
        "nullif(c_mktsegment, 'MACHINERY') AS seg",
    )
    nation = _table(spark, sf_dir, "nation")
    names = nation.selectExpr("CASE WHEN n_regionkey < 4 THEN cast(n_nationkey AS string) END AS nk", "n_name")
    listed = nation.selectExpr("CASE WHEN n_nationkey < 20 THEN cast(n_nationkey AS string) END AS nk")
    blocked = _table(spark, sf_dir, "supplier").selectExpr(
        "CASE WHEN s_acctbal < 0 THEN cast(s_nationkey AS string) ELSE 'none' END AS nk",
        "CASE WHEN s_nationkey < 10 THEN NULL ELSE 'HOUSEHOLD' END AS seg",
    )
    rules = [
        Rule("order_fact", "rid", "field", ("rid",), "int", primary=True),
        Rule("order_fact", "gid", "generate_id", ("seg", "nk"), "int"),
        Rule("order_fact", "label", "first_nonblank", ("note", "status")),
        Rule("order_fact", "nation", "field", ("n_name",)),
        Rule("order_fact", "tag", "field", ("mark",)),
        Rule("market", "gid", "generate_id", ("seg", "nk"), "int", primary=True),
        Rule("market", "segment", "if_equal", ("seg", '"HOUSEHOLD"', '"home"', "seg")),
        Rule("market", "nation", "field", ("n_name",)),
        Rule(None, "unused", "field", ("status",)),
        Rule("market", "later", "none"),
    ]
    return Inputs(records, rules, enrich=[customers, names], restrict=[listed], block=[blocked])


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return MappedRecords(_job_inputs(spark, sf_dir), Staging(spark)).mapped_tables["order_fact"]


def nested_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = _job_inputs(spark, sf_dir)
    inputs.rules += [
        Rule("order_fact", "nested_id", "generate_id",
             (node("first_nonblank", "note", "status"), node("if_equal", "seg", '"HOUSEHOLD"', '"home"', "nk"))),
    ]
    mapped = MappedRecords(inputs, Staging(spark))
    return mapped.records_with_ids.select("rid", "nested_id")


def chain_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _table(spark, sf_dir, "part")
    records = parts.selectExpr(
        "p_partkey", "CASE p_type WHEN 'PROMO' THEN 'visit' ELSE '' END AS instrument",
        "CASE WHEN p_size > 40 THEN 2 END AS instance",
        "CASE WHEN p_size < 10 THEN p_brand ELSE p_name END AS title",
        "CASE WHEN p_size % 3 = 0 THEN upper(split_part(p_name, ' ', 1)) ELSE p_name END AS first",
        "CASE WHEN p_size % 3 = 0 THEN upper(split_part(p_name, ' ', 2)) ELSE p_name END AS last",
        "p_brand AS brand", "nullif(p_type, 'LARGE') AS kind",
    )
    labelled = parts.selectExpr("p_brand AS brand", "left(p_brand, 7) AS family").distinct()
    listed = parts.selectExpr("p_brand AS brand").where("brand NOT LIKE '%3'").distinct()
    blocked = parts.where("p_type IN ('SMALL', 'LARGE')").selectExpr("p_brand AS brand", "nullif(p_type, 'LARGE') AS kind")
    staging = Staging(spark)
    stages = [
        ("primary", filters.primary_records("instrument", "instance")),
        ("all", filters.keep_all),
        ("enrich", lists.enrich_all([labelled])),
        ("restrict", lists.restrict_all([listed])),
        ("block", lists.block_all([blocked.where("brand <> 'Brand#7'")])),
        ("test", filters.split_test_records("title", "first", "last")),
    ]
    kept, rejects = filters.run_stages(records, stages, lambda df, by: staging.table(df, "marked", by))
    found = kept.withColumn("stage", F.lit("kept"))
    for name, rows in rejects.items():
        found = found.unionByName(rows.withColumn("stage", F.lit(name)), allowMissingColumns=True)
    return found.select("p_partkey", "title", "family", "stage")


def rules_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = _table(spark, sf_dir, "part").selectExpr(
        "CASE WHEN p_size % 2 = 0 THEN 'yes' WHEN p_size % 3 = 0 THEN NULL ELSE 'no' END AS initialize",
        "p_size AS ordinal", "p_brand AS table", "p_name AS column", "'field' AS kind",
        "array(p_type) AS sources", "array(p_type) AS args", "'text' AS type", "'yes' AS primary", "p_partkey AS note",
    )
    return rule_plans.selected(rules).selectExpr("ordinal", "table", "column", "kind", "args[0] AS arg", "type", "primary")


def lists_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _table(spark, sf_dir, "orders").selectExpr("o_orderkey", "cast(o_custkey AS int) AS custkey")
    path = Staging(spark).folder("lists")
    customer = _table(spark, sf_dir, "customer").selectExpr(
        "CASE WHEN c_acctbal > 0 THEN c_custkey END AS custkey", "cast(c_nationkey AS string) AS nk",
        "concat(c_mktsegment, ', \"', c_custkey, '\"\n', c_nationkey, ',\\\\') AS note",
    )
    write_csv(customer, f"{path}/1_customer")
    write_csv(_table(spark, sf_dir, "nation").selectExpr("n_nationkey AS nk", "n_name AS nation"), f"{path}/2_nation")
    return lists.enrich_all(read_lists(spark, path))(records).kept


def json_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "orders").selectExpr(
        "struct(o_orderkey, nullif(o_orderstatus, 'P') AS status, concat('\"', o_orderpriority, '},{\\\\') AS note,"
        " struct(o_custkey AS c, array(o_orderkey % 7) AS d) AS customer, o_totalprice > 250000 AS big) AS r",
        # Rows as they are read, so that no key, however often it comes, makes an array longer.
        "monotonically_increasing_id() div 20000 AS part",
    )
    # A few arrays in each task, however many there are.
    arrays = rows.repartition(rows.count() // 20000 + 1, "part").groupBy("part").agg(F.to_json(F.collect_list("r")).alias("value"))
    path = Staging(spark).folder("records_array")
    # One array document per file, each of at most 20,000 records.
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return read_json_strings(spark, path, split_bytes=0)


def tables_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Staging(spark).folder("out")
    write_tables({"part": _table(spark, sf_dir, "part").select("p_partkey", "p_brand"), "nation": _table(spark, sf_dir, "nation").select("n_nationkey", "n_name")}, path)
    part, nation = (spark.read.csv(f"{path}/tables/{t}", header=True) for t in ("part", "nation"))
    return part.toDF("key", "label").withColumn("table", F.lit("part")).union(nation.withColumn("table", F.lit("nation")))


def report_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Staging(spark).folder("report")
    write_report(_table(spark, sf_dir, "part").selectExpr("concat(p_name, ', ', p_brand) AS column"), path)
    return spark.read.csv(path, schema="column string", escape='"')


def counted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem, observed = reports.counted(_table(spark, sf_dir, "lineitem").select("l_orderkey"), "lineitem_rows")
    path = Staging(spark).folder("counted")
    lineitem.write.parquet(path)
    written = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("written"))
    return written.withColumn("counted", F.lit(observed.get["rows"]).cast("long"))


def shared_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return MappedRecords(_job_inputs(spark, sf_dir), Staging(spark)).mapped_tables["market"]


def registered_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_orderdate", "o_custkey AS part0", "o_orderstatus AS part1")
    staging = Staging(spark)
    registry = KeyRegistry(spark, staging.folder("ids"))
    parts = ("o_custkey", "o_orderstatus")
    first = staging.cut(orders.where("o_orderdate < '1995-06-17'").select("part0", "part1").distinct())
    registry.numbered(parts, first)
    # A later run over more orders: the keys met before keep their ids.
    later = staging.cut(orders.select("part0", "part1").distinct())
    ids = registry.numbered(parts, later)
    return keys.attach_keys(orders, [orders.part0, orders.part1], ids, ["gid"]).selectExpr("o_orderkey", "part0 AS custkey", "gid")


REGISTERED_IDS = """
WITH k AS (SELECT DISTINCT o_custkey AS a, o_orderstatus AS b, md5(concat_ws(chr(31), o_custkey, o_orderstatus)) AS h FROM orders),
f AS (SELECT DISTINCT o_custkey AS a, o_orderstatus AS b FROM orders WHERE o_orderdate < '1995-06-17'),
i AS (SELECT k.*, row_number() OVER (ORDER BY (f.a IS NULL), h, k.a, k.b) - 1 AS gid
  FROM k LEFT JOIN f ON f.a = k.a AND f.b = k.b)
SELECT o_orderkey, o_custkey AS custkey, gid FROM orders JOIN i ON a = o_custkey AND b = o_orderstatus
"""


_JOB = """
WITH rec AS (SELECT cast(o_orderkey AS int) AS rid, cast(c_nationkey AS varchar) AS nk,
    nullif(c_mktsegment, 'MACHINERY') AS seg, o_orderstatus AS status, o_totalprice, o_orderdate,
    CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE o_orderpriority END AS note
  FROM orders LEFT JOIN customer ON c_custkey = o_custkey
  WHERE o_orderstatus <> 'P' AND o_orderpriority <> '1-URGENT'),
blk AS (SELECT cast(s_nationkey AS varchar) AS nk,
    CASE WHEN s_nationkey < 10 THEN NULL ELSE 'HOUSEHOLD' END AS seg FROM supplier WHERE s_acctbal < 0),
d AS (SELECT rec.*, n_name FROM rec
  LEFT JOIN (SELECT cast(n_nationkey AS varchar) AS nk, n_name FROM nation WHERE n_regionkey < 4) USING (nk)
  WHERE cast(nk AS int) < 20 AND NOT EXISTS (SELECT 1 FROM blk
    WHERE blk.nk IS NOT DISTINCT FROM rec.nk AND blk.seg IS NOT DISTINCT FROM rec.seg)),
k AS (SELECT DISTINCT seg, nk FROM d WHERE seg IS NOT NULL AND nk IS NOT NULL),
i AS (SELECT *, row_number() OVER (
    ORDER BY md5(concat_ws(chr(31), seg, nk)), seg, nk) - 1 AS gid FROM k)
"""
FLAGSHIP = _JOB + """,
u AS (SELECT rid, 'mark___big' AS tag FROM d WHERE o_totalprice > 250000
  UNION ALL SELECT rid, 'mark___old' FROM d WHERE o_orderdate < '1998-01-01')
SELECT rid, tag, gid, coalesce(nullif(note, ''), status) AS label, n_name AS nation
FROM u JOIN d USING (rid) LEFT JOIN i USING (seg, nk)
"""
NESTED_IDS = _JOB + """,
n AS (SELECT rid, coalesce(nullif(note, ''), status) AS p0,
    CASE WHEN seg = 'HOUSEHOLD' THEN 'home' ELSE nk END AS p1 FROM d),
m AS (SELECT *, row_number() OVER (ORDER BY md5(concat_ws(chr(31), p0, p1)), p0, p1) - 1 AS nested_id
  FROM (SELECT DISTINCT p0, p1 FROM n WHERE p0 IS NOT NULL AND p1 IS NOT NULL))
SELECT rid, nested_id FROM n LEFT JOIN m USING (p0, p1)
"""
CHAIN_REJECTS = """
WITH staged AS (
  SELECT *, CASE WHEN p_type = 'PROMO' OR p_size > 40 THEN 'primary' WHEN p_brand LIKE '%3' THEN 'restrict'
    WHEN p_type IN ('SMALL', 'LARGE') AND p_brand <> 'Brand#7' THEN 'block'
    WHEN p_size < 10 OR p_size % 3 <> 0 THEN 'test' ELSE 'kept' END AS stage FROM part)
SELECT p_partkey, CASE WHEN p_size < 10 THEN p_brand ELSE p_name END AS title,
       CASE WHEN stage <> 'primary' THEN left(p_brand, 7) END AS family, stage
FROM staged
"""
RULES_SELECTED = """
SELECT p_size AS ordinal, p_brand AS "table", p_name AS "column", 'field' AS kind, p_type AS arg, 'text' AS type,
       'yes' AS "primary"
FROM part WHERE p_size % 2 = 0
"""
LISTS_FROM_FILES = r"""
SELECT o_orderkey, cast(o_custkey AS int) AS custkey, cast(c_nationkey AS varchar) AS nk,
       c_mktsegment || ', "' || c_custkey || '"' || chr(10) || c_nationkey || ',\' AS note, n_name AS nation
FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_acctbal > 0
LEFT JOIN nation ON n_nationkey = c_nationkey
"""
JSON_ARRAY = r"""
SELECT cast(o_orderkey AS varchar) AS o_orderkey, nullif(o_orderstatus, 'P') AS status,
       concat('"', o_orderpriority, '},{\') AS note,
       concat('{"c":', o_custkey, ',"d":[', o_orderkey % 7, ']}') AS customer,
       CASE WHEN o_totalprice > 250000 THEN 'true' ELSE 'false' END AS big
FROM orders
"""
TABLES_ROUNDTRIP = """
SELECT cast(p_partkey AS varchar) AS key, p_brand AS label, 'part' AS "table" FROM part
UNION ALL SELECT cast(n_nationkey AS varchar), n_name, 'nation' FROM nation
"""
REPORT_ROUNDTRIP = """SELECT concat(p_name, ', ', p_brand) AS "column" FROM part"""
COUNTED_ROWS = """SELECT count(*) AS written, count(*) AS counted FROM lineitem"""
SHARED_IDS = _JOB + """
SELECT DISTINCT gid, CASE WHEN seg = 'HOUSEHOLD' THEN 'home' ELSE seg END AS segment, n_name AS nation
FROM d LEFT JOIN i USING (seg, nk)
"""

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, tuple[Query, str]] = {
    "cast_declared": (cast_declared, CAST_DECLARED),
    "blank_coalesce": (blank_coalesce, BLANK_COALESCE),
    "if_equal": (if_equal, IF_EQUAL),
    "person_name": (person_name, PERSON_NAME),
    "copy_distinct": (copy_distinct, COPY_DISTINCT),
    "trim_columns": (trim_columns, TRIM_COLUMNS),
    "primary_filter": (primary_filter, PRIMARY_FILTER),
    "test_record_split": (test_record_split, TEST_RECORD_SPLIT),
    "enrich_left": (enrich_left, ENRICH_LEFT),
    "restrict_inner": (restrict_inner, RESTRICT_INNER),
    "block_nullsafe": (block_nullsafe, BLOCK_NULLSAFE),
    "generate_id": (generate_id, GENERATE_ID),
    "checkbox_unpivot": (checkbox_unpivot, CHECKBOX_UNPIVOT),
    "unpivot_bag": (unpivot_bag, UNPIVOT_BAG),
    "prefix_to_long": (prefix_to_long, PREFIX_TO_LONG),
    "choice_explode": (choice_explode, CHOICE_EXPLODE),
    "label_dim": (label_dim, LABEL_DIM),
    "member_rows": (member_rows, MEMBER_ROWS),
    "rule_routing": (rule_routing, RULE_ROUTING),
    "rule_lineage": (rule_lineage, RULE_LINEAGE),
    "pk_lists": (pk_lists, PK_LISTS),
    "having": (having, HAVING),
    "bag_diff": (bag_diff, BAG_DIFF),
    "set_diff": (set_diff, SET_DIFF),
    "json_strings": (json_strings, JSON_STRINGS),
    "csv_roundtrip": (csv_roundtrip, CSV_ROUNDTRIP),
    "shared_ids": (shared_ids, SHARED_IDS),
    "flagship": (flagship, FLAGSHIP),
    "nested_rules": (nested_rules, NESTED_RULES),
    "nested_ids": (nested_ids, NESTED_IDS),
    "chain_rejects": (chain_rejects, CHAIN_REJECTS),
    "rules_selected": (rules_selected, RULES_SELECTED),
    "lists_from_files": (lists_from_files, LISTS_FROM_FILES),
    "json_array": (json_array, JSON_ARRAY),
    "tables_roundtrip": (tables_roundtrip, TABLES_ROUNDTRIP),
    "report_roundtrip": (report_roundtrip, REPORT_ROUNDTRIP),
    "counted_rows": (counted_rows, COUNTED_ROWS),
    "registered_ids": (registered_ids, REGISTERED_IDS),
}


def entry(spark: SparkSession) -> DataFrame:
    """The flagship on the smallest tables."""
    return flagship(spark, SMOKE_DIR)


def _training_data() -> list:
    """The modules of the training-data operators that are present."""
    if importlib.util.find_spec("mapweave.llm") is None:
        return []
    names = ["mapweave.llm.queries", "corpus_pipeline"]
    return [importlib.import_module(n) for n in names if importlib.util.find_spec(n)]


def queries() -> dict[str, Query]:
    found = {name: query for name, (query, _) in _QUERIES.items()}
    for module in _training_data():
        found |= module.queries()
    return found


def oracle_sql() -> dict[str, str]:
    found = {name: sql for name, (_, sql) in _QUERIES.items()}
    for module in _training_data():
        found |= module.oracle_sql()
    return found
