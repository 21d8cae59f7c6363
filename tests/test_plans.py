"""What the plans read, push down and leave out."""

import __spark_entry__ as entry_points
from conftest import SMALL
from mapweave.operators import keys
from mapweave.plans.job import MappedRecords
from mapweave.plans.rules import Rule, project_rules


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_only_used_columns_are_read(spark):
    plan = physical(entry_points.copy_distinct(spark, SMALL))
    assert "ReadSchema: struct<l_suppkey:bigint,l_linenumber:int,l_returnflag:string,l_linestatus:string>" in plan


def test_filters_reach_the_scan(spark):
    events = spark.read.parquet(f"{SMALL}/events.parquet").selectExpr(
        "event_id", "event_type AS instrument", "cast(NULL AS int) AS instance"
    )
    from mapweave.operators.filters import primary_records

    plan = physical(primary_records("instrument", "instance")(events).kept)
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,)]" in plan


def test_tables_without_ids_do_not_join_the_id_tables(spark):
    records = spark.read.parquet(f"{SMALL}/orders.parquet")
    numbered = keys.number_keys(records.select("o_orderstatus"), "id")
    with_ids = keys.attach_keys(records, [records.o_orderstatus], numbered, ["gid"])
    rules = [Rule("t", "customer", "field", ("o_custkey",))]
    assert "Join" not in optimized(project_rules(with_ids, rules))


def test_block_is_an_anti_join_and_ticks_an_expand(spark):
    assert "LeftAnti" in physical(entry_points.block_nullsafe(spark, SMALL))
    assert "Expand" in physical(entry_points.unpivot_bag(spark, SMALL))


def test_same_key_parts_share_one_id_table(spark):
    inputs = entry_points._job_inputs(spark, SMALL)
    inputs.rules.append(Rule("market", "other_id", "generate_id", ("seg", "nk")))
    mapped = MappedRecords(inputs)
    table = mapped.mapped_tables["market"]
    assert optimized(table).count("row_number") == 1
    assert table.where("NOT gid <=> other_id").count() == 0
