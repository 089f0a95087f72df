"""Whole loads and joins on small inputs with known outcomes."""

import datetime as dt

from pyspark.sql import functions as F

from tableworks import (
    broadcast_join,
    bucketed_join,
    coalesce_join,
    conditional_join,
    equi_join,
    interval_join,
    join_data,
    load_data,
    multi_table_join,
    normalize_text,
    range_join,
    scd2_current,
    write_bucketed,
)
from tableworks.plans.workloads import order_amounts
from tests import fixtures as fx


def _members(spark, rows=fx.MEMBERS):
    return spark.createDataFrame(rows, fx.MEMBER_SCHEMA)


def _library(spark):
    return (
        spark.createDataFrame(fx.READERS, fx.READER_SCHEMA),
        spark.createDataFrame(fx.LOANS, fx.LOAN_SCHEMA),
        spark.createDataFrame(fx.TITLES, fx.TITLE_SCHEMA),
        spark.createDataFrame(fx.TERMS, fx.TERM_SCHEMA),
    )


def test_delete_insert_filtered(spark, fresh):
    name = fresh("di")
    load_data(_members(spark), name, "delete_insert")
    out = load_data(_members(spark, fx.MEMBER_FIXES), name, "delete_insert", filter_condition="member_no IN (11, 14)")
    assert {r.member_no: r.full_name for r in out.collect()} == {
        11: "Ada Quill-Roe", 12: "Ben Marrow", 13: "Cleo Finch", 14: "Dov Larch",
    }


def test_delete_insert_full_refresh(spark, fresh):
    name = fresh("di_full")
    load_data(_members(spark), name, "delete_insert")
    out = load_data(_members(spark, fx.MEMBER_FIXES), name, "delete_insert")
    assert sorted(r.member_no for r in out.collect()) == [11, 14]


def test_merge_upsert(spark, fresh):
    name = fresh("upsert")
    load_data(_members(spark), name, "merge_upsert", merge_keys=["member_no"])
    out = load_data(_members(spark, fx.MEMBER_FIXES), name, "merge_upsert", merge_keys=["member_no"])
    rows = {r.member_no: tuple(r)[1:] for r in out.collect()}
    assert rows == {m[0]: m[1:] for m in [*fx.MEMBERS[1:], *fx.MEMBER_FIXES]}


def test_scd2(spark, fresh):
    name = fresh("scd2")
    t1, t2 = dt.datetime(2022, 4, 1), dt.datetime(2022, 9, 1)
    load_data(_members(spark), name, "scd_type2", business_keys=["member_no"], effective_date=t1)
    out = load_data(_members(spark, fx.MEMBER_MOVES), name, "scd_type2", business_keys=["member_no"], effective_date=t2)
    assert out.columns[-3:] == ["effective_date", "is_current", "expiry_date"]
    assert scd2_current(out).count() == 4
    got = {(r.member_no, r.branch, r.tier, r.effective_date, r.is_current, r.expiry_date) for r in out.collect()}
    assert got == {
        (11, "North", "basic", t1, False, t2), (11, "Harbour", "basic", t2, True, None),
        (12, "South", "basic", t1, False, t2), (12, "South", "gold", t2, True, None),
        (13, "East", "paused", t1, True, None), (15, "Hill", "basic", t2, True, None),
    }


def test_basic_joins(spark):
    readers, loans, _, _ = _library(spark)
    counts = {how: equi_join(readers, loans, ["member_no"], how).count() for how in ("inner", "left", "right", "outer")}
    assert counts == {"inner": 3, "left": 5, "right": 4, "outer": 6}


def test_join_key_is_not_ambiguous(spark):
    readers, loans, _, _ = _library(spark)
    out = equi_join(readers, loans, ["member_no"], "full_outer", ["member_no", "loan_no"])
    assert {(r.member_no, r.loan_no) for r in out.collect()} == {
        (1, 901), (1, 902), (2, 903), (3, None), (4, None), (9, 904),
    }


IN_TERM = "left_table.taken >= right_table.first_day AND left_table.taken <= right_table.last_day"
LOAN_TERMS = [(901, "first half"), (902, "first half"), (903, "first half"), (904, "second half")]


def test_join_data_dispatch(spark):
    readers, loans, _, terms = _library(spark)
    assert join_data(readers, loans, ["member_no"], "basic", "left").count() == 5
    assert join_data(loans, readers, ["member_no"], "broadcast", "inner").count() == 3
    assert join_data(loans, terms, strategy="advanced", join_condition=IN_TERM).count() == 4


def test_conditional_join_terms(spark):
    _, loans, _, terms = _library(spark)
    out = conditional_join(loans, terms, IN_TERM, ["loan_no", "term"])
    assert sorted(map(tuple, out.collect())) == LOAN_TERMS


def test_interval_join_terms(spark):
    _, loans, _, terms = _library(spark)
    out = interval_join(loans, terms, "taken", "first_day", "last_day", select_columns=["loan_no", "term"])
    assert sorted(map(tuple, out.collect())) == LOAN_TERMS


def test_range_join_loans_after_joining(spark):
    readers, loans, _, _ = _library(spark)
    for extra in ({}, {"max_broadcast_bytes": 0, "num_bins": 3}):
        out = range_join(loans, readers, "taken", "joined", ">=", ["loan_no", "full_name"], **extra)
        assert {tuple(r) for r in out.collect()} == {(loan[0], r[1]) for loan in fx.LOANS for r in fx.READERS}


def test_multi_table_join(spark):
    readers, loans, titles, _ = _library(spark)
    steps = [
        {"left_key": "member_no", "right_key": "member_no"},
        {"left_key": "title", "right_key": "title", "join_type": "left"},
    ]
    out = multi_table_join([readers, loans, titles], steps, ["table_2.shelf", "table_0.full_name", "table_1.fee"])
    assert sorted(map(tuple, out.collect())) == [("home", "Gus", 25), ("maps", "Fay", 40), ("verse", "Fay", 15)]


def test_coalesce_join(spark):
    schema = "member_no long, phone string, branch string, tier string"
    desk = spark.createDataFrame([(1, "555-1", None, "gold"), (3, None, "East", None)], schema)
    web = spark.createDataFrame([(1, "555-9", "North", None), (2, None, "South", "basic")], schema)
    out = coalesce_join(desk, web, ["member_no"], {"best_phone": ["phone", "phone"], "best_tier": ["tier", "tier"]})
    got = {r.member_no: (r.best_phone, r.best_tier, r.branch) for r in out.collect()}
    assert got == {1: ("555-1", "gold", "North"), 2: (None, "basic", "South"), 3: (None, None, "East")}


def test_broadcast_join_leaves_settings(spark):
    readers, loans, _, _ = _library(spark)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    assert broadcast_join(loans, readers, ["member_no"], "inner", 10).select("loan_no", "full_name").count() == 3
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == before


def test_bucketed_join_of_tables(spark, fresh):
    readers, loans, _, _ = _library(spark)
    lt, rt = fresh("br"), fresh("bl")
    write_bucketed(readers, lt, ["member_no"], 3)
    write_bucketed(loans, rt, ["member_no"], 3)
    assert bucketed_join(spark, lt, rt, ["member_no"]).count() == 3
    assert join_data(lt, rt, ["member_no"], "bucket", "left").count() == 5


def test_order_amounts_program(spark):
    baskets = spark.createDataFrame(fx.BASKETS, fx.BASKET_SCHEMA)
    lines = spark.createDataFrame(fx.LINES, fx.LINE_SCHEMA).toDF("l_orderkey", "item", "l_quantity", "l_extendedprice")
    totals = baskets.join(order_amounts(lines), F.col("order_id") == F.col("l_orderkey")).orderBy("order_id")
    out = normalize_text(totals, "customer").collect()
    assert [(r.customer, r.total_amount) for r in out] == [("uma", 21.5), ("vic", 12.5), ("wes", 48.0)]
