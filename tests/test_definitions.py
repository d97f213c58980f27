from __future__ import annotations

import json

import pytest
from helpers import definitions, message, orders, rows
from pyspark.sql import functions as F

from tallyline.operators import route as routing
from tallyline.operators.evaluate import route_and_evaluate
from tallyline.operators.route import route
from tallyline.sources.definitions import (
    BOOTSTRAP,
    DefinitionFeed,
    DefinitionSet,
    definitions_from_rows,
    normalise_documents,
    normalise_table,
    read_definitions,
)


def one(spark, **row):
    return definitions_from_rows(spark, [row]).first()


def test_row_mapping(spark):
    row = one(
        spark,
        refName="b2b_daily_amt",
        eventTypeCodes=["EVT_B2B_RECV"],
        dimensions=["merchantId"],
        windowDays=1,
        sliceGranularity="DAY",
        accScript="current + amount",
        status="ONLINE",
    )
    assert (row.ref_name, row.slice_seconds, row.window_slices) == ("b2b_daily_amt", 86400, 1)
    assert (row.event_type_codes, row.dimensions) == (["EVT_B2B_RECV"], ["merchantId"])


def test_hourly_day_has_24_slices(spark):
    row = one(spark, refName="h", windowDays=1, sliceGranularity="HOUR")
    assert (row.slice_seconds, row.window_slices, row.acc_script) == (3600, 24, "current + 1")


def test_absent_and_null_properties(spark):
    absent = one(spark)
    assert (absent.ref_name, absent.slice_granularity, absent.window_slices) == ("null", "DAY", 1)
    assert (absent.event_type_codes, absent.dimensions, absent.acc_script) == ([], [], "current + 1")
    null = one(spark, refName=7, eventTypeCodes=None, dimensions=None, windowDays=None, accScript=None)
    assert (null.ref_name, null.event_type_codes, null.dimensions) == ("7", [], [])
    assert null.acc_script == "null"
    assert one(spark, windowDays=2.9, sliceGranularity="minute ").window_slices == 2880
    assert one(spark, windowDays=-4).window_slices == 1


@pytest.mark.parametrize(
    "row",
    [
        {"sliceGranularity": "WEEK"},
        {"sliceGranularity": None},
        {"windowDays": "3"},
        {"eventTypeCodes": "E"},
    ],
)
def test_one_bad_row_fails_the_load(spark, row):
    with pytest.raises(Exception):
        definitions_from_rows(spark, [{"refName": "good"}, row]).collect()


@pytest.mark.parametrize("text", ["null", "[]"])
def test_empty_documents(spark, text):
    assert normalise_documents(spark.createDataFrame([(text,)], "value string")).count() == 0


@pytest.mark.parametrize("text", ["{", '{"refName":"a"}', "[1]"])
def test_documents_that_are_no_lists_of_rows(spark, text):
    with pytest.raises(Exception):
        normalise_documents(spark.createDataFrame([(text,)], "value string")).collect()


def test_offline_rows_are_left_out(spark):
    found = definitions_from_rows(
        spark, [{"refName": "a", "status": "OFFLINE"}, {"refName": "b", "status": "ONLINE"}, {"refName": "c"}]
    )
    assert rows(found, "ref_name") == [("b",), ("c",)]


def test_table_source(spark, tmp_path):
    table = spark.createDataFrame(
        [(1, "a", ["E"], ["m"], None, None, None, "ONLINE"), (0, "b", None, None, 2, " hour", "current + x", None)],
        "def_ord long, ref_name string, event_type_codes array<string>, dimensions array<string>, window_days int,"
        " slice_granularity string, acc_script string, status string",
    )
    table.write.parquet(str(tmp_path / "defs"))
    read = read_definitions(spark, str(tmp_path / "defs"), "parquet")
    assert rows(read, "ref_name", "slice_seconds", "window_slices", "acc_script") == [
        ("a", 86400, 1, "current + 1"),
        ("b", 3600, 48, "current + x"),
    ]
    assert [r.ref_name for r in DefinitionSet.of(read).table.orderBy("def_ord").collect()] == ["b", "a"]
    assert normalise_table(table.select("ref_name")).first().slice_granularity == "DAY"


def test_json_folder_source(spark, tmp_path):
    (tmp_path / "defs.json").write_text(json.dumps([{"refName": "x"}, {"refName": "y"}], indent=2))
    assert [r.ref_name for r in DefinitionSet.of(read_definitions(spark, str(tmp_path))).table.orderBy("def_ord").collect()] == ["x", "y"]


def test_bootstrap(spark):
    known = DefinitionSet.of_rows(spark, BOOTSTRAP)
    assert [(r.ref_name, r.slice_seconds, r.window_slices) for r in known.table.orderBy("def_ord").collect()] == [
        ("txn_cnt_1d", 86400, 1),
        ("txn_amount_1d", 86400, 1),
    ]


def test_feed_keeps_last_good_snapshot(spark):
    answers = [
        lambda: definitions_from_rows(spark, [{"refName": "a"}]),
        lambda: definitions_from_rows(spark, [{"refName": "a"}]),
        lambda: definitions_from_rows(spark, []),
        lambda: definitions_from_rows(spark, [{"refName": "b", "sliceGranularity": "WEEK"}]),
        lambda: definitions_from_rows(spark, [{"refName": "c"}]),
    ]
    feed = DefinitionFeed(spark, lambda: answers.pop(0)(), refresh_seconds=1)
    assert feed.refresh_seconds == 5.0
    names = lambda: [r.ref_name for r in feed.snapshot.table.orderBy("def_ord").collect()]
    assert names() == ["txn_cnt_1d", "txn_amount_1d"]
    assert feed.refresh() and names() == ["a"]
    assert not feed.refresh() and names() == ["a"]
    assert not feed.refresh() and names() == ["a"]
    assert not feed.refresh() and names() == ["a"] and feed.last_error
    assert feed.refresh() and names() == ["c"] and feed.last_error is None


def test_large_table_routes_like_a_small_one(spark, monkeypatch):
    """Beyond the size bound definitions are stored and joined by shuffle, with the same result."""
    raw = [
        {"refName": "any", "dimensions": []},
        {"refName": "typed", "eventTypeCodes": ["E", "E", "F"], "dimensions": ["m"], "accScript": "current + amount"},
        {"refName": "two", "eventTypeCodes": ["F"], "dimensions": ["m", "n"], "sliceGranularity": "HOUR"},
        {"refName": "typed", "eventTypeCodes": ["F"], "dimensions": ["m"], "accScript": "greatest(current, amount)"},
    ]
    small = definitions(spark, *raw)
    large = DefinitionSet.of(definitions_from_rows(spark, raw), broadcast_rows=0)
    assert small.small and not large.small
    texts = [message(f"o{i}", "EFG"[i % 3], i * 1000, m=f"M{i % 2}", n=i % 4, amount=i) for i in range(30)]
    columns = ("ref_name", "order_id", "dimension_key", "slice_seconds", "fold")
    got = rows(route(orders(spark, large, texts), large), *columns)
    assert got == rows(route(orders(spark, small, texts), small), *columns)
    plan = route(orders(spark, large, texts), large)._jdf.queryExecution().executedPlan().toString()
    assert "salt" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    # an event type with many orders is spread over copies of its definitions, others are not
    texts += [message(f"p{i}", "F", i * 1000, m=f"M{i % 2}", n=i % 4, amount=i) for i in range(40)]
    monkeypatch.setattr(routing, "SPREAD", 20)
    sent = orders(spark, large, texts)
    keyed = sent.select(F.concat(F.lit("="), "event_type_code").alias("route_key"))
    assert routing.frequent_keys(keyed) == {"=F": 3}
    spread = route(sent, large)
    plan = spread._jdf.queryExecution().executedPlan().toString()
    assert "salt" in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    assert rows(spread, *columns) == rows(route(orders(spark, small, texts), small), *columns)


def test_many_scripts_of_a_large_table_are_templates(spark):
    """The stored path finds the same templates, numbers and names as the held one."""
    raw = [{"refName": f"s{n}", "accScript": f"current + {('a', 'b')[n % 2]} * {n}"} for n in range(30)]
    raw += [{"refName": "odd", "accScript": "current + round(a, 1)"}, {"refName": "bad", "accScript": "current +"}]
    raw += [{"refName": "text", "accScript": "if(kind = 'x', current + a, null)", "fieldTypes": {"kind": "string"}}]
    raw += [{"refName": "decay", "accScript": "current * 0.5 + b"}, {"refName": "cap", "accScript": "if(current < 3, a, null)"}]
    small, large = definitions(spark, *raw), DefinitionSet.of(definitions_from_rows(spark, raw), broadcast_rows=0)
    assert len(small.scripts) == len(large.scripts) == 6
    sent = [message(f"o{i}", "E", i, a=i, b=2 * i, kind="xy"[i % 2]) for i in range(6)]
    columns = ("ref_name", "order_id", "increment")
    got = [rows(route_and_evaluate(orders(spark, d, sent), d), *columns) for d in (small, large)]
    assert got[0] == got[1]
    assert dict(((r, o), v) for r, o, v in got[0])["s7", "o3"] == 6 * 7
    folds = [{r.ref_name: r.fold for r in d.table.collect()} for d in (small, large)]
    assert folds[0] == folds[1]


def test_definitions_of_several_splits_keep_their_order(spark):
    """Rows are ranked in ranges; no window sees all of them."""
    table = spark.createDataFrame([(n, f"r{n}") for n in range(400)], "def_ord long, ref_name string").repartition(7)
    ranked = normalise_table(table)
    assert "Window" not in ranked._jdf.queryExecution().optimizedPlan().toString()
    assert [(r.def_ord, r.ref_name) for r in ranked.orderBy("def_ord").collect()] == [(n, f"r{n}") for n in range(400)]


def test_documents_of_several_splits_are_ranked_where_they_lie(spark, monkeypatch):
    texts = [(json.dumps([{"refName": f"r{n}_{i}", "status": "OFFLINE" if i == n % 3 else "ONLINE"} for i in range(3)]),) for n in range(50)]
    documents = spark.createDataFrame(texts, "value string").repartition(5)

    def refused(*_):
        raise AssertionError("all rows were read once more to deal them out")

    monkeypatch.setattr(type(documents), "repartitionByRange", refused)
    found = normalise_documents(documents).orderBy("def_ord").collect()
    assert [r.def_ord for r in found] == list(range(100))
    # the rows of a document stand together and in order
    assert all(a.ref_name.split("_")[0] == b.ref_name.split("_")[0] and a.ref_name < b.ref_name for a, b in zip(found[::2], found[1::2]))


def test_ordinals_follow_files_and_places_without_gaps(spark, tmp_path):
    for name in ("b", "a", "c"):
        (tmp_path / f"{name}.json").write_text(json.dumps([{"refName": f"{name}{n}"} for n in range(3)]))
    read = read_definitions(spark, str(tmp_path))
    assert rows(read, "def_ord", "ref_name") == list(enumerate([f"{f}{n}" for f in "abc" for n in range(3)]))


def test_an_unchanged_table_is_the_same_whatever_its_size(spark):
    raw = [{"refName": f"r{n}", "dimensions": ["m"]} for n in range(5)]

    def known(some, **bounds):
        return DefinitionSet.of(definitions_from_rows(spark, some), **bounds)

    assert known(raw, broadcast_rows=0).same_as(known(raw, broadcast_rows=0))
    assert known(raw, broadcast_rows=0).same_as(known(raw))
    assert not known(raw).same_as(known(raw[::-1])) and not known(raw).same_as(known(raw[1:]))
    assert not known(raw, broadcast_rows=0).same_as(known([*raw[:-1], {**raw[-1], "windowDays": 2}], broadcast_rows=0))
