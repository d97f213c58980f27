from __future__ import annotations

import json

import pytest
from helpers import definitions, message, orders, rows
from pyspark.sql import functions as F

from tallyline.operators.route import pair_by_event, route, with_legacy_keys


def routed(spark, known, texts):
    return route(orders(spark, known, texts), known)


def names(spark, known, text):
    return [r[0] for r in rows(routed(spark, known, [text]), "ref_name")]


def test_matches_when_dimension_present(spark):
    known = definitions(spark, {"refName": "txn_cnt", "dimensions": ["merchant"], "sliceGranularity": "HOUR"})
    assert names(spark, known, message("o1", merchant="M1", amount=100)) == ["txn_cnt"]


def test_no_match_when_dimension_missing_or_null(spark):
    known = definitions(spark, {"refName": "by_country", "dimensions": ["country"]})
    assert names(spark, known, message("o1", merchant="M1")) == []
    assert names(spark, known, message("o1", country=None)) == []
    assert names(spark, known, message("o1", country="")) == ["by_country"]


def test_event_type_filter(spark):
    known = definitions(spark, {"refName": "cnt", "eventTypeCodes": ["EVT_PAY"], "dimensions": ["merchantId"]})
    assert names(spark, known, message("o1", "EVT_PAY", merchantId="M1")) == ["cnt"]
    assert names(spark, known, message("o2", "OTHER", merchantId="M1")) == []


@pytest.mark.parametrize("code", [None, "", "  ", "\u3000"])
def test_blank_event_type_matches_nothing(spark, code):
    known = definitions(spark, {"refName": "any"}, {"refName": "typed", "eventTypeCodes": ["E", ""]})
    assert names(spark, known, message("o1", code)) == []


def test_null_fields_match_only_without_dimensions(spark):
    known = definitions(spark, {"refName": "any"}, {"refName": "dim", "dimensions": ["m"]})
    assert names(spark, known, '{"orderId":"o","eventTypeCode":"E","fields":null}') == ["any"]
    assert names(spark, known, '{"orderId":"o","eventTypeCode":"E"}') == ["any"]


def test_fan_out_in_list_order_without_doubling(spark):
    known = definitions(
        spark, {"refName": "b", "eventTypeCodes": ["E", "E"]}, {"refName": "a"}, {"refName": "c", "eventTypeCodes": ["F"]}
    )
    found = routed(spark, known, [message("o1", "E")]).orderBy("def_ord").collect()
    assert [r.ref_name for r in found] == ["b", "a"]


def test_dimension_keys(spark):
    known = definitions(
        spark,
        {"refName": "one", "dimensions": ["m"]},
        {"refName": "two", "dimensions": ["m", "amount"], "accScript": "current + amount"},
        {"refName": "none"},
    )
    found = dict(rows(routed(spark, known, [message("o1", m="M|1", amount=100)]), "ref_name", "dimension_key"))
    assert found == {"one": "M|1", "two": "m#M|1;amount#100", "none": ""}


@pytest.mark.parametrize("as_input", [False, True])
def test_printed_values(spark, as_input):
    """Dimension values print the same whether or not a script also reads the field."""
    script = {"accScript": "current + d"} if as_input else {}
    known = definitions(spark, {"refName": "r", "dimensions": ["d"], **script})
    values = {"1.50": "1.5", "1e2": "100.0", "100.0": "100.0", "100": "100", "true": "true", '"x y"': "x y",
              "12345678901234567890": "12345678901234567890", "1e10": "1.0E10", "-3": "-3"}
    texts = [
        json.dumps({"orderId": text, "eventTypeCode": "E"})[:-1] + f',"fields":{{"d":{text}}}}}' for text in values
    ]
    assert dict(rows(routed(spark, known, texts), "order_id", "dimension_key")) == values


def test_legacy_key(spark):
    known = definitions(spark, {"refName": "r", "dimensions": ["merchant", "gone"]}, {"refName": "g"})
    pairs = with_legacy_keys(pair_by_event(orders(spark, known, [message("o1", merchant="M1")]), known), known)
    assert dict(rows(pairs, "ref_name", "legacy_key")) == {"r": "merchant#M1;gone#null;", "g": ""}


def test_map_and_struct_fields_route_alike(spark):
    known = definitions(spark, {"refName": "r", "dimensions": ["m"], "accScript": "current + amount"})
    parsed = orders(spark, known, [message("o1", m="M1", amount=2.5), message("o2", amount=1)])
    as_map = parsed.withColumn(
        "fields",
        F.create_map(
            F.lit("m"), F.col("fields.m").cast("variant"), F.lit("amount"), F.col("fields.amount")
        ),
    )
    columns = ("order_id", "dimension_key")
    assert rows(route(as_map, known), *columns) == rows(route(parsed, known), *columns) == [("o1", "M1")]


def test_one_hash_join_and_narrow_scan(spark, tmp_path):
    """Typed definitions: a plain filter reaches the scan, and only the fields in use are read."""
    path = str(tmp_path / "orders")
    spark.range(10).selectExpr(
        "cast(id as string) order_id", "'E' event_type_code", "id event_epoch_ms", "id arrival_seq",
        "named_struct('m', 'M', 'amount', 1.5D, 'unused', 'u') fields",
    ).write.parquet(path)
    known = definitions(
        spark, {"refName": "r", "eventTypeCodes": ["E"], "dimensions": ["m"], "accScript": "current + amount"}
    )
    plan = route(spark.read.parquet(path), known)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 1
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Exchange hashpartitioning" not in plan
    assert "EqualTo(event_type_code,E)" in plan
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "unused" not in scan
