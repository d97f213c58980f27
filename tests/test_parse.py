from __future__ import annotations

import pytest
from helpers import definitions, message, messages
from pyspark.sql import functions as F

from tallyline.operators.parse import dead_letters, field_schema, good_orders, parse_messages

UNREADABLE = "反序列化失败"


@pytest.fixture(scope="module")
def fields(spark):
    known = definitions(spark, {"refName": "a", "dimensions": ["merchant"], "accScript": "current + amount"})
    return field_schema(known)


def parse_one(spark, fields, text):
    return parse_messages(messages(spark, [text]), fields).first()


def test_valid_message(spark, fields):
    row = parse_one(spark, fields, message("o1", "B2B_RECV", 1_700_000_000_000, merchant="M1", amount=100))
    assert row.fail_reason is None
    assert (row.order_id, row.event_type_code, row.event_epoch_ms) == ("o1", "B2B_RECV", 1_700_000_000_000)
    assert row.fields.merchant == "M1"


CASES = {
    "{ not json": UNREADABLE,
    '{"eventTypeCode":"X"}': "缺少 orderId",
    '{"orderId":"  "}': "缺少 orderId",
    '{"orderId":null}': "缺少 orderId",
    None: "空消息",
    "": "空消息",
    " \t\u3000": "空消息",
    "\u00a0": UNREADABLE,
    "null": UNREADABLE,
    "[]": UNREADABLE,
    '[{"orderId":"a"}]': UNREADABLE,
    "123": UNREADABLE,
    "{'orderId':'a'}": UNREADABLE,
    '{"orderId":"a","other":1}': UNREADABLE,
    '{"orderId":{"z":1}}': UNREADABLE,
    '{"orderId":[1]}': UNREADABLE,
    '{"orderId":"a","eventTypeCode":["E"]}': UNREADABLE,
    '{"orderId":"a","eventEpochMs":"abc"}': UNREADABLE,
    '{"orderId":"a","eventEpochMs":"1.9"}': UNREADABLE,
    '{"orderId":"a","eventEpochMs":true}': UNREADABLE,
    '{"orderId":"a","eventEpochMs":99999999999999999999}': UNREADABLE,
    '{"orderId":"a","eventEpochMs":1e300}': UNREADABLE,
    '{"orderId":"a","eventEpochMs":NaN}': UNREADABLE,
    '{"orderId":"a","fields":[1]}': UNREADABLE,
    '{"orderId":"a","fields":""}': UNREADABLE,
    '{"orderId":"a","fields":{"skipped":tru}}': UNREADABLE,
    '{"orderId":"a"': UNREADABLE,
}


def test_refused_messages(spark, fields):
    parsed = parse_messages(messages(spark, CASES), fields)
    letters = {r.raw: r.fail_reason for r in dead_letters(parsed).collect()}
    assert good_orders(parsed).count() == 0
    assert set(letters) == set(CASES)
    for raw, reason in CASES.items():
        assert letters[raw].startswith(reason), (raw, letters[raw])


def test_coerced_values(spark, fields):
    cases = {
        '{"orderId":123}': ("123", 0),
        '{"orderId":true}': ("true", 0),
        '{"orderId":"{x"}': ("{x", 0),
        '{"orderId":"a","eventEpochMs":"17"}': ("a", 17),
        '{"orderId":"a","eventEpochMs":" 18 "}': ("a", 18),
        '{"orderId":"a","eventEpochMs":""}': ("a", 0),
        '{"orderId":"a","eventEpochMs":null}': ("a", 0),
        '{"orderId":"a","eventEpochMs":1.9}': ("a", 1),
        '{"orderId":"a","eventEpochMs":-1.9}': ("a", -1),
        '{"orderId":"a","eventEpochMs":1.9999999999}': ("a", 1),
        '{"orderId":"a","eventEpochMs":1.7e12}': ("a", 1_700_000_000_000),
        '{"orderId":"a"} trailing text': ("a", 0),
        '{"orderId":"a","orderId":"b"}': ("b", 0),
        '{"orderId":"a","fields":null}': ("a", 0),
        '{"orderId":"a","fields":{"amount":{"w":1,"w":2}}}': ("a", 0),
    }
    got = good_orders(parse_messages(messages(spark, cases), fields)).orderBy("arrival_seq").collect()
    assert [(r.order_id, r.event_epoch_ms) for r in got] == list(cases.values())


def test_each_message_is_parsed_once(spark, fields):
    """Conditions on the parsed order must not pull the parser apart into one copy per property."""
    good = good_orders(parse_messages(messages(spark, ["x"]), fields))
    plan = good.where(F.col("order_id") > "a")._jdf.queryExecution().optimizedPlan().toString()
    full = [line for line in plan.splitlines() if "StructField(eventTypeCode,StringType" in line]
    assert len(full) == 1 and "Generate" in full[0]
