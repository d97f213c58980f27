from __future__ import annotations

import random

import pytest
from helpers import definitions, message, orders, rows

from tallyline.operators.fold import _by_pairs, _result, running_slice_values, segments_of, union
from tallyline.session import children, shared_dir


def model(entries, step):
    """Running values by the plain rule: one order after another, per key and hour."""
    values, counted, out = {}, set(), []
    for order_id, ms, key, amount, own in entries:
        if (key, order_id) in counted or amount is None:
            continue
        counted.add((key, order_id))
        slice_ts = ms // 1000 // 3600 * 3600
        before = values.get((key, slice_ts), 0.0)
        value = step(before if own is None else own, amount)
        values[key, slice_ts] = value
        out.append((key, slice_ts, order_id, value))
    return sorted(out)


def feed(seed, n=120, own=True):
    rng = random.Random(seed)
    entries = []
    for _ in range(n):
        amount = rng.choice([None, 1.0, 2.0, 3.5, 8.0, -2.0])
        current = rng.choice([None] * 6 + [4.0]) if own else None
        order = f"o{rng.randint(0, n // 2)}"
        entries.append((order, rng.randint(0, 3) * 3_600_000, rng.choice("AAAB"), amount, current))
    return entries


def texts(entries):
    return [
        message(o, "E", ms, m=key, **({"amount": a} if a is not None else {}), **({"current": c} if c is not None else {}))
        for o, ms, key, a, c in entries
    ]


CASES = {
    "current + amount": lambda c, a: c + a,
    "greatest(current, amount) + 0 * amount": max,
    "least(current, amount) + 0 * amount": min,
    "amount * 2": lambda c, a: a * 2,
    "current * 0.5 + amount": lambda c, a: c * 0.5 + a,
    "if(current > 5, amount, current + amount)": lambda c, a: a if c > 5 else c + a,
}


@pytest.mark.parametrize("script", CASES)
def test_running_values(spark, script):
    """Small segments and rounds, so that every slice crosses many of them."""
    entries = feed(3)
    known = definitions(spark, {"refName": "r", "dimensions": ["m"], "sliceGranularity": "HOUR", "accScript": script})
    got = running_slice_values(orders(spark, known, texts(entries)), known, segment=7, part=5)
    found = rows(got, "dimension_key", "slice_ts", "order_id", "running_value")
    assert found == model(entries, CASES[script])


CAPPED = {
    "if(current < 6, current + amount, null)": lambda c, a: c + a if c < 6 else None,
    "case when current + amount <= 9 then current + amount end": lambda c, a: c + a if c + a <= 9 else None,
    "if(current = 4, 10 / (current - 4), greatest(current, amount) + 1)": lambda c, a: None if c == 4 else max(c, a) + 1,
    "nullif(current + amount, 5)": lambda c, a: None if c + a == 5 else c + a,
}


@pytest.mark.parametrize("script", CAPPED)
@pytest.mark.parametrize("seed", [3, 11])
def test_orders_that_fail_on_the_running_value_may_count_later(spark, script, seed):
    """The same order comes again in other slices; it counts where it first succeeds."""
    step = CAPPED[script]
    entries = feed(seed)
    known = definitions(spark, {"refName": "r", "dimensions": ["m"], "sliceGranularity": "HOUR", "accScript": script})
    assert known.scripts[0].fold == "ordered"
    values, counted, wanted = {}, set(), []
    for order_id, ms, key, amount, own in entries:
        if (key, order_id) in counted or amount is None:
            continue
        slice_ts = ms // 3_600_000 * 3600
        value = step(values.get((key, slice_ts), 0.0) if own is None else own, amount)
        if value is not None:
            counted.add((key, order_id))
            values[key, slice_ts] = value
            wanted.append((key, slice_ts, order_id, value))
    got = running_slice_values(orders(spark, known, texts(entries)), known)
    found = rows(got, "dimension_key", "slice_ts", "order_id", "running_value")
    if "greatest" in script:  # an order without amount counts there
        assert len(found) >= len(wanted)
    else:
        assert found == sorted(wanted)


def test_a_lost_redelivery(spark):
    known = definitions(spark, {"refName": "r", "dimensions": ["m"], "accScript": "if(current < 3, current + a, null)"})
    day = 86_400_000
    sent = [message("x", "E", 0, m="M", a=5), message("y", "E", 1, m="M", a=1), message("y", "E", day, m="M", a=1)]
    got = running_slice_values(orders(spark, known, sent), known)
    assert rows(got, "order_id", "slice_ts", "running_value") == [("x", 0, 5.0), ("y", 86400, 1.0)]


def test_order_by_order_takes_one_job_and_no_driver_loop(spark):
    known = definitions(spark, {"refName": "r", "accScript": "if(current > 5, amount, current + amount)"})
    sent = orders(spark, known, [message(f"o{i}", "E", i, amount=i % 4) for i in range(50)])
    tracker, group = spark.sparkContext.statusTracker(), "fold-test"
    spark.sparkContext.setJobGroup(group, "fold")
    try:
        values = running_slice_values(sent, known)
        assert len(tracker.getJobIdsForGroup(group)) == 0
        assert len(values.collect()) == 50
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    plan = values._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_segments_hold_a_bounded_number_of_sparse_arrivals(spark):
    """Numbers made of an offset and a partition, and redeliveries far behind them."""
    numbers = [offset * 65536 + partition for offset in range(300) for partition in (0, 1, 4000)]
    numbers += [2**40 + n * 10**7 for n in range(100)]
    rows_ = spark.createDataFrame([(n,) for n in numbers], "arrival_seq long").repartition(5)
    found = rows_.withColumn("segment", segments_of(rows_, 50)).orderBy("arrival_seq").collect()
    numbered = [r.segment for r in found]
    assert numbered == sorted(numbered)
    assert max(numbered.count(n) for n in set(numbered)) <= 100 and len(set(numbered)) >= 15
    assert {r.segment for r in rows_.withColumn("segment", segments_of(rows_, 5000)).collect()} == {0}


def test_long_affine_slices_are_read_in_parts(spark):
    known = definitions(spark, {"refName": "r", "accScript": "current * 0.5 + amount"})
    sent = [message(f"o{i}", "E", i, amount=i % 7, **({"current": 2} if i == 300 else {})) for i in range(1000)]
    value, wanted = 0.0, []
    for i in range(1000):
        value = (2 if i == 300 else value) * 0.5 + i % 7
        wanted.append((i, value))
    for part in (64, 10_000):
        got = running_slice_values(orders(spark, known, sent), known, segment=90, part=part)
        assert rows(got, "arrival_seq", "running_value") == wanted


@pytest.mark.parametrize("script, step", [("greatest(current, amount)", max), ("least(current, amount)", min)])
def test_running_extremes(spark, script, step):
    """As a scan; an order without amount counts here, since the extreme passes over it."""
    entries = [e for e in feed(8) if e[3] is not None]
    known = definitions(spark, {"refName": "r", "dimensions": ["m"], "sliceGranularity": "HOUR", "accScript": script})
    assert known.scripts[0].fold in ("max", "min")
    got = running_slice_values(orders(spark, known, texts(entries)), known, segment=7)
    assert rows(got, "dimension_key", "slice_ts", "order_id", "running_value") == model(entries, step)


def test_indicators_of_one_name_share_their_slices(spark):
    """Two definitions of one name with different kinds of script run over one value."""
    known = definitions(
        spark,
        {"refName": "r", "eventTypeCodes": ["E"], "sliceGranularity": "HOUR", "accScript": "current + amount"},
        {"refName": "r", "eventTypeCodes": ["F"], "sliceGranularity": "HOUR", "accScript": "greatest(current, amount)"},
    )
    sent = [message("a", "E", 0, amount=2), message("b", "F", 0, amount=9), message("c", "E", 0, amount=1)]
    got = running_slice_values(orders(spark, known, sent), known)
    assert rows(got, "order_id", "running_value") == [("a", 2.0), ("b", 9.0), ("c", 10.0)]


def test_failed_script_changes_nothing(spark):
    known = definitions(spark, {"refName": "r", "accScript": "current + amount"})
    sent = [message("a", amount=1), message("b"), message("b", amount=5), message("a", amount=7)]
    got = running_slice_values(orders(spark, known, sent), known)
    assert rows(got, "arrival_seq", "order_id", "running_value") == [(0, "a", 1.0), (2, "b", 6.0)]


def test_slice_key_names_the_width(spark):
    known = definitions(spark, {"refName": "r", "sliceGranularity": "minute"})
    got = running_slice_values(orders(spark, known, [message("a", "E", 61_000)]), known)
    assert got.first().slice_key == "ind:r::MINUTE:60"


WIDE_SCRIPTS = (
    "current + amount * {n}",
    "greatest(current, amount + {n})",
    "least(current, amount - {n})",
    "amount * {n}",
    "current * 0.{n} + amount",
    "if(current > {n}, amount, current + amount)",
    "current + coalesce(amount, current / {n})",
)
WIDE_CAPPED = ("if(current < {n}, current + amount, null)", "nullif(current + amount, {n})", "if(current > {n}, amount, current + 1)")


def many(texts, each):
    common = {"dimensions": ["m"], "sliceGranularity": "HOUR"}
    return [{"refName": f"r{i}_{n}", "accScript": t.format(n=n), **common} for i, t in enumerate(texts) for n in range(1, each + 1)]


@pytest.mark.parametrize("scripts, each", [(WIDE_SCRIPTS, 10), (WIDE_CAPPED, 11)])
def test_definitions_that_route_alike_are_read_together(spark, scripts, each):
    """The same values as from pairs, with orders that come again, fail and bring their own value."""
    entries = feed(5)
    sent = texts(entries)
    alone = [{"refName": "alone", "accScript": "current + amount"}, {"refName": "capped", "accScript": "if(current < 9, current + 1, null)"}]
    known = definitions(spark, *many(scripts, each), *alone)
    got = running_slice_values(orders(spark, known, sent), known, part=5)
    one_by_one = _result(union(_by_pairs(orders(spark, known, sent), known, 1_000_000, 65_536)), known)
    columns = ("ref_name", "dimension_key", "slice_ts", "order_id", "arrival_seq", "slice_key")
    found, wanted = ({r[:-1]: r[-1] for r in rows(f, *columns, "running_value")} for f in (got, one_by_one))
    assert found.keys() == wanted.keys() and len(found) > 1000
    assert found == pytest.approx(wanted, rel=1e-12)


def test_orders_travel_and_not_their_pairs(spark):
    """40 scripts that add and 40 that may fail: what is stored and dealt are orders, once for each block."""
    known = definitions(spark, *many(("current * 0.5 + amount * {n}", "if(current < {n}, current + amount, null)"), 40))
    sent = orders(spark, known, [message(f"o{i}", "E", i, m="A", amount=1) for i in range(100)])
    before = set(children(spark, shared_dir(spark)))
    values = running_slice_values(sent, known)
    made = [n for n in children(spark, shared_dir(spark)) if n not in before]
    assert sum(spark.read.parquet(f"{shared_dir(spark)}/{n}").count() for n in made) == 200
    plan = values._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Exchange hashpartitioning(def_ord" not in plan
    reading, fan_out, dealing = (plan.index(t) for t in ("MapInArrow", "Generate explode(sequence", "Exchange hashpartitioning(first"))
    assert reading < fan_out < plan.index("Sort [first") < dealing
    assert values.count() == 40 * 100 + sum(range(1, 41))
