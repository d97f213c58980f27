from __future__ import annotations

import random
from dataclasses import replace

import pytest
from helpers import HOUR, definitions, message, messages, orders, rows
from pyspark.sql import functions as F

from tallyline.operators import accumulate
from tallyline.functions import slices
from tallyline.operators import window_values
from tallyline.operators.accumulate import counted_flags, slice_totals
from tallyline.operators.evaluate import route_and_evaluate
from tallyline.plans.backfill import backfill_messages, backfill_orders
from tallyline.session import prepare
from tallyline.sources import definitions as source

SUM = {"refName": "s", "dimensions": ["m"], "accScript": "current + amount"}


def updates(spark, known, texts):
    prepare(spark)
    return backfill_messages(messages(spark, texts), known).updates


def test_redelivery_with_another_time_or_amount_is_dropped(spark):
    known = definitions(spark, SUM)
    texts = [message("o", "E", 0, m="M", amount=1), message("o", "E", 90_000_000, m="M", amount=9)]
    assert rows(updates(spark, known, texts), "order_id", "slice_ts", "increment") == [("o", 0, 1.0)]


def test_same_order_counts_once_per_key(spark):
    known = definitions(spark, SUM, {**SUM, "refName": "t"})
    texts = [message("o", m="A", amount=1), message("o", m="B", amount=2), message("o", m="A", amount=3)]
    assert rows(updates(spark, known, texts), "ref_name", "dimension_key", "increment") == [
        ("s", "A", 1.0), ("s", "B", 2.0), ("t", "A", 1.0), ("t", "B", 2.0),
    ]


def test_failed_delivery_does_not_block_the_next(spark):
    known = definitions(spark, SUM)
    texts = [message("o", m="M"), message("o", m="M", amount="x"), message("o", m="M", amount=7), message("o", m="M", amount=8)]
    assert rows(updates(spark, known, texts), "increment") == [(7.0,)]


def test_first_definition_of_a_shared_name_wins(spark):
    known = definitions(spark, SUM, {"refName": "s", "dimensions": ["m"], "sliceGranularity": "HOUR"})
    texts = [message("a", m="M", amount=5), message("b", m="M"), message("a", m="M", amount=6)]
    assert rows(updates(spark, known, texts), "order_id", "granularity", "increment") == [
        ("a", "DAY", 5.0), ("b", "HOUR", 1.0),
    ]


def test_names_with_separators_do_not_meet(spark):
    known = definitions(spark, {"refName": "a|b", "dimensions": ["m"]}, {"refName": "a", "dimensions": ["m"]})
    got = updates(spark, known, [message("o", m="c"), message("o", m="b|c")])
    assert got.count() == 4


def test_update_columns(spark):
    known = definitions(spark, {**SUM, "sliceGranularity": "hour", "windowDays": 2})
    row = updates(spark, known, [message("o", "E", 1_700_000_000_999, m="M", amount=2)]).first()
    assert row.asDict() == {
        "ref_name": "s", "dimension_key": "M", "granularity": "HOUR", "slice_ts": 1_699_999_200, "increment": 2.0,
        "order_id": "o", "slice_key": "ind:s:M:HOUR:1699999200", "ttl_seconds": 49 * HOUR,
    }


@pytest.mark.parametrize("ms, start", [(-3_700_000, -3600), (-999, 0), (-3_600_999, -3600), (3_700_000, 3600), (0, 0)])
def test_slices_truncate_toward_zero(spark, ms, start):
    got = spark.range(1).select(slices.slice_start(F.lit(ms).cast("bigint"), F.lit(3600).cast("bigint"))).first()[0]
    assert got == start


def test_ttl_has_one_slice_at_least(spark):
    got = spark.range(1).select(slices.ttl_seconds(F.lit(60), F.lit(0)), slices.ttl_seconds(F.lit(60), F.lit(5))).first()
    assert tuple(got) == (120, 360)


def test_counted_flags(spark):
    known = definitions(spark, SUM)
    texts = [message("o", m="M"), message("o", m="M", amount=1), message("o", m="M", amount=2), message("p", m="M", amount=3)]
    evaluated = route_and_evaluate(orders(spark, known, texts), known)
    flags = rows(counted_flags(evaluated, known), "arrival_seq", "counted")
    assert flags == [(0, False), (1, True), (2, False), (3, True)]


def test_large_definition_table_gives_the_same_updates(spark):
    raw = [SUM, {"refName": "s", "dimensions": ["m"]}, {"refName": "any", "sliceGranularity": "MINUTE"}]
    texts = [message(f"o{i % 20}", "E", i * 1000, m=f"M{i % 3}", **({"amount": i} if i % 4 else {})) for i in range(60)]
    small = definitions(spark, *raw)
    large = source.DefinitionSet.of(source.definitions_from_rows(spark, raw), broadcast_rows=0)
    columns = ("ref_name", "dimension_key", "granularity", "slice_ts", "increment", "order_id", "ttl_seconds")
    assert rows(updates(spark, large, texts), *columns) == rows(updates(spark, small, texts), *columns)


def skewed_orders(spark):
    """A third of all rows in one key, and a third as copies of one order."""
    return spark.range(3000).selectExpr(
        "case when id % 3 = 0 then 'same' else cast(id as string) end order_id", "if(id >= 0, 'E', 'F') event_type_code",
        "id * 1000 event_epoch_ms", "id arrival_seq",
        "named_struct('m', if(id % 3 = 1, 'hot', cast(id as string)), 'amount', cast(id as double)) fields",
    )


def test_one_shuffle_with_reduction_before_it(spark):
    known = definitions(spark, SUM)
    plan = backfill_orders(skewed_orders(spark), known).updates._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("HashAggregate") == 2 and "SortAggregate" not in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    shared = definitions(spark, SUM, {**SUM, "accScript": "current + 1"})
    plan = backfill_orders(skewed_orders(spark), shared).updates._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SortAggregate" not in plan


# ---------------------------------------------------------------- properties

NOW = 1_700_000_000
STEP = HOUR
SLICES = 24
PROPERTY = {
    "refName": "p",
    "dimensions": ["list"],
    "sliceGranularity": "HOUR",
    "windowDays": 1,
    "accScript": "current + inc",
}


def order_lists(tries: int, seed: int) -> list[list[tuple[str, int, float]]]:
    rng = random.Random(seed)
    lists = []
    for _ in range(tries):
        found = {}
        for _ in range(rng.randint(1, 30)):
            name = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 8)))
            found[name] = (name, NOW - rng.randint(0, 3 * 86400), rng.uniform(1, 5))
        lists.append(list(found.values()))
    return lists


def window_values_of(spark, lists):
    known = definitions(spark, PROPERTY)
    texts = [
        message(name, "E", second * 1000, list=n, inc=inc)
        for n, entries in enumerate(lists)
        for name, second, inc in entries
    ]
    totals = slice_totals(updates(spark, known, texts))
    found = window_values.value_at(totals, known, NOW)
    return {int(r.dimension_key): r.window_value for r in found.collect()}


def test_repeated_and_shuffled_delivery_changes_nothing(spark):
    lists = order_lists(200, seed=4)
    rng = random.Random(5)
    repeated = []
    for entries in lists:
        thrice = entries * 3
        rng.shuffle(thrice)
        repeated.append(thrice)
    once, thrice = window_values_of(spark, lists), window_values_of(spark, repeated)
    assert once.keys() == thrice.keys()
    assert all(abs(once[n] - thrice[n]) < 1e-6 for n in once)


def test_window_value_is_the_sum_of_slices_in_the_window(spark):
    lists = order_lists(200, seed=6)
    now_slice = NOW // STEP * STEP
    for n, value in window_values_of(spark, lists).items():
        expected = sum(
            inc for _, second, inc in lists[n] if now_slice - (SLICES - 1) * STEP <= second // STEP * STEP <= now_slice
        )
        assert abs(value - expected) < 1e-6


# ---------------------------------------------------------------- windows


def totals_of(spark, known, entries):
    texts = [message(f"o{i}", "E", second * 1000, m="M", amount=amount) for i, (second, amount) in enumerate(entries)]
    return slice_totals(updates(spark, known, texts))


def test_window_leaves_out_old_and_future_slices(spark):
    known = definitions(spark, {**SUM, "sliceGranularity": "HOUR", "windowDays": 1})
    totals = totals_of(spark, known, [(0, 1), (HOUR, 2), (23 * HOUR, 4), (24 * HOUR, 8), (60 * HOUR, 16)])
    at = lambda hour, **k: rows(window_values.value_at(totals, known, hour * HOUR + 59, **k), "window_value")
    assert at(23) == [(7.0,)] and at(24) == [(14.0,)] and at(60) == [(16.0,)]
    assert at(200) == [(0.0,)] and at(200, keep_empty=False) == []


def test_windows_of_different_length_in_one_pass(spark):
    known = definitions(
        spark,
        {**SUM, "refName": "d1", "sliceGranularity": "HOUR"},
        {**SUM, "refName": "d7", "windowDays": 7},
        {**SUM, "refName": "d11", "windowDays": 11, "sliceGranularity": "HOUR"},
        {**SUM, "refName": "d13", "windowDays": 13},
        {**SUM, "refName": "m", "sliceGranularity": "MINUTE"},
    )
    rng = random.Random(1)
    entries = [(rng.randint(-20, 20) * 21_600 + rng.randint(0, 7200), float(rng.randint(1, 9))) for _ in range(80)]
    totals = totals_of(spark, known, entries)
    values = window_values.value_at_every_slice(totals, known)
    plan = values._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1 and "Union" not in plan
    got = rows(values, "ref_name", "slice_ts", "window_value")
    sizes = {"d1": (3600, 24), "d7": (86400, 7), "d11": (3600, 264), "d13": (86400, 13), "m": (60, 1440)}
    by_ref = {}
    for r in totals.collect():
        by_ref.setdefault(r.ref_name, []).append((r.slice_ts, r.value))
    expected = sorted(
        (ref, ts, sum(v for t, v in found if ts - (sizes[ref][1] - 1) * sizes[ref][0] <= t <= ts))
        for ref, found in by_ref.items()
        for ts, _ in found
    )
    assert got == expected


@pytest.mark.parametrize("slices", [1, 2, 3, 7, 1440, 525_600, 2**31 - 1])
def test_a_window_ends_at_its_last_slice(spark, slices):
    """Slices exactly one window apart do not meet, those one slice nearer do; early, late and negative slices."""
    known = definitions(spark, {"refName": "w", "sliceGranularity": "MINUTE"})
    known = replace(known, table=known.table.withColumn("window_slices", F.lit(slices)))
    for first in (0, -3, 28_000_000, 2**40):
        found = [(first, 1.0), (first + slices - 1, 2.0), (first + slices, 4.0)]
        totals = spark.createDataFrame(
            [("w", "", "MINUTE", n * 60, v, 1) for n, v in dict(found).items()],
            "ref_name string, dimension_key string, granularity string, slice_ts long, value double, orders long",
        )
        got = rows(window_values.value_at_every_slice(totals, known), "slice_ts", "window_value")
        kept = dict(found).items()
        assert got == sorted((n * 60, sum(v for m, v in kept if n - slices < m <= n)) for n, _ in kept)


def test_retention_outlives_the_window(spark):
    known = definitions(spark, {**SUM, "sliceGranularity": "HOUR"})
    got = updates(spark, known, [message("o", "E", 0, m="M", amount=1)])
    assert window_values.retained(got, 25 * HOUR - 1).count() == 1
    assert window_values.retained(got, 25 * HOUR).count() == 0


def test_hot_key_and_hot_order(spark):
    known = definitions(spark, SUM, {"refName": "c"})
    got = backfill_orders(skewed_orders(spark), known).updates
    found = got.groupBy("ref_name").agg(F.count("*"), F.sum("increment")).collect()
    # The copies of one order differ in their key for the sum, so there each counts once.
    assert {r[0]: (r[1], r[2]) for r in found} == {"c": (2001, 2001.0), "s": (3000, sum(range(3000)))}


def test_counted_flags_take_one_scan_and_one_shuffle(spark):
    known = definitions(spark, {"refName": "a"}, {"refName": "a", "sliceGranularity": "HOUR"})
    evaluated = route_and_evaluate(orders(spark, known, [message("x"), message("x"), message("y")]), known)
    flagged = counted_flags(evaluated.repartition(3), known)
    plan = flagged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") == 1 and "SortMergeJoin" not in plan
    assert sorted((r.order_id, r.arrival_seq, r.def_ord) for r in flagged.where("counted").collect()) == [("x", 0, 0), ("y", 2, 0)]


def test_windows_of_a_shared_name_keep_their_own_steps(spark):
    """Clicks at hours 1, 5 and 20 under an hourly definition that shares its name with a daily one."""
    known = definitions(
        spark,
        {"refName": "r", "eventTypeCodes": ["BUY"], "accScript": "current + amount"},
        {"refName": "r", "eventTypeCodes": ["CLICK"], "sliceGranularity": "HOUR"},
    )
    texts = [message(f"o{h}", "CLICK", h * 3_600_000) for h in (1, 5, 20)]
    totals = slice_totals(backfill_orders(orders(spark, known, texts), known).updates)
    at = window_values.value_at_every_slice(totals, known).orderBy("slice_ts")
    assert [r.window_value for r in at.collect()] == [1.0, 2.0, 3.0]
    assert window_values.value_at(totals, known, 20 * 3600).first().window_value == 3.0


def test_orders_that_match_many_definitions_meet_before_they_fan_out(spark, monkeypatch):
    """Orders once, a few times and often, null ids and failures; no pair of an order that comes once is shuffled."""
    rows_ = [{"refName": f"r{n}", "dimensions": ["m"], "accScript": f"current + amount * {n}"} for n in range(40)]
    known = definitions(spark, *rows_)
    columns = ("ref_name", "dimension_key", "order_id", "slice_ts", "increment")
    sent = spark.range(60).selectExpr(
        "case when id % 7 = 0 then null when id < 20 then 'often' when id < 40 then concat('o', id % 9) else concat('p', id) end order_id",
        "'E' event_type_code", "(60 - id) * 40000000 event_epoch_ms", "id arrival_seq",
        "named_struct('m', if(id % 3 = 1, 'a', 'b'), 'amount', if(id % 5 = 0, null, cast(id as double))) fields",
    )

    def found(hot, wide):
        monkeypatch.setattr(accumulate, "HOT_ORDER", hot)
        monkeypatch.setattr(accumulate, "WIDE", wide)
        updates = backfill_orders(sent, known).updates.select(*columns)
        return sorted(map(repr, updates.collect()))

    assert found(10, 32) == found(1000, 32) == found(10, 1000)
    monkeypatch.setattr(accumulate, "WIDE", 32)
    single = backfill_orders(sent.where("arrival_seq >= 40 and arrival_seq % 7 > 0"), known).updates
    assert len(single.collect()) == 40 * sum(n % 7 > 0 and n % 5 > 0 for n in range(40, 60))
    plan = single._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "hashpartitioning(ref_ord" not in plan
