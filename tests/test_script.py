from __future__ import annotations

import pytest
from helpers import definitions, message, orders, rows

from tallyline.functions.script import compile_script, scopes
from tallyline.operators.evaluate import failed_scripts, route_and_evaluate
from tallyline.operators import evaluate


def increments(spark, script, *texts, types=None, more=()):
    known = definitions(spark, {"refName": "r", "accScript": script, "fieldTypes": types or {}}, *more)
    evaluated = route_and_evaluate(orders(spark, known, texts), known)
    return [r.increment for r in evaluated.where("ref_name = 'r'").orderBy("arrival_seq").collect()]


def test_count_and_sum(spark):
    assert increments(spark, "current + 1", message("o1", amount=100)) == [1.0]
    assert increments(spark, "current + amount", message("o1", amount=100), message("o2", amount=1.5)) == [100.0, 1.5]


def test_missing_variable_fails(spark):
    known = definitions(spark, {"refName": "bad", "accScript": "current + missingVar"}, {"refName": "good"})
    evaluated = route_and_evaluate(orders(spark, known, [message("o1")]), known)
    assert rows(evaluated, "ref_name", "increment") == [("bad", None), ("good", 1.0)]
    assert rows(failed_scripts(evaluated, known), "ref_name", "order_id", "acc_script") == [
        ("bad", "o1", "current + missingVar")
    ]


def test_only_numbers_are_numbers(spark):
    texts = [message("o", amount=a) for a in (100, 1.5, "100", True, None, {"a": 1}, [1], 12345678901234567890)]
    assert increments(spark, "current + amount", *texts) == [
        100.0, 1.5, None, None, None, None, None, 12345678901234567890.0,
    ]


def test_own_current_hides_the_slice_value(spark):
    texts = [message("a", current=5, amount=1), message("b", amount=1), message("c", current=None, amount=1),
             message("d", current="7", amount=1)]
    assert increments(spark, "current + amount", *texts) == [6.0, 1.0, None, None]


def test_division_by_zero_fails_the_row_only(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    texts = [message("a", x=1, y=0), message("b", x=1, y=2)]
    assert increments(spark, "current + x / y", *texts) == [None, 0.5]
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


def test_declared_text_inputs(spark):
    texts = [message("a", status="OK", amount=2), message("b", status="NO", amount=2), message("c", status=1, amount=2)]
    script = "if(status = 'OK', current + amount, null)"
    assert increments(spark, script, *texts, types={"status": "string"}) == [2.0, None, None]


def test_dotted_names(spark):
    text = message("a", address={"zip": 12, "geo": {"lat": 1.5}})
    assert increments(spark, "current + address.zip", text) == [12.0]
    assert increments(spark, "current + address.geo.lat", text) == [1.5]


@pytest.mark.parametrize("name", ["order_id", "ref_name", "increment", "slice_ts", "script_id", "fields"])
def test_a_field_may_have_any_name(spark, name):
    assert increments(spark, f"current + {name}", message("a", **{name: 3})) == [3.0]


def test_spellings_do_not_meet(spark):
    more = [{"refName": "other", "accScript": "current + Amount"}, {"refName": "deep", "accScript": "amount.x + 1"}]
    assert increments(spark, "current + amount", message("a", amount=1, Amount=10), more=more) == [1.0]


@pytest.mark.parametrize(
    "script",
    ["", "current +", "sum(amount)", "explode(array(1))", "sum(current) over ()", "*", "'text'", "null", "amount > 1",
     "nosuch(amount)", "__t_ref_ord + 1"],
)
def test_scripts_that_cannot_run(spark, script):
    assert not compile_script(spark, script, {}).runs
    assert increments(spark, script, message("a", amount=1)) == [None]


@pytest.mark.parametrize(
    "script, fold",
    [
        ("current + 1", "sum"),
        ("current + amount * 2", "sum"),
        ("amount + current", "sum"),
        ("current + if(a > 1, b, 0)", "sum"),
        ("greatest(current, amount)", "max"),
        ("LEAST(current, amount + 1)", "min"),
        ("amount", "last"),
        ("current - amount", "general"),
        ("current + current", "general"),
        ("current * 0.5 + amount", "affine"),
        ("current * 2 + a * b", "affine"),
        ("current * 2 + current", "general"),
        ("current * a + b", "general"),
        ("greatest(current, a) + greatest(b, c)", "general"),
        ("current + a | b", "general"),
    ],
)
def test_kinds_of_fold(spark, script, fold):
    compiled = compile_script(spark, script, {})
    assert (compiled.runs, compiled.fold) == (compiled.runs, fold if compiled.runs else "general")


def test_scopes_keep_conflicting_names_apart(spark):
    scripts = [compile_script(spark, t, {}) for t in ("current + a", "current + A", "current + a.b", "current + c")]
    assert [len(s) for s in scopes(enumerate(scripts))] == [2, 1, 1]


def test_many_scripts_take_one_pass(spark, monkeypatch):
    raw = [{"refName": f"r{n}", "accScript": f"current + {n}"} for n in range(7)]
    known = definitions(spark, *raw)
    monkeypatch.setattr(evaluate, "SCRIPTS_PER_COLUMN", 3)
    evaluated = route_and_evaluate(orders(spark, known, [message("a")]), known)
    assert rows(evaluated, "ref_name", "increment") == [(f"r{n}", float(n)) for n in range(7)]
