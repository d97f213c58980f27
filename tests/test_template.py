from __future__ import annotations

import pytest
from helpers import definitions, message, orders, rows

from tallyline.functions.script import compile_script
from tallyline.functions.template import keywords_of, lift, template_of
from tallyline.operators.evaluate import route_and_evaluate


def lifted(spark, text, **types):
    return lift(text, types, keywords_of(spark))


def test_scripts_that_differ_in_numbers_and_names_have_one_shape(spark):
    one, other = lifted(spark, "current + amount * 3"), lifted(spark, "current + price * 17")
    assert one.shape == other.shape and (one.numbers, other.numbers) == ((3.0,), (17.0,))
    assert one.names == (("amount",),) and lifted(spark, "current + a.b").names == (("a", "b"),)
    assert lifted(spark, "current + a + a").shape != lifted(spark, "current + a + b").shape
    assert lifted(spark, "current + 1").shape != lifted(spark, "current + 1.5").shape
    assert lifted(spark, "if(s = 'a1', a, 2)", s="string").shape != lifted(spark, "if(s = 'a2', a, 2)", s="string").shape
    assert lifted(spark, "if(s = 1, a, 2)", s="string").shape != lifted(spark, "if(s = 1, a, 2)").shape


@pytest.mark.parametrize("text", ["current + `a b`", "current + 1 -- x", "current + a + A", "__t_p0 + 1"])
def test_scripts_that_are_not_lifted(spark, text):
    assert lifted(spark, text) is None


@pytest.mark.parametrize(
    "text", ["round(current + a, 2)", "current + a * (0.1 + 0.2)", "current + array(a, b)[1]", "if(a > b, 1, 2)", "a + 5 div 2"]
)
def test_numbers_whose_place_matters_stay(spark, text):
    assert template_of(spark, lifted(spark, text), text) is None


@pytest.mark.parametrize("text", ["current + x * 2", "current * 0.25 + a", "if(current < 5, current + 1, null)", "least(current, k % 7)"])
def test_a_template_is_what_its_script_is(spark, text):
    template, script = template_of(spark, lifted(spark, text), text), compile_script(spark, text, {})
    assert template.runs and template.fold == script.fold


def test_numbers_and_names_come_from_the_definition(spark):
    scripts = {f"r{n}": f"current + if({name} > {n}, {name} * {n}.25, {n + 1}.5)" for n in range(6) for name in [("a", "b", "c.d")[n % 3]]}
    known = definitions(spark, *({"refName": r, "accScript": s} for r, s in scripts.items()))
    assert len(known.scripts) == 1
    fields = {"a": 3, "b": 1.5, "c": {"d": 9}}
    sent = [message("o", "E", 0, **fields), message("p", "E", 0, a=4)]
    wanted = []
    for n in range(6):
        for order, given in (("o", fields), ("p", {"a": 4})):
            value = {0: given.get("a"), 1: given.get("b"), 2: given.get("c", {}).get("d")}[n % 3]
            wanted.append((f"r{n}", order, value * (n + 0.25) if value is not None and value > n else n + 1.5))
    got = rows(route_and_evaluate(orders(spark, known, sent), known), "ref_name", "order_id", "increment")
    assert got == sorted(wanted)
