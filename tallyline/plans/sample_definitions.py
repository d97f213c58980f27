"""Indicator definitions for the sample tables."""

from __future__ import annotations

EVENTS = (
    {"refName": "act_cnt_1d", "eventTypeCodes": ["purchase", "click"], "dimensions": ["userId"]},
    {
        "refName": "buy_amount_1d",
        "eventTypeCodes": ["purchase"],
        "dimensions": ["userId"],
        "accScript": "current + amount",
    },
    {
        "refName": "buy_amount_7d",
        "eventTypeCodes": ["purchase", "signup", "purchase"],
        "dimensions": ["userId"],
        "windowDays": 7,
        "sliceGranularity": " hour ",
        "accScript": "current + amount",
    },
    {
        "refName": "error_cnt_1d",
        "eventTypeCodes": ["error"],
        "dimensions": ["kind"],
        "sliceGranularity": "MINUTE",
    },
    {
        "refName": "view_amount_by_k",
        "eventTypeCodes": ["view"],
        "dimensions": ["userId", "k"],
        "accScript": "current + amount",
    },
    {
        "refName": "all_cnt_2d",
        "windowDays": 2,
        "sliceGranularity": "HOUR",
        "accScript": "current + 1",
    },
    {"refName": "coupon_cnt_1d", "eventTypeCodes": [], "dimensions": ["coupon"]},
    {"refName": "by_country", "eventTypeCodes": [], "dimensions": ["country"]},
    {
        "refName": "fails",
        "eventTypeCodes": ["click"],
        "dimensions": ["userId"],
        "accScript": "current + missingVar",
    },
    {"refName": "offline_cnt", "eventTypeCodes": ["click"], "dimensions": ["userId"], "status": "OFFLINE"},
)

ORDERS = (
    {"refName": "open_cnt_1d", "eventTypeCodes": ["EVT_OPEN"], "dimensions": ["customerId"]},
    {
        "refName": "filled_amount_30d",
        "eventTypeCodes": ["EVT_FILLED", "EVT_PENDING"],
        "dimensions": ["customerId", "priority"],
        "windowDays": 30,
        "accScript": "current + amount",
    },
    {"refName": "any_by_priority", "dimensions": ["priority"], "accScript": "amount + current"},
)

#: Two definitions of one name and key: the first fails where the amount is absent, so the second counts.
SAME_NAME = (
    {"refName": "mixed", "eventTypeCodes": ["purchase"], "dimensions": ["userId"], "accScript": "current + amount"},
    {
        "refName": "mixed",
        "eventTypeCodes": ["purchase", "click"],
        "dimensions": ["userId"],
        "sliceGranularity": "HOUR",
        "accScript": "current + 1",
    },
)

#: Many scripts of two forms.
MANY_SCRIPTS = tuple(
    {
        "refName": f"scaled_{n}",
        "eventTypeCodes": ["purchase"],
        "dimensions": ["kind"],
        "accScript": f"current + amount * {n}" if n % 2 else f"current + if(k > {n % 100}, amount, 0.5)",
    }
    for n in range(1, 2501)
)

#: Many running values: decays, and values that start again above a bound.
MANY_FOLDS = tuple(
    {
        "refName": f"fold_{n}",
        "eventTypeCodes": ["error"],
        "dimensions": ["kind"],
        "accScript": f"current * 0.{n % 9 + 1} + {('amount', 'k')[n % 2]}"
        if n < 150
        else f"if(current > {n}, {('amount', 'k')[n % 2]}, current + 1)",
    }
    for n in range(300)
)

EXTREMES = (
    {
        "refName": "largest",
        "eventTypeCodes": ["purchase", "view"],
        "dimensions": ["userId"],
        "accScript": "greatest(current, amount)",
    },
    {"refName": "largest_overall", "sliceGranularity": "HOUR", "accScript": "greatest(current, amount)"},
)

DECAY = (
    {
        "refName": "decayed",
        "eventTypeCodes": ["purchase", "error"],
        "dimensions": ["userId"],
        "accScript": "current * 0.5 + amount",
    },
)

#: A value that starts again once it passed a bound.
GENERAL = (
    {
        "refName": "restarts",
        "eventTypeCodes": ["purchase", "error"],
        "dimensions": ["userId"],
        "accScript": "if(current > 100, amount, current + amount)",
    },
    {
        "refName": "restarts_overall",
        "eventTypeCodes": ["purchase"],
        "sliceGranularity": "HOUR",
        "accScript": "if(current > 500, amount, current + amount)",
    },
)

#: A slice takes so much and no more.
CAPPED = (
    {
        "refName": "first_two",
        "eventTypeCodes": ["purchase", "click"],
        "dimensions": ["k"],
        "accScript": "if(current < 2, current + 1, null)",
    },
    {
        "refName": "below_100",
        "eventTypeCodes": ["purchase", "view"],
        "dimensions": ["k", "kind"],
        "accScript": "case when current + amount <= 100 then current + amount end",
    },
)

#: A definition, one that comes later, and the first with another script.
LIVE = (
    {"refName": "live", "eventTypeCodes": ["purchase", "click"], "dimensions": ["userId"]},
    {"refName": "later", "eventTypeCodes": ["purchase"], "dimensions": ["userId"], "accScript": "current + amount"},
    {"refName": "live", "eventTypeCodes": ["click"], "dimensions": ["userId"], "accScript": "current + amount + 1"},
)

TYPED = (
    {
        "refName": "large_buys",
        "dimensions": ["userId"],
        "accScript": "if(kind = 'purchase' and amount / (k - 1) > 1, current + amount, null)",
        "fieldTypes": {"kind": "string"},
    },
    {"refName": "not_a_number", "dimensions": ["userId"], "accScript": "kind = 'purchase'"},
    {"refName": "not_an_expression", "dimensions": ["userId"], "accScript": "current +"},
)
