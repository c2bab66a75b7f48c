"""Cleaner, insert-or-ignore and quintile scoring on hand-made fixtures."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillroll.operators.clean import clean_transactions, new_clean_counts
from tillroll.operators.dedupe import first_per_key, insert_or_ignore
from tillroll.operators.quantiles import exact_quantiles, quintile_score, values_at


def test_cleaner_fixture(spark):
    d = dt.date(2025, 1, 5)
    rows = [
        (None, "C1", "P1", d, Decimal("10.00"), 1, Decimal("1.00")),   # null id
        ("O2", "C1", "P1", None, Decimal("10.00"), 1, Decimal("1.00")),  # null date
        ("O3", "C1", "P1", d, Decimal("0.00"), 1, Decimal("1.00")),      # net 0
        ("O4", "C1", "P1", d, Decimal("-1.00"), 1, Decimal("1.00")),     # net -1
        ("O5", "C1", "P1", d, None, 1, Decimal("1.00")),                 # net null
        ("O6", "C1", "P1", d, Decimal("10.00"), 0, Decimal("1.00")),     # qty 0
        ("O7", "C1", "P1", d, Decimal("10.00"), 2, None),                # profit null -> kept
    ]
    df = spark.createDataFrame(rows, "order_id string, customer_id string, product_id string, order_date date, "
                                     "net_revenue decimal(18,2), quantity int, profit decimal(18,2)")
    counts = new_clean_counts()
    out = clean_transactions(df, counts).collect()
    assert [r.order_id for r in out] == ["O7"]
    assert out[0].profit == Decimal("0.00")
    assert counts.dropped() == 6


def test_cleaner_parses_text_dates(spark):
    df = spark.createDataFrame([("O1", "C", "P", "2025-02-03", Decimal("5.00"), 1, Decimal("1.00")),
                                ("O2", "C", "P", "not a date", Decimal("5.00"), 1, Decimal("1.00"))],
                               "order_id string, customer_id string, product_id string, order_date string, "
                               "net_revenue decimal(18,2), quantity int, profit decimal(18,2)")
    out = clean_transactions(df).collect()
    assert [(r.order_id, r.order_date) for r in out] == [("O1", dt.date(2025, 2, 3))]


def test_insert_or_ignore_first_wins_and_is_idempotent(spark):
    batch = spark.createDataFrame([("K1", 2, "late"), ("K1", 1, "early"), ("K2", 1, "only")],
                                  "k string, arrival int, v string")
    empty = spark.createDataFrame([], batch.schema)
    first = insert_or_ignore(empty, batch, ["k"], ["arrival"])
    assert sorted((r.k, r.v) for r in first.collect()) == [("K1", "early"), ("K2", "only")]
    again = insert_or_ignore(first, batch, ["k"], ["arrival"])
    assert again.count() == 0


def test_first_per_key_under_a_hot_key(spark):
    rows = [("HOT", i, f"v{i}") for i in range(3000)] + [(f"K{i}", i, "x") for i in range(100)]
    df = spark.createDataFrame(rows, "k string, arrival int, v string").repartition(8)
    out = {r.k: r.v for r in first_per_key(df, ["k"], ["arrival"]).collect()}
    assert out["HOT"] == "v0" and len(out) == 101


def test_qcut_fixture_collapse_and_strict(spark):
    vals = [1, 1, 1, 1, 1, 1, 2, 2, 3, 9]
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(vals)], "id long, x double")
    edges, least, most = exact_quantiles(df, "x", [0.2, 0.4, 0.6, 0.8])
    assert edges == pytest.approx([1, 1, 1.4, 2.2]) and (least, most) == (1, 9)
    scored = quintile_score(df, "x", "s")
    assert [r.s for r in scored.orderBy("id").collect()] == [1] * 6 + [4, 4, 5, 5]
    with pytest.raises(ValueError):
        quintile_score(df, "x", "s", mode="strict")
    with pytest.raises(ValueError):
        pd.qcut(pd.Series(vals), 5, labels=[1, 2, 3, 4, 5], duplicates="drop")


@pytest.mark.parametrize("fetch", [20_000, 60, 7])
def test_selected_values_are_those_of_the_sorted_rows(spark, fetch):
    """Positions found by narrowing brackets: hot values, nulls, many positions."""
    rnd = random.Random(fetch)
    vals = [None] * 30 + [5] * 700 + [6] * 400 + [rnd.randint(0, 3000) for _ in range(900)] + [9000, -4]
    df = spark.createDataFrame([(v,) for v in vals], "x long").repartition(3)
    kept = sorted(v for v in vals if v is not None)
    at = [1, 2, 3, 350, 701, 702, 1100, 1101, 1102, 1103, 1500, len(kept) - 1, len(kept)]
    assert values_at(df, "x", at, len(kept), fetch) == {p: kept[p - 1] for p in at}


@pytest.mark.parametrize("fetch", [20_000, 50])
def test_quintiles_equal_pandas_without_ties(spark, fetch):
    rnd = random.Random(3)
    vals = rnd.sample(range(100_000), 997)
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(vals)], "id long, x double")
    scored = quintile_score(df, "x", "s", fetch=fetch)
    got = [r.s for r in scored.orderBy("id").collect()]
    exp = pd.qcut(pd.Series(vals, dtype=float), 5, labels=[1, 2, 3, 4, 5]).astype(int).tolist()
    assert got == exp
    rev = quintile_score(df, "x", "r", reverse=True, fetch=fetch)
    assert [r.r for r in rev.orderBy("id").collect()] == [6 - s for s in exp]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 9), st.integers(0, 3)), max_size=40),
       st.lists(st.integers(0, 6), max_size=4))
def test_property_insert_or_ignore_matches_python(spark, batch, existing):
    rows = [(f"K{k}", a, f"v{v}") for k, a, v in batch]
    df = spark.createDataFrame(rows, "k string, arrival int, v string")
    target = spark.createDataFrame([(f"K{k}", 0, "old") for k in set(existing)], "k string, arrival int, v string")
    got = sorted(tuple(r) for r in insert_or_ignore(target, df, ["k"], ["arrival", "v"]).collect())
    first = {}
    for k, a, v in sorted(rows, key=lambda r: (r[1], r[2])):
        first.setdefault(k, (k, a, v))
    exp = sorted(r for k, r in first.items() if k not in {f"K{e}" for e in existing})
    assert got == exp


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.booleans(), st.one_of(st.none(), st.integers(-3, 5)), st.integers(-1, 3),
                          st.one_of(st.none(), st.integers(0, 9))), max_size=30))
def test_property_cleaner_matches_pandas(spark, data):
    d = dt.date(2025, 1, 1)
    rows = [(f"O{i}" if has_id else None, "C", "P", d,
             Decimal(net) if net is not None else None, qty, Decimal(p) if p is not None else None)
            for i, (has_id, net, qty, p) in enumerate(data)]
    schema = ("order_id string, customer_id string, product_id string, order_date date, "
              "net_revenue decimal(18,2), quantity int, profit decimal(18,2)")
    got = sorted((r.order_id, r.profit) for r in clean_transactions(spark.createDataFrame(rows, schema)).collect())
    pdf = pd.DataFrame(rows, columns=["order_id", "customer_id", "product_id", "order_date", "net_revenue",
                                      "quantity", "profit"], dtype=object)
    pdf = pdf.dropna(subset=["order_id", "customer_id", "product_id", "order_date", "net_revenue"])
    pdf = pdf[(pdf["net_revenue"] > 0) & (pdf["quantity"] > 0)]
    exp = sorted((o, Decimal(0) if p is None else p) for o, p in zip(pdf["order_id"], pdf["profit"]))
    assert got == exp


def test_derive_measures(spark):
    from tillroll.operators.measures import derive_measures
    df = spark.createDataFrame([("2025-11-03", Decimal("33.33"), 3, 15, Decimal("20.00"), True)],
                               "order_date string, unit_price decimal(18,2), quantity int, discount_pct int, "
                               "cost_price decimal(18,2), is_returned boolean")
    r = derive_measures(df).first()
    assert (r.gross_revenue, r.discount_amt, r.net_revenue, r.cost, r.profit) == (
        Decimal("99.99"), Decimal("15.00"), Decimal("84.99"), Decimal("60.00"), Decimal("24.99"))
    assert (r.year, r.month, r.month_name, r.quarter, r.is_returned) == (2025, 11, "November", "Q4", 1)
