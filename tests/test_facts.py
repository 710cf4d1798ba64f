from __future__ import annotations

import random
from itertools import combinations

import pytest

from plumbline import catalog
from plumbline.plans import root_cause
from plumbline.plans.facts import SHOP, FactModel, Measure, Reference
from plumbline.plans.semantic import Dimension, SemanticModel
from tests.conftest import SMALL


def small(spark):
    links = [Reference("line", "bill", "bill_id", "made"), Reference("bill", "client", "client_id", "made"), Reference("client", "city", "city_id", "made")]
    model = FactModel(links, {"country": Dimension("city", "country"), "kind": Dimension("bill", "kind")},
                      {"lines": Measure("line", "1L"), "amount": Measure("line", "amount"), "bills": Measure("bill", "1L"), "clients": Measure("client", "1L")},
                      {"lines": "lines", "amount": "amount", "bills": "bills", "clients": "clients", "lines_a_bill": "lines / nullif(bills, 0)"})
    return model.bind(
        city=spark.createDataFrame([("N", "FR", 2), ("N", "DE", 1), ("L", "UK", 1)], "city_id string, country string, made int"),
        client=spark.createDataFrame([(1, "N", 1), (2, "L", 1), (2, "N", 2), (3, None, 1)], "client_id int, city_id string, made int"),
        bill=spark.createDataFrame([(10, 1, "x", 1), (11, 1, "y", 1), (12, 2, "x", 1), (13, 9, "x", 1), (14, None, None, 1)],
                                   "bill_id int, client_id int, kind string, made int"),
        line=spark.createDataFrame([(10, 5), (10, 6), (12, 7), (None, 1), (99, 2), (14, 3)], "bill_id int, amount long"))


def test_three_hops_and_chasm(spark):
    rows = {r.country: r.asDict() for r in small(spark).query(["lines", "amount", "bills", "clients"], ["country"]).collect()}
    assert rows == {
        "DE": {"country": "DE", "lines": 2, "amount": 11, "bills": 2, "clients": 2},  # of (2, L) and (2, N) the fact counts both
        "UK": {"country": "UK", "lines": 1, "amount": 7, "bills": 1, "clients": 1},
        None: {"country": None, "lines": 3, "amount": 6, "bills": 2, "clients": 1}}


def test_single_facts_agree_and_filters_reach_all_facts(spark):
    model = small(spark)
    both = {r.kind: (r.lines, r.bills) for r in model.query(["lines", "bills"], ["kind"]).collect()}
    lines = {r.kind: r.lines for r in model.query(["lines"], ["kind"]).collect()}
    assert {k: v[0] for k, v in both.items() if v[0]} == lines
    found = model.query(["lines", "bills", "lines_a_bill"], [], {"country": "country = 'DE'"}).collect()
    assert [tuple(r) for r in found] == [(2, 2, 1.0)]


def test_paths():
    assert [r.to_table for r in SHOP.path("shipments", "customers")] == ["orders", "customers"]
    with pytest.raises(KeyError):
        SHOP.path("customers", "orders")
    twice = FactModel([*SHOP.references, Reference("shipments", "depots", "d", "x"), Reference("depots", "customers", "c", "x")], {}, {}, {})
    with pytest.raises(ValueError):
        twice.path("shipments", "customers")


def test_facts_of_the_shop_equal_single_requests(spark):
    model = catalog.shop_facts(spark, SMALL)
    both = {r.tier: r for r in model.query(["late_shipments", "rejected_count"], ["tier"]).collect()}
    for name in ("late_shipments", "rejected_count"):
        for r in model.query([name], ["tier"]).collect():
            assert both[r.tier][name] == r[name]


@pytest.mark.parametrize("seed", range(2))
def test_slices_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    dims = ["a", "b", "c"]
    rows = []
    for _ in range(600):
        key = tuple(rng.choice(["u", "v", "w", None]) for _ in dims)
        rows.append((*key, int(rng.random() < (0.8 if key[:2] == ("u", "v") else 0.1))))
    model = SemanticModel("t", [], {}, {d: Dimension("t", d) for d in dims}, {"bad": "bad", "n": "1L"}, {}, "a",
                          {"t": spark.createDataFrame(rows, "a string, b string, c string, bad long")})
    least_rows, share, above = 8, 0.03, 1.2
    count = lambda fixed: (sum(r[3] for r in rows if all(r[i] == v for i, v in fixed.items())),
                           sum(all(r[i] == v for i, v in fixed.items()) for r in rows))
    whole, expected = count({}), set()
    for size in (1, 2, 3):
        for at in combinations(range(3), size):
            for values in {tuple(r[i] for i in at) for r in rows}:
                fixed = dict(zip(at, values))
                bad, n = count(fixed)
                parents = [count({i: v for i, v in fixed.items() if i != gone}) for gone in at]
                excess = bad - n * (whole[0] / whole[1])
                if n >= least_rows and bad and excess >= share * whole[0] and bad / n >= above * max(p[0] / p[1] for p in parents):
                    expected.add((",".join(dims[i] for i in at), *(fixed.get(i) for i in range(3)), n, bad))
    found = root_cause.slices(model, "bad", "n", dims, least_rows, share, above)
    assert {tuple(r)[:6] for r in found.collect()} == expected and ("a,b", "u", "v", None) in {e[:4] for e in expected}
    assert root_cause.slices(model.bind(t=model.tables["t"].limit(0)), "bad", "n", dims).count() == 0
