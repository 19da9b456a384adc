"""Properties that hold for any sales, checked against plain Python on generated sales."""

from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fixtures import dimensions, sales_frame
from tallymart.plans import marts

CENT = Decimal("0.01")
SALES = st.lists(
    st.tuples(
        st.sampled_from([None, 1, 2, 3, 99]),
        st.sampled_from([121, 122, 999]),
        st.sampled_from([1, 2, 3, 4, 77]),
        st.sampled_from(["2023-03-01", "2023-03-31", "2023-04-01", None]),
        st.one_of(st.none(), st.sampled_from(["0.50", "1.00", "1.00", "149.50", "-3.25"])),
    ),
    min_size=1,
    max_size=25,
)
MANY = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def total(costs):
    known = [Decimal(c) for c in costs if c is not None]
    return sum(known) if known else None


def grouped(data, key):
    groups = defaultdict(list)
    for c, s, p, d, cost in data:
        if c in (1, 2, 3) and s in (121, 122) and p in (1, 2, 3, 4):
            groups[key(c, s, p, d and d[:7])].append(cost)
    return {k: total(v) for k, v in groups.items()}


@MANY
@given(SALES)
def test_customer_months(spark, data):
    got = marts.customer_monthly(sales_frame(spark, data), dimensions(spark)).collect()
    wanted = grouped(data, lambda c, s, p, m: (c, m))
    assert {(r.customer_id, r.sales_date_month): r.total_sales for r in got} == wanted
    assert len(got) == len(wanted)


@MANY
@given(SALES)
def test_only_the_best_of_a_store_and_month_are_paid(spark, data):
    got = marts.sales_person_monthly(sales_frame(spark, data), dimensions(spark)).collect()
    sums = grouped(data, lambda c, s, p, m: (s, p, m))
    wanted = {}
    for (s, p, m), own in sums.items():
        rivals = [t for (s2, _, m2), t in sums.items() if (s2, m2) == (s, m) and t is not None]
        best = max(rivals) if rivals else None
        if own != best:
            paid = Decimal(0)
        else:
            paid = None if own is None else (own * CENT).quantize(CENT, ROUND_HALF_UP)
        wanted[s, p, m] = (own, paid)
    assert {(r.store_id, r.sales_person_id, r.sales_month): (r.total_sales, r.incentive) for r in got} == wanted
    assert len(got) == len(wanted)
