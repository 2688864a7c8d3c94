"""Whatever the batches hold and in whatever order they come."""

from __future__ import annotations

import tempfile
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

from tests.conftest import event, rows
from tidemark import Warehouse
from tidemark.operators.dimensions import dim_products, dim_users
from tidemark.operators.facts import fact_events, typed_events
from tidemark.operators.incremental import upsert

DAY = datetime(2020, 1, 1)

events = st.builds(
    event,
    event_time=st.sampled_from(["2019-10-01 00:00:00 UTC", "2019-10-02 00:00:00 UTC", "2019-11-01 05:00:00 UTC", "?"]),
    event_type=st.sampled_from(["view", "purchase", "cart", None]),
    product_id=st.sampled_from(["1", "01", "2", "x", None]),
    user_id=st.sampled_from(["7", "8", None]),
    user_session=st.sampled_from(["a", "b"]),
    price=st.sampled_from(["1.5", "2", "", None]),
)
batches = st.lists(st.lists(events, min_size=1, max_size=6), min_size=1, max_size=3)
few = settings(
    max_examples=4,
    deadline=None,
    derandomize=True,
    database=None,
    phases=[Phase.generate],
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)


def frames(bronze_frame, batches):
    return [
        bronze_frame(*batch, file=f"{i}.csv", at=DAY + timedelta(days=i)) for i, batch in enumerate(batches)
    ]


def ids(df):
    return sorted(r[0] for r in rows(df.select("event_id").filter("event_id IS NOT NULL")))


@few
@given(batches=batches, order=st.randoms())
def test_fact_ids_do_not_depend_on_order_or_redelivery(bronze_frame, batches, order):
    loads = frames(bronze_frame, batches)
    expected = {r[0] for load in loads for r in rows(typed_events(load).select("event_id"))} - {None}
    order.shuffle(loads)
    fact = fact_events(loads[0], DAY)
    for load in [*loads[1:], loads[0]]:
        fact = fact.union(fact_events(load, DAY, existing=fact))
    assert ids(fact) == sorted(expected)


@few
@given(batches=batches)
def test_dimensions_step_by_step_equal_all_at_once(bronze_frame, batches):
    loads = frames(bronze_frame, batches)
    everything = loads[0]
    for load in loads[1:]:
        everything = everything.union(load)
    for latest, key in ((dim_products, "product_id"), (dim_users, "user_id")):
        stepwise = latest(loads[0])
        for load in loads[1:]:
            stepwise = upsert(stepwise, latest(load), [key])
        assert sorted(rows(stepwise), key=str) == sorted(rows(latest(everything)), key=str)


@settings(few, max_examples=2)
@given(batches=batches)
@pytest.mark.parametrize("mode", ["merge", "replace_dates"])
def test_incremental_build_equals_full_refresh(spark, bronze_frame, mode, batches):
    """With unchanged dimensions; rows without id aside, of which each run keeps one."""
    with tempfile.TemporaryDirectory(prefix="tidemark-") as root:
        w = Warehouse(spark, root, mart_mode=mode, null_id="quarantine", on_violation="record")
        w.append_bronze(bronze_frame(*[event(product_id=p) for p in ("1", "2")], at=DAY), "dimension")
        for i, load in enumerate(frames(bronze_frame, batches)):
            w.append_bronze(load, str(i))
            w.build(DAY + timedelta(days=i, hours=1))
        stepwise = sorted(rows(w.mart.read().drop("_refreshed_at", "revenue")), key=str), ids(w.fact.read())
        w.build(DAY + timedelta(days=9), full_refresh=True)
        full = sorted(rows(w.mart.read().drop("_refreshed_at", "revenue")), key=str), ids(w.fact.read())
        assert stepwise == full
