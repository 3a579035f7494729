"""The inbound table brought up to date against a rebuild, and compliance from one pass."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from quayside.plans import compliance, incremental
from quayside.plans.inbound import InboundSources, inbound_data
from quayside.registry import QUERIES
from quayside.sources.keyed import KeyedState
from tests.helpers import bag, plan_text
from tests.test_inbound import PLAN
from tests.test_reports import INBOUND

KINDS = {
    "plan": PLAN,
    "po_lines": "sku string, pos string, ref string, status string, bp_qty long",
    "po_header": "order_id_raw string, delivery_due date",
    "dock_log": "seq long, pos string, date_booked string, partial_delivery string, date_received string",
    "qc": "sku string, pos string, qty_counted long, qc_date date",
    "damages": "sku string",
    "received": "message_reference string, item_code string, quantity_received long, received_date date",
    "stock": "item_code string, qty long",
}


def drawn(draw, kind, day):
    sku = draw.choice([None, *[f"P{i}" for i in range(12)]]) if kind != "plan" else f"P{draw.randint(0, 11)}"
    pos = draw.choice([None, "", *map(str, range(1, 9))])
    when = dt.date(2015, draw.randint(1, 12), draw.randint(1, 28))
    if kind == "plan":
        return (draw.randint(0, 10**6), draw.choice([sku, None]), "n", None, draw.choice(["", "E1"]), "C" + sku, "cn", "cat", "b", "s", "d",
                1.0, 7, draw.choice([0.0, 7.0]), draw.choice(["Approved", "Deleted"]), 6, when, when.month, when.year, None)
    return {
        "po_lines": (sku, pos, draw.choice(["r", None, "Sample"]), draw.choice(["Placed", "Draft PO", "Cancel PO"]), draw.randint(1, 9)),
        "po_header": (f"PO#{pos}", when),
        "dock_log": (draw.randint(0, 10**6), pos, draw.choice(["", str(when)]), "No", draw.choice(["", str(when)])),
        "qc": (sku, pos, draw.randint(1, 5), when),
        "damages": (sku,),
        "received": (pos, sku, draw.randint(1, 5), when),
        "stock": (sku, draw.randint(1, 5)),
    }[kind]


def frames(spark, tables):
    return InboundSources(**{k: spark.createDataFrame(tables[k], schema) for k, schema in KINDS.items()})


@pytest.mark.parametrize("given", ["stated", "compared"])
def test_three_days_equal_a_rebuild(spark, tmp_path, given):
    draw = random.Random(7)
    tables = {k: [drawn(draw, k, 0) for _ in range(25)] for k in KINDS}
    day = dt.date(2015, 5, 20)
    sources = frames(spark, tables)
    first = inbound_data(sources, day)
    state = incremental.inbound_state(spark, str(tmp_path / "inbound"), first, 4)
    state.replace(first.select("sku").distinct(), first)
    rewritten = []
    for step in (0, 12, 25):  # within a month, into the next and the one after
        previous, day = day, day + dt.timedelta(days=step)
        old = {k: list(v) for k, v in tables.items()}
        for kind in draw.sample(sorted(KINDS), 3):
            tables[kind] = tables[kind][1:] + [drawn(draw, kind, day)]
        new = frames(spark, tables)
        if given == "compared":
            changes = incremental.changes_between(frames(spark, old), new)
        else:
            changed = {k: [r for r in old[k] + tables[k] if old[k].count(r) != tables[k].count(r)] for k in KINDS}
            changes = incremental.InboundChanges(**{k: spark.createDataFrame(v, KINDS[k]) for k, v in changed.items() if v})
        rewritten.append(incremental.refresh_inbound(state, new, changes, day, previous))
        assert bag(state.read()) == bag(inbound_data(new, day))
    assert any(len(r) < 4 for r in rewritten) or len(rewritten) == 3


def test_nothing_changed_touches_nothing(spark, tmp_path):
    tables = {k: [drawn(random.Random(1), k, 0) for _ in range(5)] for k in KINDS}
    sources, day = frames(spark, tables), dt.date(2015, 5, 20)
    first = inbound_data(sources, day)
    state = incremental.inbound_state(spark, str(tmp_path / "inbound"), first, 4)
    state.replace(first.select("sku").distinct(), first)
    assert incremental.refresh_inbound(state, sources, incremental.InboundChanges(), day, day) == []


def test_the_first_table_is_computed_once(spark, sf_dir, monkeypatch):
    """Its items and its rows are read from a copy, not derived from the sources each time."""
    seen, replaced = [], KeyedState.replace

    def noted(state, keys, rows):
        seen.append({f.rsplit("/", 2)[-2] for df in (keys, rows) for f in df.inputFiles()})
        return replaced(state, keys, rows)

    monkeypatch.setattr(KeyedState, "replace", noted)
    assert QUERIES["incremental_inbound"](spark, sf_dir).count() > 0
    assert len(seen) == 2 and len(seen[0]) == 1 and seen[0].pop().startswith("inbound-")


def test_one_pass_gives_the_tabs(spark):
    draw = random.Random(3)
    day = lambda: draw.choice([None, dt.date(2015, 3, draw.randint(1, 28))])
    data = [
        (draw.choice([None, 2, 3]), draw.choice([None, "S", "T"]), draw.choice([None, "b", "c"]), draw.choice([None, *"12345"]), draw.choice([None, "r", "Sample"]),
         draw.choice(["Placed", "Draft PO", None]), draw.choice([None, 0, 4, 5]), 2.0, draw.randint(0, 5), 1, day(), day(), day())
        for _ in range(300)
    ]
    inbound = spark.createDataFrame(data, INBOUND)
    every = compliance.compliance_tabs(inbound)
    single = {"supplier": compliance.supplier_compliance, "buyer": compliance.buyer_compliance, "buyer_period": compliance.buyer_compliance_period}
    for tab, keys in compliance.TABS.items():
        expected = single[tab](inbound)
        found = every.filter(F.col("tab") == tab)
        shown = lambda df: {tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*expected.columns).collect()}  # noqa: E731, B023
        assert shown(found) == shown(expected) and found.count() == expected.count() > 1
        assert found.dropna(subset=list(keys)).count() == found.count()
    text = plan_text(every)
    assert text.count("Expand") == 1 and text.count("Exchange hashpartitioning") == 2
