"""Property test: Spark event validation equals a direct restatement of the rules on
random payloads (missing keys, null values, odd amounts and codes)."""

import json
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerflow import constants as C
from ledgerflow.operators import events as E

FIELDS = ["transaction_id", "customer_id", "merchant_id", "amount", "currency", "timestamp"]

amounts = st.one_of(st.none(), st.sampled_from(["abc", "12.5", "-1", "0", "1e3"]),
                    st.decimals(min_value=Decimal("-10"), max_value=Decimal("2000000"), places=2,
                                allow_nan=False, allow_infinity=False).map(float))
payloads = st.fixed_dictionaries({}, optional={
    "transaction_id": st.one_of(st.none(), st.text("TX_0123", min_size=0, max_size=6)),
    "customer_id": st.just("C1"),
    "merchant_id": st.one_of(st.none(), st.just("M1")),
    "amount": amounts,
    "currency": st.one_of(st.none(), st.sampled_from(["usd", "EUR", "FAKE", "gbp", "XXX"])),
    "timestamp": st.just("2024-01-01T00:00:00"),
})


def expected_error(p: dict):
    missing = sorted(set(FIELDS) - set(p))
    if missing:
        return "Missing required fields: " + ", ".join(missing)
    raw = p["amount"]
    try:
        amt = float(raw)
        if amt <= 0:
            raise ValueError(f"Invalid amount: {amt} (must be > 0)")
        if amt > float(C.EVENT_MAX_AMOUNT):
            raise ValueError(f"Amount exceeds maximum: {amt}")
    except (TypeError, ValueError) as e:
        return f"Invalid amount: {raw} — {e}"
    cur = "None" if p["currency"] is None else str(p["currency"])
    if cur.upper() not in C.VALID_CURRENCIES:
        return f"Invalid currency: {cur.upper()}"
    tid = "None" if p["transaction_id"] is None else p["transaction_id"]
    if len(tid) < 3:
        return f"Invalid transaction_id: {tid}"
    return None


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(payloads, min_size=150, max_size=150))
def test_validation_matches_rules(spark, batch):
    df = spark.createDataFrame([(i, json.dumps(p)) for i, p in enumerate(batch)], "event_id long, line string")
    v = E.validate(E.unwrap(df))
    got = {r["event_id"]: r["_error"] for r in v.collect()}
    for i, p in enumerate(batch):
        if i not in got:
            # a bare object without transaction_id is not recognised as an event
            assert "transaction_id" not in p
            continue
        assert got[i] == expected_error(p), (p, got[i])
