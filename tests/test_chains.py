"""Breaker and alert masking against a plain sequential walk."""

import datetime as dt
import random
import uuid

import pytest

from tidewater.contracts import BreakerPolicy, MaskingPolicy
from tidewater.operators.alerts import advance_stored, mask_alerts, note_alert
from tidewater.operators.breaker import BreakerState, breaker_actions, breaker_states, next_state, quarantine_attempts
from tidewater.operators.tables import Layers

START = dt.datetime(2024, 1, 1)


@pytest.mark.parametrize("auto_recover", [True, False])
def test_breaker_history_equals_the_step_by_step_walk(spark, auto_recover):
    policy = BreakerPolicy(5, 60, "degrade_mode", auto_recover)
    rng = random.Random(3)
    rows = []
    for domain in range(30):
        at = START
        share = rng.choice([0.0, 0.2, 0.5, 0.9])
        for batch in range(rng.randint(1, 40)):
            at += dt.timedelta(minutes=rng.choice([0, 5, 60, 61, 1500, 4000]))
            pct = rng.choice([None, 5.0, 0.0]) if rng.random() > share else rng.choice([5.1, 100.0])
            rows.append((f"d{domain}", batch, at, pct))
    frame = spark.createDataFrame(rows, "domain string, batch_id long, batch_time timestamp, error_pct double")
    got = {(r["domain"], r["batch_id"]): r["breaker_state"] for r in breaker_states(frame, policy).collect()}
    want, states = {}, {}
    for domain, batch, at, pct in rows:
        states[domain] = next_state(states.get(domain, BreakerState()), pct, at, policy)
        want[domain, batch] = states[domain].state
    assert got == want
    assert {"CLOSED", "OPEN"} <= set(want.values()) and ("HALF_OPEN" in want.values()) == auto_recover


def test_breaker_threshold_is_strict():
    policy = BreakerPolicy(5, 30)
    assert next_state(BreakerState(), 5.0, START, policy).state == "CLOSED"
    opened = next_state(BreakerState(), 5.01, START, policy)
    assert opened == BreakerState("OPEN", START + dt.timedelta(minutes=30))
    assert next_state(opened, 0.0, START + dt.timedelta(minutes=29), policy).state == "OPEN"
    half = next_state(opened, 0.0, START + dt.timedelta(minutes=30), policy)
    assert half.state == "HALF_OPEN"
    assert next_state(half, 99.0, START, policy).state == "HALF_OPEN"
    assert next_state(half, 0.0, START, policy).state == "CLOSED"
    assert next_state(half, None, START, policy) == half


def test_attempts_by_state(spark):
    states = spark.createDataFrame([("CLOSED",), ("OPEN",), ("HALF_OPEN",)], "breaker_state string")
    rows = breaker_actions(states, BreakerPolicy(action="fail_fast"), 3).collect()
    for r in rows:
        assert r["quarantine_attempts"] == quarantine_attempts(r["breaker_state"], 3)
        assert r["refuse_batch"] == (r["breaker_state"] != "CLOSED") and not r["tolerate_errors"]


def test_alert_log_equals_the_sequential_walk(spark):
    rng = random.Random(5)
    silence = dt.timedelta(hours=1)
    occurrences = []
    # The first kind of error makes up most of all rows and repeats within the same moment.
    for kind, n in (("hot", 1500), ("b", 40), ("c", 3), ("d", 1)):
        for _ in range(n):
            at = START + dt.timedelta(seconds=rng.choice([rng.randint(0, 90_000), 3600, 7200, 7201]))
            occurrences.append((kind, "m" * 600, "iot", rng.randint(0, 3), at))
    frame = spark.createDataFrame(
        occurrences, "error_type string, error_message string, domain string, batch_id long, occurred_at timestamp"
    )
    got = {r["error_type"]: r for r in mask_alerts(frame, MaskingPolicy(silence_hours=1)).collect()}
    for kind in ("hot", "b", "c", "d"):
        times = sorted(o[4] for o in occurrences if o[0] == kind)
        count, until = 0, None
        for t in times:
            if until is None or t > until:
                count, until = count + 1, t + silence
        row = got[kind]
        assert (row["occurrence_count"], row["silenced_until"]) == (count, until)
        assert (row["first_occurrence"], row["last_occurrence"]) == (times[0], times[-1])
        assert len(row["error_message"]) == 500 and len(row["alert_id"]) == 16


def test_alerts_from_batch_to_batch_equal_the_sequential_walk(spark, tmp_path):
    """Decisions and log of each batch; batches of one moment, empty ones and a repeated last one."""
    layers = Layers(str(tmp_path / "tables"), f"a{uuid.uuid4().hex[:8]}_")
    layers.create(spark)
    rng, name, policy = random.Random(9), layers.table("system", "alert_state"), MaskingPolicy(silence_hours=1)
    silence, walked = dt.timedelta(hours=1), {}
    schema = "error_type string, error_message string, domain string, batch_id long, occurred_at timestamp"
    for batch in range(5):
        # Batches follow each other in time; a kind may fall silent for one of them.
        rows = [(k, "m", "iot", batch, START + dt.timedelta(hours=3 * batch, seconds=rng.choice([rng.randint(0, 10_000), 3600, 7200]))) for k in "ab" if batch != 2 or k == "a" for _ in range(rng.choice([1, 30]))]
        want = set()
        for k, *_, t in sorted(rows, key=lambda r: r[4]):
            count, until, first, last = walked.get(k, (0, None, t, t))
            if until is None or t > until:
                count, until = count + 1, t + silence
                want.add((k, t))
            walked[k] = count, until, first, max(last, t)
        frame = spark.createDataFrame(rows, schema)
        decisions = advance_stored(spark, name, frame, policy).collect()
        assert len(decisions) == len({(r[0], r[4]) for r in rows}) and sum(d["notifies"] for d in decisions) == len(want)
        assert {d["at"] for d in decisions if d["notifies"]} == {t for _, t in want}
    advance_stored(spark, name, frame.limit(0), policy)
    got = {r["error_type"]: (r["occurrence_count"], r["silenced_until"], r["first_occurrence"], r["last_occurrence"]) for r in spark.table(name).collect()}
    assert got == walked


def test_an_error_notifies_once_in_its_silence(spark, tmp_path):
    layers = Layers(str(tmp_path / "tables"), f"a{uuid.uuid4().hex[:8]}_")
    layers.create(spark)

    def told(batch, minutes, text="gone"):
        return note_alert(spark, layers, MaskingPolicy(silence_hours=1), "iot", batch, "silver", OSError(text), START + dt.timedelta(minutes=minutes))

    assert [told(0, 0), told(1, 30), told(2, 31, "other"), told(3, 61), told(4, 100)] == [True, False, True, True, False]
