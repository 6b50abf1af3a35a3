"""Event operators against a direct loop over the sorted rows (brute force)."""
import random
from datetime import datetime, timedelta

import pytest

from faultline.operators import events as E

T0 = datetime(2024, 1, 1)


def _rows(seed, n=400):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        ts = None if rnd.random() < 0.03 else T0 + timedelta(seconds=rnd.choice([0, 1, 5]) * rnd.randint(0, 3000))
        out.append((i, ts, 1 if rnd.random() < 0.4 else 0))
    return out


def _sorted(rows):
    return sorted(rows, key=lambda r: (r[1] is None, r[1] or T0, r[0]))


def _runs(rows, gap, null_splits=True, faults_only=False):
    """List of events (start, end, n) by walking the rows in time order."""
    ev, cur, prev_fault_t, prev_is_fault = [], None, None, False
    for rid, ts, y in _sorted(rows):
        if faults_only and y != 1:
            continue
        if y == 1:
            if cur is not None and prev_is_fault:
                if ts is not None and prev_fault_t is not None:
                    split = (ts - prev_fault_t).total_seconds() > gap
                else:
                    split = null_splits
            else:
                split = True
            if split:
                if cur is not None:
                    ev.append(cur)
                cur = [ts, ts, 1]
            else:
                cur[1] = ts
                cur[2] += 1
            prev_fault_t, prev_is_fault = ts, True
        else:
            if cur is not None:
                ev.append(cur)
                cur = None
            prev_is_fault = False
    if cur is not None:
        ev.append(cur)
    return sorted((str(a), str(b), n) for a, b, n in ev)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("strategy", ["ranged", "window"])
def test_run_events_brute_force(spark, seed, strategy):
    rows = _rows(seed)
    df = spark.createDataFrame(rows, "row_id long, ts timestamp_ntz, label_fault int")
    got = E.fault_events(df, gap_sec=600.0, strategy=strategy).collect()
    got = sorted((str(r["start"]), str(r["end"]), r["n_rows"]) for r in got)
    assert got == _runs(rows, 600.0)


@pytest.mark.parametrize("strategy", ["ranged", "window"])
def test_gap_merge_brute_force(spark, strategy):
    rows = _rows(3)
    df = spark.createDataFrame(rows, "row_id long, ts timestamp_ntz, label_fault int")
    got = E.gap_merge(df, gap_sec=900.0, strategy=strategy).collect()
    got = sorted((str(r["start"]), str(r["end"]), r["n_rows"]) for r in got)
    assert got == _runs(rows, 900.0, faults_only=True)


def test_event_ids_brute_force(spark):
    rows = _rows(4)
    df = spark.createDataFrame(rows, "row_id long, ts timestamp_ntz, label_fault int")
    got = {r["row_id"]: r["event_id"] for r in E.event_ids(df, gap_min=5.0).collect()}
    want, eid, prev_one, last_t = {}, -1, False, None
    for rid, ts, y in _sorted(rows):
        if y == 1:
            new = not prev_one
            if not new and ts is not None and last_t is not None and (ts - last_t).total_seconds() / 60 > 5.0:
                new = True
            eid += 1 if new else 0
            want[rid] = eid
            prev_one = True
        else:
            want[rid] = -1
            prev_one = False
        last_t = ts
    assert got == want
