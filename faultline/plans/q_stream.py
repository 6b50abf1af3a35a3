"""Streaming queries (K1, K2): run with availableNow over a file stream of
``tele_ev`` and compared with the batch computation."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import streaming as K
from ..operators import labels as L
from ..session import scratch_path
from ..sources import tele_ev
from .catalog import EV_LAB_SQL, TELE_EV_SQL, islands_sql, register


def _source(spark, sf_dir):
    t = tele_ev(spark, sf_dir).select("row_id", "ts", "asset", "vibration")
    path = scratch_path(spark, f"faultline-stream-src-{uuid.uuid4().hex[:12]}")
    K.write_stream_source(t, path)
    return t, K.read_stream(spark, path, t.schema)


@register("stream_label", f"""
WITH {EV_LAB_SQL}
SELECT row_id, asset, label_fault FROM ev_lab""")
def q_stream_label(spark, sf_dir):
    """K1: P95 threshold frozen from the table, applied to the stream."""
    t, stream = _source(spark, sf_dir)
    thr = L.quantile_thresholds(t, ["vibration"], 0.95)
    out = K.run_available_now(K.label_stream(stream, ["vibration"], thr), spark, "label")
    return out.select("row_id", "asset", "label_fault")


@register("stream_tickets", f"""
WITH {EV_LAB_SQL},
fr AS (SELECT * FROM ev_lab WHERE label_fault = 1),
{islands_sql("fr", "3600000000.0", partition="asset")},
tk AS (SELECT asset, min(ts) AS start, max(ts) AS "end", count(*) AS n_rows FROM isl GROUP BY asset, event_no)
SELECT * FROM tk WHERE epoch_us("end") + 3600000000 <= (SELECT epoch_us(max(ts)) FROM fr)""")
def q_stream_tickets(spark, sf_dir):
    """K2: tickets closed by the watermark (0 s delay, 3,600 s gap).  The
    fault filter does not touch the event time, so Catalyst pushes it below
    the watermark: the watermark follows the latest *fault* row, and after
    the final no-data batch every ticket ending one gap before it is out."""
    t, stream = _source(spark, sf_dir)
    thr = L.quantile_thresholds(t, ["vibration"], 0.95)
    lab = K.label_stream(stream, ["vibration"], thr)
    return K.run_available_now(K.ticket_stream(lab, 3600.0), spark, "tickets")
