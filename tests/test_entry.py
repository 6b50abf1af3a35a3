"""Driver contract and a sample of registered queries at sf0.001."""
import __spark_entry__ as E

from conftest import SF


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "duration_s" in df.columns


def test_every_oracle_has_a_query():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 90


def test_streaming_equals_batch(spark):
    s = E.queries()["stream_label"](spark, SF)
    assert s.count() == spark.read.parquet(f"{SF}/events.parquet").count()


def test_model_reload_scores_equal(spark):
    out = E.queries()["model_roundtrip"](spark, SF)
    assert out.where("NOT same").count() == 0
    assert out.where("p_fault < 0 OR p_fault > 1").count() == 0


def test_stream_tickets_equal_closed_batch_tickets(spark):
    from pyspark.sql import functions as F

    from faultline.operators import events as Ev
    from faultline.operators import labels as L
    from faultline.sources import tele_ev
    streamed = E.queries()["stream_tickets"](spark, SF)
    lab = L.k_of_n(tele_ev(spark, SF), ["vibration"], q=0.95, k=1, op=">")
    batch = Ev.gap_merge(lab, gap_sec=3600.0, keys=["asset"])
    wm = lab.where("label_fault = 1").agg(F.max("ts")).first()[0]
    closed = batch.where(F.timestamp_add("SECOND", F.lit(3600), F.col("end")) <= F.lit(wm))
    key = ["asset", "start", "end", "n_rows"]
    assert sorted(map(tuple, streamed.select(*key).collect())) == sorted(map(tuple, closed.select(*key).collect()))
