import datetime as dt

import pytest

from cardwarden.streaming import jobs
from cardwarden.plans.incremental import write_by_month

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "transaction_id string, user_id string, t timestamp_ntz, amount double, is_suspicious boolean, s string"


def at(minutes, key, user="u", amount=1.0, flagged=False):
    return (key, user, T0 + dt.timedelta(minutes=minutes), amount, flagged, "seg")


def feed(spark, folder, *batches):
    """One file per micro-batch, in order."""
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)


@pytest.fixture
def dirs(tmp_path):
    return str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "checkpoint")


def test_late_rows_are_dropped(spark, dirs):
    source, out, checkpoint = dirs
    stream = feed(
        spark, source, [at(0, "a"), at(1, "b")], [at(60, "c")], [at(61, "e")], [at(2, "late")], [at(120, "d")]
    )
    jobs.append_to_table(jobs.velocity_stream(stream, "t"), out, checkpoint).awaitTermination()
    counts = {r.window_start: r.n for r in spark.read.parquet(out).collect()}
    assert counts[T0] == 2  # "late" is behind the watermark of 00:50
    assert max(counts) <= T0 + dt.timedelta(minutes=105)


def test_a_closing_event_brings_out_the_last_windows(spark, dirs, tmp_path):
    source, out, checkpoint = dirs
    rows = [at(0, "a"), at(1, "b"), at(30, "c", user="v"), at(31, "d")]
    stream = feed(spark, source, rows, [at(200, "e")], [at(201, "f")], [at(90, "late")])
    closing = str(tmp_path / "closing")
    counted = jobs.velocity_stream(stream, "t", closing=jobs.closing_stream(spark, closing, "t"))
    query = jobs.append_to_table(counted, out, checkpoint)
    query.awaitTermination()
    assert jobs.late_rows(query) == 5  # one row in five windows
    jobs.write_closing(spark.read.parquet(source), closing, "t")
    jobs.append_to_table(counted, out, checkpoint).awaitTermination()
    got = sorted((r.user_id, r.window_start, r.n) for r in spark.read.parquet(out).collect())
    kept = spark.createDataFrame([*rows, at(200, "e"), at(201, "f")], SCHEMA)
    want = sorted((r.user_id, r.window_start, r.n) for r in jobs.velocity_windows(kept.withColumn("t", kept.t.cast("timestamp")), "t").collect())
    assert got == want and max(w for _, w, _ in got) == T0 + dt.timedelta(minutes=201)


def test_replays_are_dropped_across_batches_and_restarts(spark, dirs):
    source, out, checkpoint = dirs
    stream = feed(spark, source, [at(0, "a"), at(1, "b"), at(1, "b")], [at(0, "a"), at(2, "c")])
    jobs.append_to_table(jobs.dedupe_stream(stream, "transaction_id", "t"), out, checkpoint).awaitTermination()
    stream = feed(spark, source, [at(2, "c"), at(3, "d")])
    jobs.append_to_table(jobs.dedupe_stream(stream, "transaction_id", "t"), out, checkpoint).awaitTermination()
    assert sorted(r.transaction_id for r in spark.read.parquet(out).collect()) == ["a", "b", "c", "d"]


def test_segment_totals_follow_updates(spark, dirs):
    source, out, checkpoint = dirs
    stream = feed(
        spark, source, [at(0, "a", amount=2.5, flagged=True)], [at(5, "b"), at(1500, "c", amount=4.0, flagged=True)]
    )
    jobs.update_table(jobs.segment_stream(stream, "t", "s"), out, checkpoint, every=None).awaitTermination()
    rows = jobs.latest(spark, out, ["window_start", "s"]).orderBy("window_start").collect()
    assert [(r.total, r.suspicious, r.amount_suspicious) for r in rows] == [(2, 1, 2.5), (1, 1, 4.0)]


def test_a_hundred_batches_are_read_from_a_snapshot_and_the_newer_ones(spark, dirs):
    _, out, _ = dirs
    want = {}
    for batch in range(100):
        rows = [(f"k{(batch * 7 + i) % 40}", batch * 10 + i, batch) for i in range(3)]
        want |= {k: v for k, v, _ in rows}
        spark.createDataFrame(rows, "k string, v long, batch_id long").coalesce(1).write.parquet(f"{out}/batch_{batch:010d}")
        if batch in (29, 59, 89):
            jobs.fold(spark, out, ["k"])
    found = jobs.latest(spark, out, ["k"])
    assert {r.k: r.v for r in found.collect()} == want
    folders = {f.split("/")[-2] for f in found.inputFiles()}
    assert folders == {"snapshot_0000000089", *[f"batch_{b:010d}" for b in range(90, 100)]}
    # an unfinished snapshot does not count, and what stood before the last but one is gone
    spark.range(1).write.parquet(f"{out}/snapshot_0000000099")
    import os

    os.remove(f"{out}/snapshot_0000000099/_SUCCESS")
    assert {r.k: r.v for r in jobs.latest(spark, out, ["k"]).collect()} == want
    assert not os.path.exists(f"{out}/batch_0000000059") and os.path.exists(f"{out}/batch_0000000060")


def test_a_stream_folds_its_batches(spark, dirs):
    source, out, checkpoint = dirs
    stream = feed(spark, source, *[[at(m, f"t{m}", amount=1.0, flagged=True)] for m in range(5)])
    segments = jobs.segment_stream(stream, "t", "s")
    jobs.update_table(segments, out, checkpoint, every=None, keys=["window_start", "s"], fold_every=2).awaitTermination()
    row = jobs.latest(spark, out, ["window_start", "s"]).first()
    assert (row.total, row.suspicious, row.amount_suspicious) == (5, 5, 5.0) and jobs._complete(spark, out, "snapshot_")


def test_stream_upserts_into_months(spark, dirs):
    source, out, checkpoint = dirs
    dated = "transaction_id string, transaction_date timestamp_ntz, v int"
    write_by_month(spark.createDataFrame([("a", T0, 0), ("z", T0, 0)], dated), out)
    for rows in ([("a", T0, 1)], [("a", T0, 2), ("b", T0 + dt.timedelta(days=40), 2)]):
        spark.createDataFrame(rows, dated).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(dated).option("maxFilesPerTrigger", 1).parquet(source)
    jobs.upsert_into_months(
        stream, out, checkpoint, "transaction_id", "transaction_date", every=None
    ).awaitTermination()
    assert {r.transaction_id: r.v for r in spark.read.parquet(out).collect()} == {"a": 2, "b": 2, "z": 0}
