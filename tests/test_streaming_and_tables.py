"""Streaming replay / late data, persisted upsert, archive write, sampler
brute force, alert states sanity."""

import datetime as dt
import os
import random
import tempfile

from pyspark.sql import functions as F

from metroflux.operators import sampler as SM
from metroflux.sources import archive as AR
from metroflux.sources import batches as B
from metroflux.streaming import jobs as J
from tests.test_reference_cases import BASE, SCHEMA, reading


def _land(spark, rows, path):
    from metroflux.operators import messages as M
    df = spark.createDataFrame([tuple(dict(BASE, **r)[k] for k in BASE) for r in rows], SCHEMA)
    (M.encode(df).withColumn("publish_time", F.current_timestamp())
     .select("body", "attributes", "publish_time").coalesce(1).write.mode("append").json(path))


def test_stream_ingest_replay_is_idempotent_and_accepts_late_rows(spark):
    base = tempfile.mkdtemp(prefix="mf-ingest-")
    land = os.path.join(base, "landing")
    t0 = dt.datetime(2026, 5, 20, 12, 0)
    rows = [dict(time=t0 + dt.timedelta(minutes=i), value=float(i)) for i in range(5)]
    rows.append(dict(time=t0 - dt.timedelta(days=3), value=1.0, ingested_at=t0))       # late: still accepted
    rows.append(dict(time=t0, sensor_id=" ", value=1.0))                                # rejected
    _land(spark, rows, land)
    args = (land, base + "/hot", base + "/dead", base + "/metrics")
    J.stream_ingest(spark, *args, checkpoint=base + "/ckpt").awaitTermination()
    first = sorted(tuple(r) for r in J.hot_table(spark, base + "/hot").drop("p_date").collect())
    _land(spark, rows, land)                                                             # redelivery
    J.stream_ingest(spark, *args, checkpoint=base + "/ckpt").awaitTermination()
    second = sorted(tuple(r) for r in J.hot_table(spark, base + "/hot").drop("p_date").collect())
    assert len(first) == 6 and first == second
    assert J.dead_letters(spark, base + "/dead").count() == 2                            # one per delivery


def _messages(spark, rows, published):
    from metroflux.operators import messages as M
    df = spark.createDataFrame([tuple(dict(BASE, **r)[k] for k in BASE) for r in rows], SCHEMA)
    return M.encode(df).withColumn("publish_time", F.lit(published).cast("timestamp")).select("body", "attributes", "publish_time")


def test_first_batch_without_a_good_row_and_rerun_of_a_batch(spark):
    base = tempfile.mkdtemp(prefix="mf-bad-")
    sink = J.ingest_batch(spark, base + "/hot", base + "/dead", base + "/metrics", now="2026-05-20 13:00:00")
    bad = _messages(spark, [dict(sensor_id=" ")] * 2, "2026-05-20 12:30:00")
    sink(bad, 0)
    assert J.hot_table(spark, base + "/hot").count() == 0 and J.dead_letters(spark, base + "/dead").count() == 2
    good = _messages(spark, [dict(value=float(i), time=dt.datetime(2026, 5, 20, 12, i)) for i in range(3)], "2026-05-20 12:31:00").unionByName(bad)
    for _ in range(2):                                                                   # the same batch id twice
        sink(good, 1)
        assert J.hot_table(spark, base + "/hot").count() == 3 and J.dead_letters(spark, base + "/dead").count() == 4
        m = {r.batch_id: r for r in J.batch_metrics(spark, base + "/metrics").collect()}
        assert [(m[i].accepted, m[i].rejected, m[i].dropped_readings_total) for i in (0, 1)] == [(0, 2, 2), (3, 2, 4)]
        assert m[1].channel_fill_pct == 0 and m[1].readings_per_second > 0 and m[1].pubsub_lag_ms > 0


def test_a_batch_of_far_more_messages_than_the_capacity(spark):
    """The fill is 100 at most, also where 100 * messages / capacity is past a
    smallint (3.3 million messages at a capacity of 10,000)."""
    base = tempfile.mkdtemp(prefix="mf-full-")
    t0 = dt.datetime(2026, 5, 20, 12, 0)
    many = _messages(spark, [dict(time=t0 + dt.timedelta(seconds=i)) for i in range(400)], "2026-05-20 12:30:00")
    J.ingest_batch(spark, base + "/hot", base + "/dead", base + "/metrics", now="2026-05-20 13:00:00", capacity=1)(many, 0)
    m = J.throughput_metrics(J.batch_metrics(spark, base + "/metrics")).collect()
    assert [(r.input_rows, r.accepted, r.channel_fill_pct) for r in m] == [(400, 400, 100)]
    assert J.hot_table(spark, base + "/hot").count() == 400


def test_newer_publish_time_wins_whatever_the_file_order(spark):
    base = tempfile.mkdtemp(prefix="mf-order-")
    t0 = dt.datetime(2026, 5, 20, 12, 0)
    new = _messages(spark, [dict(time=t0, value=2.0)] + [dict(time=t0 + dt.timedelta(seconds=i), value=7.0) for i in range(1, 400)], "2026-05-20 12:10:00")
    old = _messages(spark, [dict(time=t0, value=1.0)], "2026-05-20 12:05:00")
    for k, batch in enumerate((new.unionByName(old), old.unionByName(new))):
        J.ingest_batch(spark, f"{base}/hot{k}", f"{base}/dead{k}", f"{base}/metrics{k}")(batch, 0)
        assert J.hot_table(spark, f"{base}/hot{k}").filter(F.col("time") == F.lit(t0)).first().value == 2.0


def test_two_cuts_of_the_same_messages_give_one_table(spark):
    """An older message in a later batch does not win."""
    t0 = dt.datetime(2026, 5, 20, 12, 0)
    new = _messages(spark, [dict(time=t0, value=2.0)], "2026-05-20 12:10:00")
    old = _messages(spark, [dict(time=t0, value=1.0), dict(time=t0 + dt.timedelta(days=1), value=5.0)], "2026-05-20 12:05:00")
    tables = []
    for cut in ([new.unionByName(old)], [new, old], [old, new], [old, new, old]):
        base = tempfile.mkdtemp(prefix="mf-cut-")
        sink = J.ingest_batch(spark, base + "/hot", base + "/dead", base + "/metrics")
        for i, batch in enumerate(cut):
            sink(batch, i)
        hot = J.hot_table(spark, base + "/hot")
        tables.append(sorted(tuple(r) for r in hot.collect()))
        plan = hot.filter(F.col("p_date") == dt.date(2026, 5, 20))._jdf.queryExecution().executedPlan().toString()
        assert "p_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert all(t == tables[0] for t in tables) and [r[3] for r in tables[0]] == [2.0, 5.0]


def test_batches_without_a_finished_folder_do_not_count(spark):
    path = tempfile.mkdtemp(prefix="mf-batches-") + "/t"
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    assert B.batch_ids(spark, path) == [] and B.read_batches(spark, path, df.schema).count() == 0
    for _ in range(2):
        B.write_batch(df, path, 0)
    B.write_batch(df, path, 2)
    os.makedirs(path + "/batch_id=7")
    assert B.batch_ids(spark, path) == [0, 2] and B.last_before(spark, path, 7) == 2 and B.last_before(spark, path, 1) == 0 and B.last_before(spark, path, 0) is None
    assert B.read_batches(spark, path, df.schema).count() == 2 and B.read_batches(spark, path, df.schema, only=2).count() == 1


def test_every_sink_can_run_a_batch_again(spark):
    t0 = dt.datetime(2026, 5, 20, 12, 0)
    batches = [reading(spark, time=t0, value=10.0).unionByName(reading(spark, time=t0 + dt.timedelta(minutes=10), value=20.0)),
               reading(spark, time=t0 - dt.timedelta(days=2), value=1.0).unionByName(reading(spark, time=t0, value=10.0))]
    results = []
    for order in ([0, 1], [0, 0, 1, 1], [1, 0]):
        base = tempfile.mkdtemp(prefix="mf-sinks-")
        sinks = [J.hourly_batch(spark, base + "/states", base + "/hours"), J.state_batch(spark, base + "/latest", base + "/sources"),
                 J.dedup_batch_sink(spark, base + "/once", batches[0].schema)]
        number = {b: i for i, b in enumerate(dict.fromkeys(order))}
        for b in order:
            for sink in sinks:
                sink(batches[b], number[b])
        kind = batches[0].schema
        hours = J.hourly_table(spark, base + "/hours", kind["value"].dataType, kind["time"].dataType)
        results.append([sorted(tuple(r) for r in df.collect()) for df in (
            hours, J.latest_state(spark, base + "/latest"), J.source_state(spark, base + "/sources"),
            B.read_batches(spark, base + "/once", kind, by_day=True).drop("batch_id", "p_date"))])
    assert results[0] == results[1] == results[2]
    hours, latest, sources, once = results[0]
    assert [(r[0], r[3], r[6]) for r in hours] == [(t0 - dt.timedelta(days=2), 1.0, 1), (t0, 40 / 3, 3)]     # two days late, and in its hour
    assert len(once) == 3 and [r[0] for r in latest] == [t0 + dt.timedelta(minutes=10)] and len(sources) == 1


def test_alerts_read_the_kept_state_only(spark):
    from metroflux.operators import alerts as AL
    base = tempfile.mkdtemp(prefix="mf-state-")
    sink = J.state_batch(spark, base + "/latest", base + "/sources")
    for i in range(3):
        at = dt.datetime(2026, 5, 20, 12, 10 * i)
        sink(reading(spark, time=at, ingested_at=at), i)
    state = AL.alert_no_ingestion(J.source_state(spark, base + "/sources"), "2026-05-20 12:50:00")
    assert state.first().value == 30.0
    files = state.inputFiles()
    assert files and all("/sources/batch_id=2/" in f for f in files)


def test_redelivery_backs_off_and_gives_up(spark):
    base = tempfile.mkdtemp(prefix="mf-retry-")
    fails = {"a": 0, "b": 2, "c": 9}
    msgs = spark.createDataFrame([(k, {"n": str(v)}, None) for k, v in fails.items()], J.MESSAGE_FILE_SCHEMA)
    step = J.redelivery(spark, base + "/ledger", base + "/settled", lambda attempt: F.col("attributes")["n"].cast("int") >= attempt)
    t0, seen = dt.datetime(2026, 5, 20, 12, 0), []
    for i, s in enumerate([0, 9, 10, 29, 30, 69, 70, 149, 150, 151]):
        for _ in range(2 if i % 3 == 0 else 1):                                          # some steps run twice
            step(msgs if i == 0 else None, i, t0 + dt.timedelta(seconds=s))
        seen.append(B.read_batches(spark, base + "/ledger", J.LEDGER_SCHEMA, only=i).count())
    settled = {r.body: (r.attempts, r.outcome, (r.settled_at - t0).seconds) for r in J.settled_messages(spark, base + "/settled").collect()}
    assert settled == {"a": (1, "accepted", 0), "b": (3, "accepted", 30), "c": (5, "dead_letter", 150)}
    assert seen == [2, 2, 2, 2, 1, 1, 1, 1, 0, 0]


def test_redelivery_holds_no_attempts_in_memory(spark, monkeypatch):
    """A task reads a file split at most, no cached partition; what is drawn
    at an attempt is drawn once, so no message is lost or doubled."""
    base = tempfile.mkdtemp(prefix="mf-draw-")
    msgs = spark.range(2000).select(F.col("id").cast("string").alias("body"), F.create_map(F.lit("n"), F.lit("1")).alias("attributes"), F.lit(None).cast("timestamp").alias("publish_time"))
    step, t0 = J.redelivery(spark, base + "/ledger", base + "/settled", lambda attempt: F.rand() < 0.5), dt.datetime(2026, 5, 20, 12, 0)
    with monkeypatch.context() as m:
        m.setattr(type(msgs), "persist", lambda df, *a: (_ for _ in ()).throw(AssertionError("held in memory")))
        for i, s in enumerate([0, 10, 30, 70, 150]):
            step(msgs if i == 0 else None, i, t0 + dt.timedelta(seconds=s))
    settled = J.settled_messages(spark, base + "/settled")
    assert settled.count() == settled.select("body").distinct().count() == 2000
    assert {r[0] for r in settled.select("outcome").distinct().collect()} == {"accepted", "dead_letter"}
    assert not [f for _, d, _ in os.walk(base + "/settled") for f in d if "waiting" in f]
    waits = spark.range(1, 12).select(J.backoff_seconds(F.col("id").cast("int")).alias("s")).collect()
    assert [int(r.s) for r in waits] == [10, 20, 40, 80, 160, 320, 600, 600, 600, 600, 600]


def test_prune_in_place_touches_only_days_with_rows_to_delete(spark):
    from metroflux.operators import tables as TB
    path = tempfile.mkdtemp(prefix="mf-prune-") + "/t"
    day = lambda d: dt.datetime(2026, 5, d, 12, 0)
    rows = None
    for kw in (dict(time=day(1), metric="NO2", unit="ppb"), dict(time=day(2), metric="NO2", unit="ppb"), dict(time=day(2)), dict(time=day(3)), dict(time=day(19), metric="NO2", unit="ppb")):
        r = reading(spark, **kw)
        rows = r if rows is None else rows.unionByName(r)
    rows.withColumn("p_date", F.to_date("time")).write.partitionBy("p_date").parquet(path)
    before = {d: sorted(os.listdir(f"{path}/{d}")) for d in os.listdir(path) if d.startswith("p_date")}
    assert TB.prune_in_place(spark, path, "2026-05-20 00:00:00", 7) == 2
    after = {d: sorted(os.listdir(f"{path}/{d}")) for d in os.listdir(path) if d.startswith("p_date")}
    assert set(before) - set(after) == {"p_date=2026-05-01"}
    assert all(after[d] == before[d] for d in ("p_date=2026-05-03", "p_date=2026-05-19"))
    assert sorted((r.time.day, r.metric) for r in spark.read.parquet(path).collect()) == [(2, "PM2.5"), (3, "PM2.5"), (19, "NO2")]
    assert TB.prune_in_place(spark, path, "2026-05-20 00:00:00", 7) == 0


def test_export_by_digest_reads_differing_days_only(spark):
    from metroflux.operators import tables as TB
    root = tempfile.mkdtemp(prefix="mf-digest-") + "/a"
    base = reading(spark).select(*[F.col(c).cast("timestamp_ntz").alias(c) if c in ("time", "ingested_at") else F.col(c) for c in reading(spark).columns])
    day = lambda d, h=12, v=1.0: base.withColumn("time", F.lit(dt.datetime(2026, 5, d, h)).cast("timestamp_ntz")).withColumn("value", F.lit(v))
    archived = day(1).unionByName(day(2)).unionByName(day(3))
    AR.write_archive(archived, root)
    manifest = TB.partition_digests(AR.read_archive(spark, root))
    hot = archived.unionByName(day(2, 13)).unionByName(day(4)).filter(F.dayofmonth("time") != 3).unionByName(day(3, v=9.0))
    out = AR.export_by_digest(spark, hot, manifest, root)
    assert sorted((r.time.day, r.time.hour) for r in out.collect()) == [(2, 13), (4, 12)]
    read = {f.split("day=")[1][:2] for f in out.inputFiles() if root in f}
    assert read == {"02", "03"}
    states = {r.day.day: r.status for r in TB.differing_partitions(TB.partition_digests(hot), manifest).collect()}
    assert states == {2: "count_mismatch", 3: "content_mismatch", 4: "missing_in_archive"}
    assert AR.export_by_digest(spark, archived, manifest, root).count() == 0


def test_radius_across_the_date_line_and_at_the_poles(spark):
    import math

    from metroflux.operators import latest as LT
    rnd = random.Random(3)
    points = [(rnd.uniform(-0.4, 0.4) + la, lo) for la in (-16.0, 65.0) for lo in [rnd.uniform(179.7, 180) * rnd.choice([1, -1]) for _ in range(150)]]
    points += [(rnd.choice([1, -1]) * rnd.uniform(89.6, 90), rnd.uniform(-180, 180)) for _ in range(200)]

    def far(a, b, c, d):
        a, b, c, d = map(math.radians, (a, b, c, d))
        h = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
        return 2 * LT.EARTH_RADIUS_M * math.asin(math.sqrt(h))
    path = tempfile.mkdtemp(prefix="mf-radius-") + "/p"
    kinds = (("double", "double"), ("decimal(9,6)", "decimal(9,6)"))
    for i, (a, b) in enumerate(kinds):
        df = spark.createDataFrame([(f"{n:04d}", round(x, 6), round(y, 6)) for n, (x, y) in enumerate(points)], "sensor_id string, latitude double, longitude double")
        df.select("sensor_id", F.col("latitude").cast(a).alias("latitude"), F.col("longitude").cast(b).alias("longitude")).write.parquet(f"{path}{i}")
        stored = spark.read.parquet(f"{path}{i}")
        for lat, lon in ((-16.0, 179.9995), (-16.1, -179.99), (65.2, 180.0), (89.9, 12.0), (-89.95, -100.0), (90.0, 0.0)):
            got = LT.within_radius(stored, lat, lon, 20_000)
            want = sorted(f"{n:04d}" for n, (x, y) in enumerate(points) if round(far(lat, lon, round(x, 6), round(y, 6)), 3) <= 20_000)
            assert sorted(r.sensor_id for r in got.collect()) == want and want
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "GreaterThanOrEqual(latitude" in plan.split("PushedFilters: [")[1].split("]")[0]


def test_a_second_json_value_in_a_body_is_rejected(spark):
    from metroflux.operators import messages as M
    good = _messages(spark, [dict(value=1.0)], "2026-05-20 12:30:00").first().body
    bodies = {good: True, good + "  ": True, good + good: False, good + " " + good: False, good + ' [1] ' + good: False, good + ' "x" ' + good: False,
              good[:-1] + ',"note":{"a":{"b":"}{"}}}': True, good[:-1] + ',"note":[{"a":1},{"b":"\\\\"}]}': True, good[:-1] + ',"note":"} {"}': True}
    df = spark.createDataFrame([(b, {}, None) for b in bodies], J.MESSAGE_FILE_SCHEMA)
    assert {r.body: r.decode_error is None for r in M.decode(df).collect()} == bodies


def test_archive_write_empty_and_one_row(spark):
    root = tempfile.mkdtemp(prefix="mf-arch-") + "/a"
    assert AR.write_archive(reading(spark).limit(0), root) is False and not os.path.exists(root)
    assert AR.write_archive(reading(spark), root) is True
    files = AR.archive_files(spark, root).collect()
    assert len(files) == 1 and files[0].rows == 1
    assert files[0].object_name.startswith("p_source=simulator/p_metric=PM2.5/year=2026/month=05/day=20/")
    assert len(AR.read_archive(spark, root).columns) == 11


NAMES = {"Assault": "assault", "Robbery": "robbery", "NormalVideos": "normal"}


def _sampled(listing, limit, caps):
    """Files in (turn, class) order; the first that does not fit ends its class."""
    by_class = {}
    for path, size in sorted(listing):
        name = NAMES.get(path.split("/")[1])
        if name and not path.endswith("txt"):
            by_class.setdefault(name, []).append((path, size))
    queue = sorted((turn, name, path, size) for name, files in by_class.items() for turn, (path, size) in enumerate(files[:caps[name]]))
    out, total, ended = [], 0, set()
    for _, name, path, size in queue:
        if name not in ended and total + size <= limit:
            total += size
            out.append((path, total))
        else:
            ended.add(name)
    return sorted(out)


def test_capped_sample_matches_brute_force(spark, monkeypatch):
    rnd = random.Random(7)
    listing = [(f"ds/{rnd.choice([*NAMES, 'Other'])}/f{i:03d}.{rnd.choice(['png', 'jpg', 'txt'])}", rnd.randint(1, 50))
               for i in range(300)]
    df = spark.createDataFrame(listing, "path string, size long")
    for limit, mn, ma, block in [(400, 6, 3, 1024), (10_000, 50, 20, 4), (90, 10, 10, 1024), (800, 500, 500, 7), (3, 5, 5, 1)]:
        monkeypatch.setattr(SM, "TURN_BLOCK", block)
        got = sorted((r.path, r.total_bytes) for r in SM.capped_sample(df, list(NAMES), limit, mn, ma).collect())
        assert got == _sampled(listing, limit, {"normal": mn, "assault": ma, "robbery": ma})


def test_alert_states_have_all_states(spark, sf001):
    import __spark_entry__ as E
    states = {r.state for r in E.queries()["alert_states"](spark, sf001).select("state").distinct().collect()}
    assert {"normal", "pending", "firing"} <= states


def test_csv_export_and_listing(spark):
    from metroflux.sources import files as FL
    base = tempfile.mkdtemp(prefix="mf-csv-")
    assert FL.export_csv(reading(spark).limit(0), base + "/empty") is False
    assert not os.path.exists(base + "/empty")
    assert FL.export_csv(reading(spark), base + "/one") is True
    back = spark.read.option("header", True).csv(base + "/one").collect()
    assert len(back) == 1 and back[0].sensor_id == "SIM-CHI-AQ-001"
    with open(base + "/listing.csv", "w") as fh:
        fh.write("name,size\nds/Assault/a.png,10\nds/Robbery/b.png,x\nds/Normal/c.png,\n")
    rows = {r.path: r.size for r in FL.read_listing_csv(spark, base + "/listing.csv").collect()}
    assert rows == {"ds/Assault/a.png": 10, "ds/Robbery/b.png": 0, "ds/Normal/c.png": 0}


def test_bounded_runs_lose_nothing(spark):
    """Ten messages and a bad one, runs of 4, 4 and 100; nothing new between them."""
    import pytest
    base = tempfile.mkdtemp(prefix="mf-bounded-")
    land = os.path.join(base, "landing")
    t0 = dt.datetime(2026, 5, 20, 12, 0)
    _land(spark, [dict(time=t0 + dt.timedelta(minutes=i), ingested_at=t0 + dt.timedelta(minutes=i)) for i in range(5)], land)
    _land(spark, [dict(time=t0 + dt.timedelta(minutes=i), ingested_at=t0 + dt.timedelta(minutes=i)) for i in range(5, 10)] + [dict(sensor_id=" ")], land)
    args = (spark, land, base + "/hot", base + "/dead", base + "/metrics")
    got = [J.bounded_consume(*args, n, base + "/ckpt") for n in (4, 4, 100, 100)]
    assert got == [4, 4, 2, 0]
    assert sorted(r.time.minute for r in J.hot_table(spark, base + "/hot").collect()) == list(range(10))
    assert J.dead_letters(spark, base + "/dead").count() == 1
    _land(spark, [dict(time=t0 + dt.timedelta(minutes=30))] * 3, land)                  # equal messages count one by one
    assert [J.bounded_consume(*args, 2, base + "/ckpt") for _ in range(2)] == [2, 1]
    for bad in (0, -1):
        with pytest.raises(ValueError, match="limit"):
            J.bounded_consume(*args, bad, base + "/ckpt")


def test_a_bounded_run_that_died_is_done_again(spark, monkeypatch):
    import pytest
    base = tempfile.mkdtemp(prefix="mf-died-")
    land = os.path.join(base, "landing")
    t0 = dt.datetime(2026, 5, 20, 12, 0)
    _land(spark, [dict(time=t0 + dt.timedelta(minutes=i)) for i in range(6)], land)
    args = (spark, land, base + "/hot", base + "/dead", base + "/metrics")
    assert J.bounded_consume(*args, 2, base + "/ckpt") == 2
    with monkeypatch.context() as m:
        m.setattr(J.M, "dead_letter", lambda checked: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            J.bounded_consume(*args, 3, base + "/ckpt")
    assert [J.bounded_consume(*args, 3, base + "/ckpt") for _ in range(2)] == [3, 1]
    assert J.hot_table(spark, base + "/hot").count() == 6


def test_archive_expiry_deletes_old_partitions(spark):
    root = tempfile.mkdtemp(prefix="mf-expire-") + "/a"
    old = reading(spark, time=dt.datetime(2025, 1, 1, 12, 0))
    new = reading(spark, time=dt.datetime(2026, 5, 20, 12, 0))
    AR.write_archive(old.unionByName(new), root)
    files = AR.archive_files(spark, root)
    expired = AR.expired_partitions(files, "2026-05-21 00:00:00", days=365).collect()
    assert [r.date for r in expired] == [dt.date(2025, 1, 1)]
    assert AR.delete_partitions(spark, root, [r.partition for r in expired]) == 1
    assert [r.time.year for r in AR.read_archive(spark, root).collect()] == [2026]


def test_model_hook_scores_batches(spark):
    import pandas as pd
    from metroflux.operators import safety as SF

    def predict(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"uri": pdf["uri"], "label": "robbery", "confidence": 0.9})
    events = spark.createDataFrame([("gs://b/a.png",), ("gs://b/b.png",)], "uri string")
    out = SF.score_with(events, predict, "uri string, label string, confidence double").collect()
    assert sorted(r.uri for r in out) == ["gs://b/a.png", "gs://b/b.png"] and all(r.label == "robbery" for r in out)


def test_alert_state_machine_pending_then_firing(spark):
    from metroflux.operators import alerts as AL
    t0 = dt.datetime(2026, 5, 20, 0, 0)
    readings = reading(spark, time=t0, ingested_at=t0 + dt.timedelta(seconds=30))
    metrics = spark.createDataFrame([], "recorded_at timestamp, dropped_readings_total bigint")
    states = {(r.rule, r.eval_time): r.state for r in
              AL.alert_states(readings, metrics, "2026-05-20 01:00:00", span_hours=1).collect()}
    e1 = "no_recent_ingestion"
    at = lambda m: states[(e1, t0 + dt.timedelta(minutes=m))]
    assert at(10) == "normal"                  # last ingestion 9.5 min ago
    assert at(21) == "pending"                 # 20.5 min > 20: breach starts
    assert at(25) == "pending" and at(26) == "firing"   # held for 5 minutes
    assert states[("quality_exceptions", t0 + dt.timedelta(minutes=30))] == "normal"


def test_archive_age_expiry_job_and_manifest(spark):
    import time

    import pytest
    root = tempfile.mkdtemp(prefix="mf-age-") + "/a"
    AR.write_archive(reading(spark, time=dt.datetime(2025, 1, 1, 12, 0)).unionByName(reading(spark, time=dt.datetime(2026, 5, 20, 12, 0))), root)
    files = AR.archive_files(spark, root)
    newest = max(os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet"))
    later = dt.datetime.fromtimestamp(newest, dt.timezone.utc).replace(tzinfo=None) + dt.timedelta(hours=5)
    assert abs(AR.archive_age(files, later).first().age_hours - 5) < 0.01 and time.time() >= newest
    totals = AR.archive_totals(AR.archive_summary(files)).first()
    assert (totals.partitions, totals.files, totals.rows) == (2, 2, 2) and totals.latest_object
    outside = files.withColumn("object_name", F.lit("../elsewhere.parquet"))
    with pytest.raises(Exception, match="outside the archive"):
        AR.archive_manifest(outside).collect()
    assert AR.expire_archive(spark, root, "2026-05-21 00:00:00", 365) == 1
    assert [r.time.year for r in AR.read_archive(spark, root).collect()] == [2026]


def test_reports_prune_days_and_unused_fallbacks(spark):
    from metroflux.operators import reports as RP
    path = tempfile.mkdtemp(prefix="mf-days-") + "/t"
    t0 = dt.datetime(2026, 5, 1, 12, 0)
    rows = None
    for d in range(20):
        r = reading(spark, time=t0 + dt.timedelta(days=d), ingested_at=t0 + dt.timedelta(days=d)).withColumn("p_date", F.to_date("time"))
        rows = r if rows is None else rows.unionByName(r)
    B.write_batch(rows, path, 0, by_day=True)
    hot = B.read_batches(spark, path, reading(spark).schema, by_day=True)
    summary = RP.source_summary(hot, "2026-05-20 13:00:00", 48)
    plan = summary._jdf.queryExecution().executedPlan().toString()
    assert "p_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert summary.first().readings == 2
    metrics = spark.createDataFrame([(dt.datetime(2026, 5, 20, 12, 30), 1.0, 3, 5, 6, 7)],
                                    "recorded_at timestamp, readings_per_second double, channel_fill_pct int, pubsub_lag_ms int, gcs_write_latency_ms int, dropped_readings_total long")
    for m, rate, dropped in ((metrics, 1.0, 7), (metrics.limit(0), 2 / 86400, 0)):
        row = RP.overview(hot, m, "2026-05-20 13:00:00", 48).first()
        assert abs(row.avg_readings_per_second - rate) < 1e-9 and row.dropped_readings_total == dropped
        last = RP.latest_ingestion(m, hot, "2026-05-20 13:00:00", 48).collect()
        assert len(last) == 1 and abs(last[0].readings_per_second - rate) < 1e-9
        assert RP.ingestion_trend(m, hot, "2026-05-20 13:00:00", 48).count() == (1 if dropped else 2)


def test_export_batches_and_radius_limits(spark):
    import pytest

    from metroflux.operators import latest as LT
    rows = reading(spark)
    for i in range(1, 5):
        rows = rows.unionByName(reading(spark, sensor_id=f"S{i}"))
    seen, after = [], None
    while batch := AR.export_candidates(rows, "2026-06-20 00:00:00", limit=2, after=after).collect():
        seen += [r.sensor_id for r in batch]
        after = tuple(batch[-1][c] for c in ("time", "source", "metric", "sensor_id"))
    assert seen == sorted(seen) and len(seen) == 5
    for bad in (0, 25_001):
        with pytest.raises(ValueError, match="radius"):
            LT.within_radius(rows, 41.9, -87.6, bad)


def test_bucketed_archive_stays_in_its_buckets(spark):
    from metroflux.operators import tables as TB
    path, t0 = tempfile.mkdtemp(prefix="mf-bucket-") + "/t", dt.datetime(2026, 5, 1)
    rows = None
    for i in range(12):
        r = reading(spark, sensor_id=f"S{i % 6}", time=t0 + dt.timedelta(hours=i % 6), ingested_at=t0 + dt.timedelta(days=1 + i // 6), value=float(i))
        rows = r if rows is None else rows.unionByName(r)
    AR.bucketed_archive(spark, "archive_test", path)
    AR.append_bucketed(rows.filter("value < 6"), "archive_test")
    AR.append_bucketed(rows.filter("value >= 6"), "archive_test")
    held = spark.table("archive_test")
    once = TB.archive_dedup(held)
    assert sorted((r.sensor_id, r.value) for r in once.collect()) == [(f"S{i}", i + 6.0) for i in range(6)]
    assert "Exchange" not in once._jdf.queryExecution().executedPlan().toString()
    more = spark.createDataFrame(rows.unionByName(reading(spark, sensor_id="S9")).collect(), rows.schema)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        due = AR.archive_export(more, held, "2026-06-01 00:00:00", mode="all")
        plan = due._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and [r.sensor_id for r in due.collect()] == ["S9"]     # the readings' side
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_day_states_equal_the_reports(spark):
    from metroflux.operators import daily as DY
    from metroflux.operators import reports as RP
    base, t0 = tempfile.mkdtemp(prefix="mf-states-"), dt.datetime(2026, 5, 1, 0, 30)
    rows = spark.range(3000).select(
        (F.lit(t0).cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("id").cast("int") * 7)).alias("time"),
        F.when(F.col("id") % 97 == 0, F.lit(None)).otherwise(F.concat(F.lit("S"), F.col("id") * 131 % 211)).alias("sensor_id"),
        F.concat(F.lit("m"), F.col("id") % 3).alias("metric"), F.col("id").cast("double").alias("value"), F.lit("u").alias("unit"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("src"), F.col("id") % 2)).alias("source"), F.lit(1.0).alias("latitude"), F.lit(1.0).alias("longitude"),
        (F.col("id") % 2).cast("smallint").alias("quality_flag"), F.lit(t0).cast("timestamp").alias("ingested_at"), F.lit(1).alias("schema_version"))
    first = rows.filter("value < 1500")
    DY.write_days(spark, first, DY.number_sensors(spark, first, base + "/n"), base + "/d")
    numbers = DY.number_sensors(spark, rows, base + "/n")        # some more sensors, days added to
    touched = [r[0] for r in rows.filter("value >= 1500").select(F.to_date("time")).distinct().collect()]
    DY.write_days(spark, rows, numbers, base + "/d", touched)
    assert sorted(r.number for r in numbers.collect()) == list(range(1, rows.filter("sensor_id is not null").select("sensor_id").distinct().count() + 1))
    for hours in (24 * 6, 24 * 3 + 5.5, 24 * 300):
        states = DY.window_states(spark.read.parquet(base + "/d"), rows, numbers, "2026-05-15 00:00:00", hours)
        at = ("2026-05-15 00:00:00", hours)
        for got, want in ((DY.source_summary(states), RP.source_summary(rows, *at)), (DY.source_metric_counts(states), RP.source_metric_counts(rows, *at)),
                          (DY.metric_coverage(states), RP.metric_coverage(rows, *at))):
            assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect())) != []
    whole = DY.window_states(spark.read.parquet(base + "/d"), rows, numbers, "2026-05-15 00:00:00", 48)
    assert "Range" not in whole._jdf.queryExecution().executedPlan().toString()      # no reading is read
    empty = DY.window_totals(DY.window_states(spark.read.parquet(base + "/d"), rows, numbers, "2027-05-15 00:00:00", 48)).first()
    assert tuple(empty) == (0, 0, 0, 0, 0.0)


def test_a_failing_source_stops_no_other_and_goes_on_later(spark):
    base = tempfile.mkdtemp(prefix="mf-apart-")
    schema = "sensor string, value double"

    def write(name, file, *lines):
        os.makedirs(f"{base}/in/{name}", exist_ok=True)
        with open(f"{base}/in/{name}/{file}.json", "w") as f:
            f.write("\n".join(lines))

    def normalise(batch):
        r = reading(spark).drop("sensor_id", "value")
        return batch.crossJoin(r).withColumnsRenamed({"sensor": "sensor_id"}).withColumn("skip_reason", F.when(F.col("value") < 0, "negative"))

    def source(name):
        return J.Source(lambda: spark.readStream.schema(schema).option("mode", "FAILFAST").option("maxFilesPerTrigger", 1).json(f"{base}/in/{name}"), normalise, F.lit(1))

    write("a", "1", '{"sensor": "A", "value": 1}', '{"sensor": "B", "value": -1}')
    write("b", "1", '{"sensor": "C", "value": 1}')
    write("b", "2", "{broken")
    sources = {"a": source("a"), "b": source("b"), "c": source("c")}        # c has no folder
    failed = {r.source: r.error for r in J.poll_sources(spark, sources, base + "/out").collect()}
    assert set(failed) == {"b", "c"}
    seen = J.polled_readings(spark, base + "/out", sources, reading(spark).schema)
    assert {r.sensor_id for r in seen.collect()} == {"A", "C"}             # b's first file was stored
    write("b", "2", '{"sensor": "D", "value": 1}')
    write("c", "1", '{"sensor": "E", "value": 1}')
    assert J.poll_sources(spark, sources, base + "/out").count() == 0
    seen = J.polled_readings(spark, base + "/out", sources, reading(spark).schema)
    assert sorted(r.sensor_id for r in seen.collect()) == ["A", "C", "D", "E"]
    counts = J.poll_counts(spark, base + "/out", sources).filter("source = 'a'").collect()
    assert [(r.received, r.published, r.skipped) for r in counts] == [(2, 1, 1)]


def test_alerts_fire_when_nothing_arrives(spark):
    import time

    from metroflux.streaming import alerting as AT
    t0 = dt.datetime(2026, 5, 1, 12, 0)
    rows = reading(spark, ingested_at=t0)
    none = spark.createDataFrame([], "recorded_at timestamp, dropped_readings_total long")
    base = tempfile.mkdtemp(prefix="mf-alerts-")
    step = AT.alert_tick(spark, base + "/s", lambda: rows, lambda: none)
    for i, minute in enumerate((1, 20, 21, 24, 26, 26)):
        step(min(i, 4), t0 + dt.timedelta(minutes=minute))       # the last tick runs again
    states = [r.state for r in AT.alert_history(spark, base + "/s").filter("rule = 'no_recent_ingestion'").orderBy("eval_time").collect()]
    assert states == ["normal", "normal", "pending", "pending", "firing"]
    ticks = iter(range(100))
    query = AT.run_alerts(spark, AT.alert_tick(spark, base + "/c", lambda: rows, lambda: none), base + "/ck", "1 second",
                          lambda: t0 + dt.timedelta(minutes=21 + 6 * next(ticks)))
    for _ in range(60):
        time.sleep(1)
        if len(B.batch_ids(spark, base + "/c")) >= 2:
            break
    query.stop()
    states = [r.state for r in AT.alert_history(spark, base + "/c").filter("rule = 'no_recent_ingestion'").orderBy("eval_time").limit(2).collect()]
    assert states == ["pending", "firing"]
