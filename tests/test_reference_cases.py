"""Reference input -> expected cases (FIXTURES.md part 2) on literal rows."""

import datetime as dt

from pyspark.sql import functions as F

from metroflux.functions.keys import dedup_key, partition_path
from metroflux.operators import messages as M
from metroflux.operators import normalize as N
from metroflux.operators import safety as SF
from metroflux.operators import validate as V
from metroflux.sources import payloads as P

T0 = dt.datetime(2026, 5, 20, 12, 0, 0)
BASE = dict(time=T0, sensor_id="SIM-CHI-AQ-001", metric="PM2.5", value=12.5, unit="ug/m3", source="simulator",
            latitude=41.88, longitude=-87.62, quality_flag=1, ingested_at=T0, schema_version=1)
SCHEMA = ("time timestamp, sensor_id string, metric string, value double, unit string, source string, "
          "latitude double, longitude double, quality_flag smallint, ingested_at timestamp, schema_version int")


def reading(spark, **over):
    row = dict(BASE, **over)
    return spark.createDataFrame([tuple(row[k] for k in BASE)], SCHEMA)


def errors(spark, reference=None, **over):
    df = V.validate_readings(reading(spark, **over), reference)
    return df.select("errors").first()[0]


def test_validate_cases(spark):
    assert errors(spark) == []
    e = errors(spark, sensor_id=" ", unit="")
    assert "sensor_id is required" in e and "unit is required" in e
    ref = F.lit("2026-05-20 12:10:00").cast("timestamp")
    assert "time must be within 5m0s of reference time" in errors(spark, reference=ref)
    assert errors(spark, value=2000.0) == ["PM2.5 value must be between 0.00 and 1000.00"]
    for metric, unit, value in [("O3", "ppm", 0.04), ("NO2", "ppb", 20.0), ("temperature", "C", 21.0),
                                ("humidity", "%", 50.0), ("bike_available_count", "count", 4.0),
                                ("water_gage_height", "ft", 2.5)]:
        assert errors(spark, metric=metric, unit=unit, value=value) == []
    assert errors(spark, latitude=100.0) == ["latitude must be between -90 and 90"]
    # NaN value: only "must be finite" (no range error), NaN latitude passes
    assert errors(spark, value=float("nan")) == ["value must be finite"]
    assert errors(spark, latitude=float("nan")) == []


def test_dedup_key_and_partition_path(spark):
    df = reading(spark, time=dt.datetime(2026, 5, 20, 12, 0, 0))
    assert df.select(dedup_key()).first()[0] == "SIM-CHI-AQ-001|2026-05-20T12:00:00Z|PM2.5"
    df = reading(spark, time=dt.datetime(2026, 5, 20, 12, 0, 10, 120300))
    assert df.select(dedup_key()).first()[0] == "SIM-CHI-AQ-001|2026-05-20T12:00:10.1203Z|PM2.5"
    df = reading(spark, time=dt.datetime(2026, 5, 21, 3, 0), source="simulator")
    assert df.select(partition_path()).first()[0] == "source=simulator/metric=PM2.5/year=2026/month=05/day=21"
    df = reading(spark, source="a b/c", metric="")
    assert df.select(partition_path()).first()[0].startswith("source=a_b_c/metric=unknown/")


def _aq(spark, name, units, param_units="", m_coords=(41.9, -87.6), s_coords=(41.8, -87.5), sid=200, value=12.0):
    latest = spark.createDataFrame(
        [(1, 1, [((("2026-05-21T10:00:00Z", "x"), value, m_coords if m_coords else None, sid, 1))])],
        P.AQ_LATEST)
    sensors = spark.createDataFrame(
        [(1, 1, 1, [(sid, "s", (2, name, param_units), units, s_coords if s_coords else None)])], P.AQ_SENSORS)
    return N.normalize_air_quality(latest, sensors, "2026-05-21 10:01:00")


def test_air_quality_cases(spark):
    r = N.published(_aq(spark, "pm25", "µg/m³")).first()
    assert (r.sensor_id, r.metric, r.unit) == ("OPENAQ-200", "PM2.5", "ug/m3")
    assert N.published(_aq(spark, "co", "ppm")).count() == 0
    assert N.published(_aq(spark, "no2", "µg/m³")).count() == 0
    assert "unsupported OpenAQ unit" in N.skipped(_aq(spark, "no2", "µg/m³")).first().skip_reason
    r = N.published(_aq(spark, "o3", "ppm", m_coords=None, s_coords=(41.7, -87.7), value=0.04)).first()
    assert (r.latitude, r.longitude) == (41.7, -87.7)
    out = _aq(spark, "pm25", None, param_units="µg/m³")
    assert N.published(out).count() == 1 and N.skipped(out).count() == 0


def _weather(spark, time_text, temp_unit="°C"):
    df = spark.createDataFrame([(41.88, -87.63, 41.9, -87.6, ("iso8601", temp_unit, "%", "km/h", "mm"),
                                 (time_text, 21.5, 40.0, 10.0, 0.0))], P.WEATHER)
    return N.normalize_weather(df, "2026-05-21 15:31:00")


def test_weather_cases(spark):
    out = N.published(_weather(spark, "2026-05-21T15:30"))
    assert sorted(r.unit for r in out.collect()) == sorted(["C", "%", "km/h", "mm"])
    assert out.first().time == dt.datetime(2026, 5, 21, 15, 30)
    out = _weather(spark, "2026-05-21T15:30", temp_unit="K")
    assert N.published(out).count() == 3 and N.skipped(out).count() == 1
    bad = _weather(spark, "")
    assert N.published(bad).count() == 0 and N.skipped(bad).count() == 1


def _bike(spark, infos, statuses, limit=0):
    return _bike_polls(spark, [(1, infos, statuses)], limit)


def _bike_polls(spark, polls, limit=0):
    info = spark.createDataFrame([(n, 1, 0, ([(s, "n", 41.0, -87.0, c) for s, c in infos],)) for n, infos, _ in polls], P.GBFS_INFO)
    status = spark.createDataFrame([(n, 0, ([(s, b, d, 1716300000 + (n or 0)) for s, b, d in statuses],)) for n, _, statuses in polls], P.GBFS_STATUS)
    return N.normalize_bike_share(info, status, "2026-05-21 15:00:00", limit)


def test_bike_share_limit_and_metadata_are_per_poll(spark):
    stations = [("b", 1, 2), ("a", 7, 13), ("c", 3, 4)]
    polls = [(n, [("a", 20 + n), ("b", 10 + n), ("c", 5)], stations) for n in (1, 2, 3)]
    rows = N.published(_bike_polls(spark, polls, limit=2)).collect()
    assert len(rows) == 3 * 2 * 3 and {r.sensor_id for r in rows} == {"GBFS-a", "GBFS-b"}
    capacity = {(r.time.second, r.sensor_id): r.value for r in rows if r.metric == "station_capacity"}
    assert len(set(capacity.values())) == 6                                   # each poll keeps its own capacities
    missing = N.published(_bike_polls(spark, [(1, [("a", None)], [("a", None, 4)])])).collect()
    assert sorted(r.value for r in missing) == [0.0, 0.0, 4.0]
    assert N.published(_bike_polls(spark, [(None, [("a", 3)], [("a", 1, 2)])])).count() == 3
    assert N.skipped(_bike_polls(spark, [(1, [("a", 3)], []), (2, [], [("a", 1, 2)])])).count() == 1


def test_bike_share_cases(spark):
    out = N.published(_bike(spark, [("a", 20)], [("a", 7, 13)]))
    assert sorted(r.value for r in out.collect()) == [7.0, 13.0, 20.0]
    out = _bike(spark, [], [("a", 7, 13)])
    assert N.published(out).count() == 0 and N.skipped(out).count() == 1
    out = N.published(_bike(spark, [("a", 20), ("b", 10)], [("b", 1, 2), ("a", 7, 13)], limit=1))
    assert {r.sensor_id for r in out.collect()} == {"GBFS-a"} and out.count() == 3


def _river(spark, code, unit, value):
    series = [((("site", [("05536123",)], ((41.88, -87.62),)), ([(code,)], "Gage height", (unit,)),
                [([(value, "2026-05-21T10:00:00.000-05:00")],)]))]
    return N.normalize_river(spark.createDataFrame([((series,),)], P.USGS), "2026-05-21 15:00:00")


def test_river_cases(spark):
    r = N.published(_river(spark, "00065", "ft", "2.71")).first()
    assert (r.metric, r.value, r.unit, r.sensor_id) == ("water_gage_height", 2.71, "ft", "USGS-05536123")
    for code, unit, value in [("00060", "ft3/s", "1.0"), ("00065", "ft", "Ice"), ("00065", "ft", "1e400")]:
        out = _river(spark, code, unit, value)
        assert N.published(out).count() == 0 and N.skipped(out).count() == 1


def test_message_cases(spark):
    enc = M.encode(reading(spark))
    row = enc.first()
    assert set(row.attributes) == {"schema_version", "source", "metric", "sensor_id", "dedup_key"}
    dec = M.decode_validate(enc).first()
    assert (dec.sensor_id, dec.value, dec.unit, dec.reason) == ("SIM-CHI-AQ-001", 12.5, "ug/m3", None)
    bad = spark.createDataFrame([("{",)], "body string")
    assert M.decode_validate(bad).first().reason.startswith("decode sensor reading")
    blank = M.encode(reading(spark, sensor_id=""))
    assert "sensor_id is required" in M.decode_validate(blank).first().reason
    late = M.encode(reading(spark, ingested_at=T0 + dt.timedelta(hours=2)))
    assert M.decode_validate(late).first().reason is None
    lag = spark.createDataFrame([(dt.datetime(2026, 5, 20, 11, 59, 58),)], "p timestamp").select(
        M.delivery_lag_ms("p", F.lit("2026-05-20 12:00:00").cast("timestamp"))).first()[0]
    assert lag == 2000


def test_media_cases(spark):
    df = spark.createDataFrame([("video_inbox/city=chicago/camera=cam-7/robbery.mp4",)], "p string")
    city, cam = SF.infer_city_camera(F.col("p"), "x", "y")
    assert tuple(df.select(city, cam).first()) == ("chicago", "cam-7")
    labels = spark.createDataFrame([("Robbery",), ("RoadAccidents",), ("theft",), ("NormalVideos",)], "raw_label string")
    got = {r.raw_label: r for r in SF.label_mapping(labels).collect()}
    assert got["Robbery"].display_label == "robbery_like_activity" and got["Robbery"].severity == "critical"
    assert got["RoadAccidents"].display_label == "road_accident_like_activity"
    assert got["theft"].display_label == "stealing_like_activity"
    assert not got["NormalVideos"].is_suspicious
    asof = F.lit("2026-05-21 12:00:00").cast("timestamp")
    listing = spark.createDataFrame([("gs://b/robbery-sample.mp4",), ("gs://b/normal-walk.mp4",),
                                     ("gs://b/Assault001_frame0042.png",), ("gs://b/notes.txt",)], "media_uri string")
    ev = SF.media_events(listing, asof)
    assert ev.count() == 3
    preds = SF.predictions(ev, SF.keyword_predict("uri"))
    flags = {r.video_uri: r.severity for r in SF.flags(preds).collect()}
    assert flags == {"gs://b/robbery-sample.mp4": "critical", "gs://b/Assault001_frame0042.png": "high"}
    md = spark.createDataFrame([("video_inbox/source_video=clip-01/frame000042.jpg",)], "p string")
    m = SF.path_metadata(F.col("p"))
    r = md.select(m["source_video_uri"], m["frame_index"]).first()
    assert tuple(r) == ("clip-01", 42)


def test_sampler_and_class_names(spark):
    from metroflux.operators import sampler as SM
    listing = spark.createDataFrame([("data/Assault/a1.png", 10), ("data/Assault/a2.png", 10),
                                     ("data/NormalVideos/n1.png", 10)], "path string, size long")
    out = SM.capped_sample(listing, ["Assault", "NormalVideos"], limit_bytes=25, max_normal=5, max_anomaly=5).collect()
    assert len(out) == 2 and sum(r.size for r in out) <= 25 and {r.class_name for r in out} == {"assault", "normal"}
    names = spark.createDataFrame([("NormalVideos",), ("Normal Videos",), ("normal",)], "c string")
    assert {r[0] for r in names.select(SM.normalize_class_name(F.col("c"))).collect()} == {"normal"}


def test_decode_checks_every_field_type(spark):
    from metroflux.operators import messages as M
    good = ('{"time":"2026-05-20T12:00:00Z","sensor_id":"S","metric":"PM2.5","value":1.5,"unit":"ug/m3","source":"openaq",'
            '"latitude":41.9,"longitude":-87.6,"quality_flag":1,"ingested_at":"2026-05-20T12:00:01Z","schema_version":1}')

    def change(old, new):
        assert old in good
        return good.replace(old, new)

    malformed = ["{", "", None, good[:-1], good + " x", good.replace('"S"', "S")]
    mismatch = [change('"S"', "5"), change('"S"', '{"a":1}'), change('"2026-05-20T12:00:01Z"', '"abc"'), change('"2026-05-20T12:00:01Z"', "123"),
                change('"2026-05-20T12:00:00Z"', '"yesterday"'), change("1.5", '"1.5"'), change("1.5", '"NaN"'), change("1.5", "1e400"), change("1.5", "true"),
                change('"quality_flag":1', '"quality_flag":1.5'), change('"quality_flag":1', '"quality_flag":99999'), change('"schema_version":1', '"schema_version":"1"'),
                "[1]", "5", '"text"']
    fine = [good, change('"sensor_id"', '"Sensor_ID"'), change(',"ingested_at":"2026-05-20T12:00:01Z"', ""), change('"unit":"ug/m3"', '"unit":"ug/m3","other":[1]'),
            change('"value":1.5', '"value":9,"value":1.5'), change('"value":1.5', '"VALUE":9,"value":1.5'), change('"quality_flag":1', '"quality_flag":null'), "  " + good + " "]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(malformed + mismatch + fine + ["null"])], "n int, body string")
    rows = M.decode(df).withColumn("ingested_at", F.col("ingested_at").cast("timestamp_ntz")).orderBy("n").collect()
    errors = [r.decode_error for r in rows]
    a, b = len(malformed), len(malformed) + len(mismatch)
    assert all(e and e.endswith("malformed JSON") for e in errors[:a]), errors[:a]
    assert all(e and e.endswith("type mismatch") for e in errors[a:b]), errors[a:b]
    assert errors[b:] == [None] * (len(fine) + 1)
    assert {(r.sensor_id, r.value) for r in rows[b:-1]} == {("S", 1.5)} and rows[b + 2].ingested_at.year == 1 and rows[b + 6].quality_flag == 0
    assert rows[-1].sensor_id == "" and rows[-1].time is None           # a JSON null sets nothing


def test_title_case_of_unknown_labels(spark):
    from metroflux.functions import labels as L
    names = ["some_new-metric", "pm2.5x", "NO3_level", "co2eq", "o'neil", "élan_vital", "a1b"]
    got = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, c string").orderBy("i").select(L.title_fallback(F.col("c"))).collect()
    assert [r[0] for r in got] == [n.replace("_", " ").title() for n in names]
