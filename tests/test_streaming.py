import random

import pytest
from pyspark.sql import functions as F

from test_quota_log_sources import walk

from tallyloom.operators import drift as D
from tallyloom.plans import training as T
from tallyloom.plans.preprocess import full_pipeline
from tallyloom.plans.estimators import build_estimator, training_facts
from tallyloom.sources import prediction_log
from tallyloom.sources.requests import request_json
from tallyloom.operators.quota import quota_flags
from tallyloom.spec import TELCO
from tallyloom.streaming.drift import psi_from_cells, windowed_cells
from tallyloom.streaming.quota import stream_quota_flags
from tallyloom.streaming.score_log import start_score_log
from tallyloom.streaming.tail_drift import start_tail_drift

S = 1_000_000


def run(stream, base, mode="append"):
    stream.writeStream.format("parquet").option("path", f"{base}/out").option(
        "checkpointLocation", f"{base}/cp"
    ).outputMode(mode).trigger(availableNow=True).start().awaitTermination()


def test_quota_state_crosses_micro_batches(spark, tmp_path):
    rng = random.Random(3)
    events, clock = [], 1_700_000_000 * S
    for i in range(400):
        clock += int(rng.choice([0, rng.expovariate(1 / 9)]) * S)
        events.append((rng.choice("ab"), clock, i))
    folder = tmp_path / "in"
    schema = "k string, us long, id long"
    for part in range(4):
        rows = events[part * 100 : (part + 1) * 100]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder))
    stream = (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))
    )
    run(stream_quota_flags(stream, "k", "us", "id", 3, 60), tmp_path)
    got = {
        r["event_id"]: (r["window_start_us"], r["n_in_window"], r["allowed"])
        for r in spark.read.parquet(f"{tmp_path}/out").collect()
    }
    assert got == walk(events, 3, 60)


def test_windowed_drift_equals_batch(spark, tmp_path):
    rows = spark.range(3000).select(
        F.timestamp_micros(F.col("id") * 60 * S).alias("t"),
        F.pmod(F.xxhash64("id"), F.lit(50)).cast("double").alias("x"),
        F.concat(F.lit("c"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(3))).alias("c"),
    )
    folder = str(tmp_path / "in")
    rows.coalesce(2).write.parquet(folder)
    table = spark.read.parquet(folder)
    ref = D.fit_reference(table.filter("x < 40 and c <> 'c2'"), ["x"], ["c"]).persist()
    stream = spark.readStream.schema(table.schema).parquet(folder)
    cells = windowed_cells(stream, "t", "6 hours", "0 seconds", D.reference_edges(ref), ["c"])
    run(cells, tmp_path)
    got = {
        (r["window_start"], r["feature"]): (r["psi"], r["status"])
        for r in psi_from_cells(spark.read.parquet(f"{tmp_path}/out"), ref).collect()
    }
    batch = D.drift_report(ref, table.withColumn("w", F.window("t", "6 hours")["start"]), ["w"])
    want = {(r["w"], r["feature"]): (r["psi"], r["status"]) for r in batch.collect()}
    # The last window stays open until the watermark passes its end.
    last = max(w for w, _ in want)
    assert got == {k: v for k, v in want.items() if k[0] != last}
    assert len(got) > 10


def test_late_rows_are_dropped(spark, tmp_path):
    folder = str(tmp_path / "in")
    schema = "t timestamp, x double, c string"
    for hour, x in ((2, 1.0), (50, 2.0), (51, 2.0), (1, 3.0), (100, 4.0)):
        df = spark.range(1).select(
            F.timestamp_micros(F.lit(hour * 3600 * S)).alias("t"),
            F.lit(x).alias("x"),
            F.lit("a").alias("c"),
        )
        df.coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    cells = windowed_cells(stream, "t", "6 hours", "0 seconds", {"x": [0.0, 10.0]}, ["c"])
    run(cells, tmp_path)
    out = spark.read.parquet(f"{tmp_path}/out").filter("feature = 'x'")
    # Hour 1 comes when its window (that of hour 2) has been closed and appended.
    assert sorted(r["n"] for r in out.collect()) == [1, 2]


def test_scores_requests_into_the_log(spark, accounts, tmp_path):
    train = accounts(
        *[{"tenure": str(i % 70), "Churn": "Yes" if i % 70 < 20 else "No"} for i in range(140)]
    ).withColumn("label", (F.col("Churn") == "Yes").cast("int"))
    facts = training_facts(train)
    model = full_pipeline("TELCO", build_estimator("logreg", {"max_iter": 5}, facts)).fit(
        train.withColumn("weight", F.lit(1.0))
    )
    final = T.FinalModel(model, "logreg", {}, 0.5)
    item = request_json("customerID", [F.col(c) for c in TELCO.features])
    texts = [r[0] for r in accounts({}, {"tenure": "-1"}, {"gender": "Other"}).select(item).collect()]
    extra = texts[0].replace('"gender"', '"ssn":"1","gender"')
    folder = tmp_path / "requests"
    folder.mkdir()
    (folder / "a.json").write_text('{"items":[%s]}\n' % ",".join([*texts, extra]))
    (folder / "b.json").write_text('{"items":[%s]}\nbroken\n' % texts[0])
    for _ in range(2):  # the second run finds nothing new
        start_score_log(
            spark, str(folder), final, "TELCO", "1.0.0", f"{tmp_path}/log", f"{tmp_path}/cp"
        ).awaitTermination()
    schema = prediction_log.log_schema(prediction_log.feature_struct(TELCO))
    rows = prediction_log.read_log(spark, f"{tmp_path}/log", schema).collect()
    assert len(rows) == 2
    assert len({r["request_id"] for r in rows}) == 2
    assert all(r["inference_ms"] > 0 for r in rows)
    refused = spark.read.parquet(f"{tmp_path}/log-refused").collect()
    assert sorted(r["index"] for r in refused if r["body"] is None) == [1, 2, 3]
    assert [r["body"] for r in refused if r["index"] is None] == ["broken"]
    # items of one body share its id, in the log and among the refused
    assert len({r["request_id"] for r in refused} | {r["request_id"] for r in rows}) == 3
    assert {r["customer_id_hash"] for r in rows} == {rows[0]["customer_id_hash"]}
    assert "TEST-0000" not in str(rows)
    assert all(0 <= r["churn_probability"] <= 1 for r in rows)


def test_a_repeated_batch_writes_its_requests_once(spark, accounts, tmp_path, monkeypatch):
    from tallyloom.streaming import score_log

    rows = accounts(*[{"Churn": "Yes" if i % 2 else "No"} for i in range(20)])
    train = rows.withColumn("label", (F.col("Churn") == "Yes").cast("int"))
    facts = training_facts(train)
    model = full_pipeline("TELCO", build_estimator("logreg", {"max_iter": 2}, facts)).fit(
        train.withColumn("weight", F.lit(1.0))
    )
    final = T.FinalModel(model, "logreg", {}, 0.5)
    item = request_json("customerID", [F.col(c) for c in TELCO.features])
    good, bad = [r[0] for r in accounts({}, {"tenure": "-1"}).select(item).collect()]
    folder = tmp_path / "requests"
    folder.mkdir()
    (folder / "a.json").write_text('{"items":[%s,%s]}\n' % (good, bad))
    schema = prediction_log.log_schema(prediction_log.feature_struct(TELCO))

    def go():
        start_score_log(
            spark, str(folder), final, "TELCO", "1", f"{tmp_path}/log", f"{tmp_path}/cp"
        ).awaitTermination()

    def ids():
        log = prediction_log.read_log_or_empty(spark, f"{tmp_path}/log", schema)
        return [r["request_id"] for r in log.collect()]

    def lost(*_):
        raise RuntimeError("lost")

    # the log is written, then the batch fails before the refused rows are
    with monkeypatch.context() as m:
        refused = score_log._refused_rows
        m.setattr(score_log, "_refused_rows", lambda *a: refused(*a).withColumn("x", F.raise_error(F.lit("lost"))))
        with pytest.raises(Exception):
            go()
    first = ids()
    assert len(first) == 1
    # nothing is scored again
    monkeypatch.setattr(score_log, "Observation", lost)
    go()
    table = spark.read.parquet(f"{tmp_path}/log-refused").collect()
    assert ids() == first and [r["request_id"] for r in table] == first
    assert [r["index"] for r in table] == [1]


@pytest.mark.parametrize("limit", [1])
def test_single_key_burst(spark, tmp_path, limit):
    schema = "k string, us long, id long"
    folder = str(tmp_path / "in")
    spark.createDataFrame([("a", 7 * S, i) for i in range(50)], schema).coalesce(1).write.parquet(folder)
    stream = spark.readStream.schema(schema).parquet(folder)
    run(stream_quota_flags(stream, "k", "us", "id", limit, 60), tmp_path)
    rows = spark.read.parquet(f"{tmp_path}/out").collect()
    assert sorted(r["n_in_window"] for r in rows) == list(range(1, 51))
    assert sum(r["allowed"] for r in rows) == 1


def quota_in_parts(spark, base, parts, **options):
    """Flags of events that come one part a trigger, by event."""
    schema, folder = "k string, us long, id long", str(base / "in")
    for rows in parts:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    run(stream_quota_flags(stream, "k", "us", "id", 3, 60, **options), base)
    got = spark.read.parquet(f"{base}/out").collect()
    return {r["event_id"]: (r["window_start_us"], r["n_in_window"], r["allowed"]) for r in got}


def test_bounded_quota_equals_the_walk_while_buckets_hold(spark, tmp_path):
    rng = random.Random(8)
    events, clock = [], 1_700_000_000 * S
    for i in range(300):
        clock += int(rng.choice([0, rng.expovariate(1 / 9)]) * S)
        events.append((rng.choice("abcdefg"), clock, i))
    parts = [events[i : i + 100] for i in range(0, 300, 100)]
    assert quota_in_parts(spark, tmp_path, parts, max_keys=21, buckets=3) == walk(events, 3, 60)


def test_more_keys_than_the_bound_keep_the_newest_windows(spark, tmp_path):
    begin = 1_700_000_000 * S
    at = lambda name, second, i: (name, begin + second * S, i)
    first = [at(name, n, n) for n, name in enumerate("abcdef")]
    then = [at("a", 10, 10), at("f", 11, 11), at("e", 12, 12), at("d", 13, 13)]
    got = quota_in_parts(spark, tmp_path, [first, then], max_keys=4, buckets=1)
    # six keys are more than four: the windows of e and f, the newest, stay
    assert all(got[n] == (begin + n * S, 1, True) for n in range(6))
    assert got[10] == (begin + 10 * S, 1, True) and got[13] == (begin + 13 * S, 1, True)
    assert got[11] == (begin + 5 * S, 2, True) and got[12] == (begin + 4 * S, 2, True)
    with pytest.raises(ValueError, match="max_keys"):
        stream_quota_flags(spark.readStream.format("rate").load(), "value", "value", "value", max_keys=2)


def test_quota_keeps_events_without_key_or_time(spark, tmp_path):
    rows = [(None, S, 1), ("a", None, 2), (None, 2 * S, 3), (None, None, 4), ("a", S, 5)]
    folder, schema = str(tmp_path / "in"), "k string, us long, id long"
    events = spark.createDataFrame(rows, schema)
    events.coalesce(1).write.parquet(folder)
    stream = spark.readStream.schema(schema).parquet(folder)
    run(stream_quota_flags(stream, "k", "us", "id", 1, 60), tmp_path)
    got = spark.read.parquet(f"{tmp_path}/out")
    batch = quota_flags(events, "k", "us", "id", 1, 60)
    order = ["key", "event_id", "ts_us", "window_start_us", "n_in_window", "allowed"]
    assert sorted(map(str, got.select(*order).collect())) == sorted(map(str, batch.select(*order).collect()))
    assert got.count() == 5


def test_drift_of_a_stream_without_rows(spark, tmp_path):
    from tallyloom.streaming.drift import latest_cells, psi_with_open_windows

    cells = latest_cells(spark, str(tmp_path / "nothing"))
    reference = D.fit_reference(spark.range(20).select(F.col("id").cast("double").alias("x")), ["x"], [])
    assert psi_with_open_windows(cells, reference, None).count() == 0


def test_tail_drift_follows_the_log(spark, tmp_path):
    features = spark.range(1000).select(
        F.col("id"),
        F.timestamp_micros((F.col("id") * 600 + 1_700_000_000) * S).alias("t"),
        F.when(F.col("id") < 900, F.pmod(F.col("id") * 7, F.lit(100))).otherwise(5)
        .cast("double").alias("x"),
        F.lit(0.5).alias("p"),
        F.lit("Yes").alias("v"),
    )
    ref = D.fit_reference(features.filter("id < 800"), ["x"], []).persist()
    log = str(tmp_path / "log")
    schema = prediction_log.log_schema(features.select("x").schema)
    assert prediction_log.read_recent(spark, log, schema, 5).count() == 0

    def append_and_run(rows):
        records = prediction_log.log_records(
            rows, ["x"], "id", "p", "v", "1", F.lpad(F.col("id").cast("string"), 6, "0"), F.col("t")
        )
        prediction_log.append_log(records, log)
        start_tail_drift(
            spark, log, schema, ref, f"{tmp_path}/reports", f"{tmp_path}/cp", 100
        ).awaitTermination()

    append_and_run(features.filter("id < 40"))
    assert not (tmp_path / "reports").exists()  # fewer than 50 records
    append_and_run(features.filter("id >= 40 and id < 900"))
    append_and_run(features.filter("id >= 900"))
    rows = spark.read.parquet(f"{tmp_path}/reports").orderBy("batch").collect()
    assert [r["status"] for r in rows] == ["ok", "alert"]
    tail = prediction_log.read_recent(spark, log, schema, 100).collect()
    assert {r["request_id"] for r in tail} == {f"{i:06d}" for i in range(900, 1000)}


def test_tail_state_with_late_repeated_and_replayed_records(spark, tmp_path):
    rows = spark.range(300).select(
        F.col("id"),
        F.timestamp_micros((F.col("id") * 3600 + 1_700_000_000) * S).alias("t"),
        F.col("id").cast("double").alias("x"), F.lit(0.5).alias("p"), F.lit("Yes").alias("v"),
    )
    ref = D.fit_reference(rows.filter("id < 100"), ["x"], []).persist()
    log, checkpoint = str(tmp_path / "log"), f"{tmp_path}/cp"
    schema = prediction_log.log_schema(rows.select("x").schema)
    names = F.lpad(F.col("id").cast("string"), 6, "0")

    def follow():
        start_tail_drift(spark, log, schema, ref, f"{tmp_path}/reports", checkpoint, 60).awaitTermination()

    # in order, late, repeated, some late among the latest, a torn line alone
    for part in ("id < 100", "id >= 150 and id < 200", "id >= 140 and id < 160", "id % 2 = 1 and id >= 190", "id >= 250 and id % 2 = 0"):
        records = prediction_log.log_records(rows.filter(part), ["x"], "id", "p", "v", "1", names, F.col("t"))
        prediction_log.append_log(records, log)
        follow()
    (tmp_path / "log" / "day=2030-01-01").mkdir()
    (tmp_path / "log" / "day=2030-01-01" / "part-0.json").write_text('{"ts": "2030-01\n\n')
    follow()
    tail = lambda: sorted(
        tuple(r) for r in spark.read.schema(schema).parquet(f"{checkpoint}-tail/1").select("ts", "request_id").collect())
    want = sorted(tuple(r) for r in prediction_log.read_recent(spark, log, schema, 60).select("ts", "request_id").collect())
    assert len(want) == 60 and tail() == want
    # the last batch again, as after a stop before its commit
    (tmp_path / "cp" / "commits" / "5").unlink()
    for crc in (tmp_path / "cp" / "commits").glob(".5.crc"):
        crc.unlink()
    follow()
    assert tail() == want
    (tmp_path / "log" / "stray.json").write_text("{}\n")
    with pytest.raises(ValueError, match="stray.json"):
        prediction_log.read_recent(spark, log, schema, 5)


def test_stream_drift_has_all_features_and_the_open_window(spark):
    from tallyloom.plans import datasets as X
    from tallyloom.plans import queries as Q

    folder = "/root/testdata/sf0.001"
    got = Q.stream_drift(spark, folder).collect()
    feats = X.event_features(spark, folder)
    batch = D.drift_report(Q._reference(spark, folder), feats, ["day"]).collect()
    assert {r["feature"] for r in got} == {*X.EVENT_NUMERIC, *X.EVENT_CATEGORICAL}
    assert {(r["day"], r["feature"]): (r["psi"], r["status"]) for r in got} == {
        (r["day"], r["feature"]): (r["psi"], r["status"]) for r in batch
    }
    newest = feats.agg(F.max("ts").alias("t")).first()["t"]
    closed = feats.select("day", (F.to_timestamp("day") + F.expr("interval 1 day") <= F.lit(newest) - F.expr("interval 1 hour")).alias("c"))
    want = {r["day"]: not r["c"] for r in closed.distinct().collect()}
    assert {r["day"]: r["provisional"] for r in got} == want and any(want.values())


def test_refused_requests_are_kept(spark, accounts):
    from tallyloom.streaming.score_log import refused_requests

    item = request_json("customerID", [F.col(c) for c in TELCO.features])
    good, bad = [r[0] for r in accounts({}, {"tenure": "-1"}).select(item).collect()]
    extra = good.replace('"gender"', '"ssn":"1","gender"')
    bodies = ['{"items":[%s]}' % ",".join([good, bad, extra]), "broken", '{"items":[]}',
              '{"items":[%s]}' % ",".join([good] * 65)]
    rows = refused_requests(spark.createDataFrame([(b,) for b in bodies], "value string"), TELCO).collect()
    capped = [r for r in rows if r["error"].startswith("batch: more than")]
    assert len(capped) == 65 and len(rows) == 69
    rest = {(r["index"], r["body"]): r for r in rows if r not in capped}
    assert set(rest) == {(1, None), (2, None), (None, "broken"), (None, '{"items":[]}')}
    assert all(r["error"] for r in rest.values()) and "ssn" in rest[2, None]["error"]
    assert rest[1, None]["features"]["tenure"] == "-1" and "TEST-0000" not in str(rows)
