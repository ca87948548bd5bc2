import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tallyloom.operators.quota import quota_flags
from tallyloom.sources import checksum, prediction_log, reports
from tallyloom.sources.csv_table import read_csv, write_csv
from tallyloom.sources.requests import flatten_items, parse_batches, request_json
from tallyloom.spec import TELCO

S = 1_000_000


def walk(events, limit, seconds):
    """Plain walk over the events of each key."""
    state, out = {}, {}
    for key, us, i in sorted(events, key=lambda e: (e[1], e[2])):
        start, n = state.get(key, (us, 0))
        if us - start >= seconds * S:
            start, n = us, 0
        state[key] = (start, n + 1)
        out[i] = (start, n + 1, n + 1 <= limit)
    return out


def flags(spark, events, limit, seconds, chunk):
    df = spark.createDataFrame(events, "k string, us long, id long")
    rows = quota_flags(df, "k", "us", "id", limit, seconds, chunk).collect()
    return {r["event_id"]: (r["window_start_us"], r["n_in_window"], r["allowed"]) for r in rows}


def test_third_event_is_flagged_and_exact_edge_reopens(spark):
    events = [("a", 0, 1), ("a", S, 2), ("a", 2 * S, 3), ("a", 60 * S, 4), ("a", 119 * S, 5),
              ("a", 120 * S, 6)]
    got = flags(spark, events, 2, 60, 900)
    assert got == walk(events, 2, 60)
    assert got[3][2] is False and got[4] == (60 * S, 1, True) and got[6][0] == 120 * S


@pytest.mark.parametrize("chunk, gap", [(60, 1.0), (100, 7.0), (900, 0.4), (60, 45.0)])
def test_chunked_windows_equal_a_plain_walk(spark, chunk, gap):
    rng = random.Random(int(chunk * gap))
    events, clock = [], {"hot": -500 * S, "b": 0, "c": 17 * S}
    for i in range(1500):
        key = "hot" if i % 3 else rng.choice(["b", "c"])
        # Some events share a timestamp.
        clock[key] += int(rng.choice([0, rng.expovariate(1 / gap)]) * S)
        events.append((key, clock[key], i))
    assert flags(spark, events, 5, 60, chunk) == walk(events, 5, 60)


def test_log_round_trip_skips_torn_and_blank_lines(spark, accounts, tmp_path):
    path = str(tmp_path / "log")
    schema = prediction_log.log_schema(prediction_log.feature_struct(TELCO))
    assert prediction_log.read_log_or_empty(spark, path, schema).count() == 0
    scored = accounts({}, {"customerID": "", "TotalCharges": "<NA>"}).withColumns(
        {
            "p": F.lit(0.12345678),
            "v": F.lit("No"),
            "tenure": F.col("tenure").cast("long"),
            "SeniorCitizen": F.col("SeniorCitizen").cast("long"),
            "MonthlyCharges": F.col("MonthlyCharges").cast("double"),
        }
    )
    for rows in (scored, scored.limit(1)):
        records = prediction_log.log_records(
            rows, TELCO.features, "customerID", "p", "v", "1.0.0"
        )
        prediction_log.append_log(records, path)
    day = next((tmp_path / "log").glob("day=*"))
    (day / "torn.json").write_text('\n{"ts": "2024-01-01T0\n')
    log = prediction_log.read_log_or_empty(spark, path, schema)
    rows = log.collect()
    assert len(rows) == 3
    assert {r["churn_probability"] for r in rows} == {0.123457}
    assert None in {r["customer_id_hash"] for r in rows}
    assert len({r["request_id"] for r in rows}) == 3
    totals = prediction_log.logged_features(log, TELCO).select("TotalCharges").collect()
    assert {t[0] for t in totals} == {2340.0, None}
    assert prediction_log.recent(log, 2).count() == 2
    assert prediction_log.recent(log, 0).count() == 0


def test_csv_keeps_blanks(spark, account, accounts, tmp_path):
    df = accounts({"TotalCharges": " "}, {})
    path = write_csv(df, str(tmp_path / "csv"))
    rows = read_csv(spark, path, TELCO, df.columns, validate=True).orderBy("customerID").collect()
    assert [r["TotalCharges"] for r in rows] == [" ", "2340"]
    assert rows[0]["tenure"] == int(account["tenure"])
    with pytest.raises(Exception):
        read_csv(spark, str(tmp_path / "absent"), TELCO, df.columns).count()


def test_checksums_against_manifest(spark, tmp_path):
    body = b"a,b\n1,2\n"
    (tmp_path / "one.csv").write_bytes(body)
    (tmp_path / "two.csv").write_bytes(b"x")
    found = checksum.file_checksums(spark, str(tmp_path), "*.csv")
    good = hashlib.sha256(body).hexdigest()
    manifest = spark.createDataFrame(
        [("one.csv", good), ("two.csv", "0"), ("three.csv", "0")], "file string, sha256 string"
    )
    checked = checksum.against_manifest(found, manifest)
    assert {r["file"]: r["status"] for r in checked.collect()} == {
        "one.csv": "match", "two.csv": "mismatch", "three.csv": "missing"}
    with pytest.raises(checksum.ChecksumError):
        checksum.require_match(checked)
    checksum.require_match(checked.filter("status = 'match'"))


def test_request_batches(spark, accounts):
    item = request_json("customerID", [F.col(c) for c in TELCO.features])
    one = accounts({}).select(item).first()[0]
    bodies = [
        (1, '{"items":[%s,%s]}' % (one, one.replace('"gender"', '"ssn":"1","gender"'))),
        (2, '{"items":[]}'),
        (3, "not json"),
        (4, '{"items":[%s]}' % ",".join([one] * 65)),
        (5, '{"items":[%s]}' % ",".join([one] * 64)),
        (6, one),
        (7, '{"foo":1,"items":[%s]}' % one),
        (8, '{"items":[%s,null,{"features":5}]}' % one.replace('{"customer', '{"ssn":"1","customer')),
        (9, "[1]"),
        (10, None),
    ]
    parsed = parse_batches(spark.createDataFrame(bodies, "b int, body string"), "body")
    errors = {r["b"]: r["batch_error"] for r in parsed.collect()}
    assert errors[1] is None and errors[5] is None
    assert errors[2] == "batch: no items" and errors[3] == "batch: not parsable"
    assert errors[4] == "batch: more than 64 items"
    assert errors[6] is None and errors[8] is None
    assert errors[7] == "batch: extra keys: foo"
    assert errors[9] == errors[10] == "batch: not parsable"
    every = flatten_items(parsed, TELCO, ["b"], refused=True).collect()
    assert sorted(r["b"] for r in every if r["index"] is None) == [2, 3, 9, 10]
    assert sum(r["b"] == 4 for r in every) == 65
    six = [(r["customer_id"], r["extra_keys"]) for r in every if r["b"] == 6]
    assert six == [("TEST-0000", [])]
    eight = sorted((r["index"], r["customer_id"], r["extra_keys"]) for r in every if r["b"] == 8)
    assert eight[0] == (0, "TEST-0000", ["ssn"])
    assert [e[1:] for e in eight[1:]] == [(None, []), (None, [])]
    items = flatten_items(parsed, TELCO, ["b"]).filter("b = 1").orderBy("index").collect()
    assert [r["extra_keys"] for r in items] == [[], ["ssn"]]
    assert items[0]["TotalCharges"] == "2340" and items[1]["customer_id"] == "TEST-0000"


def test_report_row(spark, tmp_path):
    report = spark.createDataFrame([("b", 0.3, "alert"), ("a", 0.0, "ok")],
                                   "feature string, psi double, status string")
    summary = report.agg(F.max("psi").alias("worst_psi"))
    row = reports.nested_report(report, summary, 50)
    path = reports.write_report(row, str(tmp_path / "r"))
    back = spark.read.schema(row.schema).json(path).first()
    assert back["n_records"] == 50 and [f["feature"] for f in back["features"]] == ["a", "b"]


def test_quota_keeps_events_without_key_or_time(spark):
    events = [("a", 0, 1), (None, 0, 2), (None, S, 3), ("a", None, 4), (None, None, 5)]
    df = spark.createDataFrame(events, "k string, us long, id long")
    got = {r["event_id"]: (r["key"], r["window_start_us"], r["n_in_window"], r["allowed"])
           for r in quota_flags(df, "k", "us", "id", 1, 60).collect()}
    assert got == {1: ("a", 0, 1, True), 2: ("unknown", 0, 1, True), 3: ("unknown", 0, 2, False),
                   4: ("a", None, None, False), 5: ("unknown", None, None, False)}


def test_checksums_of_long_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(checksum, "MAX_FILE_BYTES", 10)
    bodies = {"short.csv": b"0123456789", "long one%20.csv": b"0123456789" * 30_000}
    for name, body in bodies.items():
        (tmp_path / name).write_bytes(body)
    rows = checksum.file_checksums(spark, str(tmp_path), "*.csv").collect()
    assert {r["file"]: (r["length"], r["sha256"]) for r in rows} == {
        name: (len(body), hashlib.sha256(body).hexdigest()) for name, body in bodies.items()}


def test_long_files_are_read_in_pieces_by_the_given_opener(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(checksum, "MAX_FILE_BYTES", 10)
    body = b"0123456789" * 2000
    (tmp_path / "long.csv").write_bytes(body)

    class Counted:
        def __init__(self, path):
            self.stream = open(path.removeprefix("file:"), "rb")

        def __enter__(self):
            return self

        def __exit__(self, *_):
            self.stream.close()

        def read(self, n):
            return self.stream.read(min(n, 7))

    row = checksum.file_checksums(spark, str(tmp_path), "*.csv", Counted).first()
    assert (row["length"], row["sha256"]) == (len(body), hashlib.sha256(body).hexdigest())
    found = checksum.file_checksums(spark, str(tmp_path), "*.none")
    assert found.count() == 0


def test_checksums_never_load_a_whole_file(spark, tmp_path):
    bodies = {"short.csv": b"0123456789", "packed.csv.gz": gzip.compress(b"a,b\n" * 9),
              "long.csv": b"0123456789" * 1_000_000}
    for name, body in bodies.items():
        (tmp_path / name).write_bytes(body)
    limit = "spark.sql.sources.binaryFile.maxLength"
    spark.conf.set(limit, "10")  # Spark refuses to load longer files as one value
    try:
        rows = checksum.file_checksums(spark, str(tmp_path), "*.csv*").collect()
    finally:
        spark.conf.unset(limit)
    assert {r["file"]: (r["length"], r["sha256"]) for r in rows} == {
        name: (len(body), hashlib.sha256(body).hexdigest()) for name, body in bodies.items()}


def test_checksums_of_long_files_that_only_spark_opens(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(checksum, "MAX_FILE_BYTES", 10)
    body = b"0123456789" * 2000
    (tmp_path / "long.csv").write_bytes(body)
    mount = "fs.viewfs.mounttable.checksums.link./in"
    spark.conf.set(mount, f"file://{tmp_path}")
    try:
        row = checksum.file_checksums(spark, "viewfs://checksums/in", "*.csv").first()
    finally:
        spark.conf.unset(mount)
    assert (row["length"], row["sha256"]) == (len(body), hashlib.sha256(body).hexdigest())
