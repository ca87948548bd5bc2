"""The query catalogue: name -> (spark, data folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.features import tenure_group
from tallyloom.functions.text import first_hop, to_number
from tallyloom.operators import contracts as C
from tallyloom.operators import drift as D
from tallyloom.operators import metrics as M
from tallyloom.operators import profiling as P
from tallyloom.operators import splitting as S
from tallyloom.operators.cleaning import clean, engineer, features_and_label, with_label
from tallyloom.operators.quota import quota_flags
from tallyloom.operators.digest import table_digest
from tallyloom.operators.rollup import request_rollup
from tallyloom.plans import datasets as X
from tallyloom.plans import training as TR
from tallyloom.plans.preprocess import MedianScaler, one_hot_stages
from tallyloom.plans.scoring import score_batch
from tallyloom.plans.snapshot import SNAPSHOT_COLUMNS, account_snapshot
from tallyloom.session import scratch_dir, small_table, stored
from tallyloom.sources import checksum, prediction_log, registry, reports
from tallyloom.sources.csv_table import read_csv, write_assignments, write_csv
from tallyloom.sources.requests import flatten_items, parse_batches
from tallyloom.sources.tables import events, table
from tallyloom.spec import ACCOUNT
from tallyloom.streaming.drift import (
    latest_cells,
    psi_with_open_windows,
    reached_watermark,
    start_cell_updates,
    windowed_cells,
)
from tallyloom.streaming.quota import stream_quota_flags
from tallyloom.streaming.score_log import start_score_log
from tallyloom.streaming.tail_drift import start_tail_drift

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

KEY, LABEL, YES = ACCOUNT.id_col, ACCOUNT.label_col, ACCOUNT.positive
RATE_COLUMNS = ("segment", "last_status", "last_priority", "active", "tenure_group")
NUMBERS = ("tenure", "monthly_charges", "total_charges")
THRESHOLD = 0.1


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _r(name: str, digits: int = 6):
    return F.round(F.col(name), digits).alias(name)


def _stored_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """The snapshot as a table, for queries that pass over it more than once."""
    return stored(account_snapshot(spark, d), "snapshot")


def _grouped(spark: SparkSession, d: str) -> DataFrame:
    return account_snapshot(spark, d).withColumn("tenure_group", tenure_group(F.col("tenure")))


@query
def churn_by_tenure_group(spark, d):
    return P.rate_by(_grouped(spark, d), "tenure_group", LABEL, YES).select(
        "tenure_group", "n", _r("rate")
    )


@query
def snapshot(spark, d):
    return account_snapshot(spark, d).select(*SNAPSHOT_COLUMNS)


@query
def csv_roundtrip(spark, d):
    path = write_csv(account_snapshot(spark, d).select(*SNAPSHOT_COLUMNS), scratch_dir(spark, "csv"))
    scanned = read_csv(spark, path, ACCOUNT, SNAPSHOT_COLUMNS)
    return scanned.withColumn(KEY, F.col(KEY).cast("bigint"))


@query
def clean_snapshot(spark, d):
    padded = account_snapshot(spark, d).withColumn(
        "segment", F.concat(F.lit(" "), F.col("segment"))
    )
    return clean(padded, ACCOUNT).select(*SNAPSHOT_COLUMNS)


@query
def engineered_features(spark, d):
    return engineer(clean(account_snapshot(spark, d), ACCOUNT), ACCOUNT).select(
        KEY, "tenure_group", "service_count", "avg_monthly_charges", "no_security_support"
    )


@query
def feature_label_frame(spark, d):
    df = features_and_label(account_snapshot(spark, d), ACCOUNT)
    return C.require_columns(df, [KEY, *ACCOUNT.features, "label"])


# --- contracts -------------------------------------------------------------------------


def _violations(spark, d):
    bad = stored(X.defective_snapshot(spark, d), "defective")
    return C.violations(bad, C.raw_contract(ACCOUNT), KEY).unionByName(
        C.unique_violations(bad, KEY)
    )


@query
def contract_violations(spark, d):
    return _violations(spark, d)


@query
def contract_summary(spark, d):
    return C.violation_summary(_violations(spark, d))


@query
def top_violations(spark, d):
    return C.top_violations(_violations(spark, d), KEY)


@query
def quarantine_rows(spark, d):
    bad = X.defective_snapshot(spark, d)
    return C.with_verdict(bad, C.scoring_contract(ACCOUNT)).select(KEY, "ok", "error")


@query
def accepted_rows(spark, d):
    good, _ = C.accept_and_quarantine(X.defective_snapshot(spark, d), C.raw_contract(ACCOUNT))
    return good.groupBy("segment").agg(F.count(F.lit(1)).alias("n"))


@query
def request_items(spark, d):
    items = flatten_items(parse_batches(X.request_bodies(spark, d), "value"), ACCOUNT, ["batch_id"])
    judged = C.with_verdict(items, C.request_contract(ACCOUNT))
    extra = F.concat_ws(",", "extra_keys")
    return judged.select(
        "batch_id",
        "index",
        "customer_id",
        "ok",
        F.coalesce("error", F.lit("")).alias("error"),
        extra.alias("extra_keys"),
    )


@query
def batch_cap(spark, d):
    parsed = parse_batches(X.request_bodies(spark, d), "value")
    return parsed.select(
        "batch_id",
        F.size("items").alias("n_items"),
        F.coalesce("batch_error", F.lit("")).alias("batch_error"),
    )


@query
def edge_extra_keys(spark, d):
    keys = C.unknown_keys(F.col("props"), ["j"])
    return (
        table(spark, d, "events")
        .select("event_type", F.explode(keys).alias("extra_key"))
        .groupBy("event_type", "extra_key")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query
def duplicate_keys(spark, d):
    return S.duplicate_keys(table(spark, d, "events"), "user_id")


@query
def duplicate_key_count(spark, d):
    return P.duplicate_key_count(X.defective_snapshot(spark, d), KEY)


@query
def duplicate_rows(spark, d):
    return P.duplicate_text_count(table(spark, d, "documents"), "text")


@query
def duplicate_snapshot_rows(spark, d):
    return P.duplicate_row_count(X.defective_snapshot(spark, d))


# --- profiling -------------------------------------------------------------------------


@query
def null_profile(spark, d):
    return P.null_profile(X.defective_snapshot(spark, d))


@query
def table_facts(spark, d):
    return P.table_facts(account_snapshot(spark, d).select(*SNAPSHOT_COLUMNS), ACCOUNT)


@query
def cardinality(spark, d):
    return P.cardinality(account_snapshot(spark, d), [*ACCOUNT.categorical, LABEL])


@query
def value_counts(spark, d):
    df = account_snapshot(spark, d)
    return P.value_counts(df, ACCOUNT.categorical).select("column", "value", "n", _r("share"))


@query
def class_balance(spark, d):
    return P.class_balance(account_snapshot(spark, d), LABEL, YES).select(
        "n_positive", "n_negative", _r("positive_rate"), "imbalance_ratio"
    )


@query
def rate_by_tenure(spark, d):
    return P.rate_by(account_snapshot(spark, d), "tenure", LABEL, YES).select(
        "tenure", "n", _r("rate")
    )


@query
def rate_by_group(spark, d):
    return P.rate_by_columns(_grouped(spark, d), RATE_COLUMNS, LABEL, YES).select(
        "column", "value", "n", _r("rate")
    )


@query
def top2_rate_per_column(spark, d):
    rates = P.rate_by_columns(_grouped(spark, d), RATE_COLUMNS, LABEL, YES)
    return P.top_rates(rates).select("column", "value", "n", _r("rate"), "rank")


@query
def five_number_by_class(spark, d):
    boxes = P.five_numbers(_stored_snapshot(spark, d), NUMBERS, LABEL)
    return _boxes(boxes)


@query
def five_number_by_service(spark, d):
    return _boxes(P.five_numbers(_stored_snapshot(spark, d), ["monthly_charges"], "last_status"))


def _boxes(boxes):
    names = ("min", "q1", "median", "q3", "max", "low_fence", "high_fence")
    shown = [F.round(c, 4).alias(c) for c in names]
    return boxes.select("column", "group", "n", *shown, "n_outliers")


@query
def corr_matrix(spark, d):
    df = with_label(clean(account_snapshot(spark, d), ACCOUNT), ACCOUNT)
    columns = [*NUMBERS, "urgent_flag", "label"]
    return P.correlation_pairs(df, columns).select("a", "b", _r("r"))


@query
def redundancy_check(spark, d):
    df = clean(account_snapshot(spark, d), ACCOUNT)
    return P.redundancy(
        df, F.col("total_charges"), F.col("tenure"), F.col("monthly_charges")
    ).select("n", _r("r"), _r("mean_relative_gap", 4))


# --- splits ----------------------------------------------------------------------------


def _split(spark, d):
    return S.stratified_split(_stored_snapshot(spark, d), KEY, LABEL)


@query
def stratified_split(spark, d):
    return S.assignments(_split(spark, d), KEY)


@query
def split_balance(spark, d):
    return S.split_balance(_split(spark, d), LABEL, YES).select("split", "n", _r("positive_rate"))


@query
def split_disjoint(spark, d):
    """Splits kept apart, where some accounts were put into the test split as well."""
    split = stored(_split(spark, d).select(KEY, "split"), "split")
    torn = {s: split.filter(F.col("split") == s) for s in ("train", "validation", "test")}
    torn["test"] = torn["test"].unionByName(split.filter(F.col(KEY) % 83 == 9))
    overlap = S.split_overlap(S.union_assignments(torn, KEY), KEY)
    return overlap.agg(F.count(F.lit(1)).alias("n_overlapping"))


@query
def split_membership(spark, d):
    path = write_assignments(_split(spark, d), KEY, scratch_dir(spark, "split"))
    assigned = spark.read.parquet(path)
    parts = {
        name: assigned.filter(F.col("split") == name) for name in ("train", "validation", "test")
    }
    joined = S.join_assignments(
        account_snapshot(spark, d), S.union_assignments(parts, KEY), KEY
    )
    return joined.groupBy("split", "segment").agg(F.count(F.lit(1)).alias("n"))


@query
def hash_split(spark, d):
    return S.assignments(S.hash_split(account_snapshot(spark, d), KEY), KEY)


@query
def kfold_assignment(spark, d):
    return S.kfold(_stored_snapshot(spark, d), KEY, LABEL).select(KEY, "fold")


@query
def seeded_sample(spark, d):
    return S.seeded_sample(account_snapshot(spark, d), KEY, 1000).select(KEY, LABEL)


@query
def class_weights(spark, d):
    return S.class_weights(_stored_snapshot(spark, d), LABEL).select(LABEL, "n", _r("weight"))


@query
def majority_baseline(spark, d):
    split = stored(with_label(_split(spark, d), ACCOUNT), "split")
    return TR.majority_baseline(
        split.filter("split = 'train'"), split.filter("split = 'test'")
    ).select("majority", "n", _r("precision"), _r("recall"), _r("f1"), "roc_auc")


# --- metrics ---------------------------------------------------------------------------


@query
def confusion_metrics(spark, d):
    rates = ("positive_rate", "precision", "recall", "f1", "accuracy", "f1_macro")
    return M.confusion_metrics(X.scored_events(spark, d), "y", "p", THRESHOLD).select(
        "n", "tn", "fp", "fn", "tp", *[_r(c) for c in rates]
    )


@query
def brier(spark, d):
    return M.brier(X.scored_events(spark, d), "y", "p").select(_r("brier"))


@query
def threshold_sweep(spark, d):
    return M.threshold_sweep(X.scored_events(spark, d), "y", "p").select(
        "threshold", "tp", "fp", "fn", "tn", _r("precision"), _r("recall"), _r("f1"),
        _r("accuracy"), _r("f1_macro"),
    )


@query
def best_threshold(spark, d):
    sweep = M.threshold_sweep(X.scored_events(spark, d), "y", "p")
    return M.best_threshold(sweep).select("threshold", _r("f1"))


@query
def roc_auc(spark, d):
    return M.roc_auc(M.ranked_counts(X.scored_events(spark, d), "y", "p")).select(_r("roc_auc"))


@query
def pr_auc(spark, d):
    return M.pr_auc(M.ranked_counts(X.scored_events(spark, d), "y", "p")).select(_r("pr_auc"))


@query
def roc_points(spark, d):
    return M.roc_points(M.ranked_counts(X.scored_events(spark, d), "y", "p")).select(
        _r("threshold"), _r("fpr"), _r("tpr")
    )


@query
def pr_points(spark, d):
    return M.pr_points(M.ranked_counts(X.scored_events(spark, d), "y", "p")).select(
        _r("threshold"), _r("precision"), _r("recall")
    )


@query
def calibration(spark, d):
    return M.calibration(X.scored_events(spark, d), "y", "p").select(
        "bin", "n", _r("mean_score"), _r("fraction_positive")
    )


@query
def score_histogram(spark, d):
    return M.score_histogram(X.scored_events(spark, d), "y", "p").select(
        "y", "bin", _r("left_edge", 9), "n", _r("density")
    )


@query
def metric_record(spark, d):
    names = ("positive_rate", "accuracy", "precision", "recall", "f1", "f1_macro", "roc_auc",
             "pr_auc", "brier")
    return M.metric_record(X.scored_events(spark, d), "y", "p", THRESHOLD).select(
        "threshold", "n_samples", *[_r(c) for c in names], "confusion.*"
    )


@query
def fairness_slices(spark, d):
    df = with_label(account_snapshot(spark, d), ACCOUNT).withColumn(
        "p", 1.0 - F.col("tenure") / 80.0
    )
    return M.fairness_slices(df, ["sign_flag", "urgent_flag"], "label", "p", 0.25)


@query
def feature_auc_screen(spark, d):
    df = with_label(clean(_stored_snapshot(spark, d), ACCOUNT), ACCOUNT)
    return M.single_feature_auc(df, "label", ACCOUNT.numeric, ACCOUNT.categorical)


# --- drift -----------------------------------------------------------------------------


def _reference(spark, d, compat=False):
    """Fitted on the earlier events, stored and read back."""
    ref = D.fit_reference(
        X.before_cut(X.event_features(spark, d)), X.EVENT_NUMERIC, X.EVENT_CATEGORICAL,
        compat=compat,
    )
    return reports.load_reference(spark, reports.save_reference(ref, scratch_dir(spark, "ref")))


def _report(spark, d):
    return D.drift_report(_reference(spark, d), X.after_cut(X.event_features(spark, d)))


@query
def reference_stats(spark, d):
    return _reference(spark, d).select(
        "feature", "kind", "bin", _r("lo"), _r("hi"), "category", _r("expected")
    )


@query
def reference_stats_compat(spark, d):
    return _reference(spark, d, True).select(
        "feature", "kind", "bin", _r("lo"), _r("hi"), "category", _r("expected")
    )


@query
def psi_numeric(spark, d):
    current = X.after_cut(X.event_features(spark, d))
    return D.psi_numeric(_reference(spark, d, True), current).select(
        "feature", _r("psi"), "n_out_of_range"
    )


@query
def psi_categorical(spark, d):
    current = X.after_cut(X.event_features(spark, d))
    reference = _reference(spark, d).filter(F.col("feature").isin(*X.EVENT_CATEGORICAL))
    return D.psi_categorical(reference, current).select("feature", _r("psi"))


@query
def drift_report(spark, d):
    return _report(spark, d)


@query
def drift_summary(spark, d):
    return D.drift_summary(_report(spark, d))


@query
def drift_top_features(spark, d):
    return D.top_features(_report(spark, d), 3).select("feature", "psi")


@query
def retrain_trigger(spark, d):
    return D.retrain_trigger(_report(spark, d))


@query
def drift_by_window(spark, d):
    current = X.after_cut(X.event_features(spark, d))
    return D.drift_report(_reference(spark, d), current, ["day"])


@query
def drift_recent_records(spark, d):
    """The last 500 records against the reference, written as one nested report."""
    feats = X.event_features(spark, d)
    last = prediction_log.recent(feats, D.WINDOW_RECORDS, "ts", "event_id")
    report = D.report_if_enough(_reference(spark, d), last)
    if report is None:
        raise ValueError("too few records")
    row = reports.nested_report(report, D.drift_summary(report), last.count())
    path = reports.write_report(row, scratch_dir(spark, "report"))
    stored = spark.read.schema(row.schema).json(path)
    return stored.select(
        "n_records", "features_checked", "worst_psi", "n_alert", F.inline("features")
    )


# --- log, quota, rollup ----------------------------------------------------------------

_EVENT_STRUCT = T.StructType(
    [T.StructField("event_type", T.StringType()), T.StructField("amount", T.StringType())]
)


def _event_log(spark, d):
    """Scored events appended to a log, plus one torn and one blank line, read tolerantly."""
    scored = events(spark, d).select(
        "ts",
        F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("r-"), "event_id"))
        .otherwise(F.concat(F.lit("q-"), "event_id"))
        .alias("rid"),
        F.when(F.col("user_id") % 50 == 0, "").otherwise(F.col("user_id").cast("string")).alias(
            "client"
        ),
        "event_type",
        F.when(F.col("event_id") % 10 == 3, "<NA>")
        .otherwise(F.col("value").cast("decimal(12,2)").cast("string"))
        .alias("amount"),
        F.least(F.col("value") / 500.0, F.lit(1.0)).alias("p"),
    ).withColumn("verdict", F.when(F.col("p") >= THRESHOLD, "Yes").otherwise("No"))
    records = prediction_log.log_records(
        scored, ["event_type", "amount"], "client", "p", "verdict", "v1",
        F.col("rid"), F.col("ts").cast("timestamp"), F.lit(1.0),
    )
    path = scratch_dir(spark, "log")
    prediction_log.append_log(records, path)
    torn = spark.createDataFrame(
        [('{"ts": "2024-01-15T00:00:00", "request_id": "torn', "2024-01-15"), ("", "2024-01-15")],
        "value string, day string",
    )
    torn.coalesce(1).write.mode("append").partitionBy("day").text(path)
    return prediction_log.read_log_or_empty(spark, path, prediction_log.log_schema(_EVENT_STRUCT))


@query
def pseudonymised_log(spark, d):
    return _event_log(spark, d).select(
        "ts",
        "request_id",
        "customer_id_hash",
        "features.event_type",
        to_number(F.col("features.amount")).alias("amount"),
        "churn_probability",
        "prediction",
        "model_version",
    )


@query
def recent_log(spark, d):
    return prediction_log.recent(_event_log(spark, d), 500).select("ts", "request_id")


@query
def client_keys(spark, d):
    e = events(spark, d)
    forwarded = F.when(
        F.col("event_id") % 3 == 0,
        F.concat(F.lit(" 10.0.0."), F.col("user_id") % 7, F.lit(", 192.168.0.1")),
    )
    host = F.when(F.col("event_id") % 3 == 1, F.concat(F.lit("host-"), F.col("user_id") % 5))
    return e.groupBy(first_hop(forwarded, host).alias("client")).agg(
        F.count(F.lit(1)).alias("n")
    )


QUOTA_WINDOW, QUOTA_LIMIT = 86_400, 2


@query
def quota_flags_by_user(spark, d):
    return quota_flags(
        events(spark, d), "user_id", "ts_us", "event_id", QUOTA_LIMIT, QUOTA_WINDOW
    )


@query
def quota_flags_by_type(spark, d):
    """Few very busy keys: every window carries over chunk borders."""
    return quota_flags(events(spark, d), "event_type", "ts_us", "event_id", 5, 3600, 7200)


@query
def request_rollup_daily(spark, d):
    day = F.date_format("ts", "yyyy-MM-dd")
    return request_rollup(
        events(spark, d), day, "event_type", F.col("value") > 100, "value"
    ).select("window_start", "path", "n", _r("error_share"), "latency_p50", "latency_p95")


@query
def table_digests(spark, d):
    return table_digest(
        table(spark, d, "events"), ["event_id", "user_id", "props"], ["event_type"]
    )


@query
def file_checksums(spark, d):
    """Files against a manifest with one changed pin, one file it lacks and one that is gone."""
    found = checksum.file_checksums(spark, d, "*.parquet")
    pins = F.when(F.col("file") == "nation.parquet", F.sha2("sha256", 256)).otherwise(F.col("sha256"))
    listed = found.filter("file <> 'region.parquet'").select("file", pins.alias("sha256"))
    gone = small_table(spark, [("gone.parquet", "0" * 64)], "file string, sha256 string")
    manifest = listed.unionByName(gone)
    return checksum.against_manifest(found, manifest).select("file", "length", "sha256", "status")


# --- fitted preprocessing and models -----------------------------------------------------


def _prepared(spark, d):
    return TR.prepare(stored(X.planted_accounts(spark, d), "planted"), "ACCOUNT")


@query
def impute_scale(spark, d):
    cleaned = engineer(clean(stored(_split(spark, d), "split"), ACCOUNT), ACCOUNT)
    columns = [*NUMBERS, "avg_monthly_charges"]
    model = MedianScaler(inputCols=columns).fit(cleaned.filter("split = 'train'"))
    return model.transform(cleaned).select(KEY, *[_r(f"{c}_scaled") for c in columns])


def _slot(column):
    return lambda v, i: F.struct(
        F.lit(column).alias("column"), i.cast("int").alias("slot"), v.alias("on")
    )


@query
def one_hot_slots(spark, d):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    columns = ["last_status", "segment", "last_priority"]
    split = stored(_split(spark, d), "split")
    model = Pipeline(stages=one_hot_stages(columns)).fit(split.filter("split = 'train'"))
    indexer = model.stages[0]
    cells = [
        F.inline(
            F.filter(
                F.transform(
                    vector_to_array(f"{c}_slots"),
                    _slot(c),
                ),
                lambda s: s["on"] > 0,
            )
        )
        for c in columns
    ]
    encoded = model.transform(split)
    long = None
    for cell in cells:
        part = encoded.select(cell)
        long = part if long is None else long.unionByName(part)
    names = small_table(
        spark,
        [(c, i, v) for c, vs in zip(columns, indexer.labelsArray) for i, v in enumerate(vs)],
        "column string, slot int, category string",
    )
    return (
        long.groupBy("column", "slot")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(names, ["column", "slot"])
    )


@query
def oof_logreg(spark, d):
    prepared = _prepared(spark, d)
    scored = TR.out_of_fold(prepared, "ACCOUNT", "logreg", k=5)
    return M.metric_record(scored, "label", "p", 0.5).drop("confusion")


def _compare(spark, d):
    """All candidates on five folds, with the library's search spaces and numbers of trials."""
    return TR.compare_candidates(_prepared(spark, d), "ACCOUNT", k=5)


@query
def cv_candidates(spark, d):
    return TR.comparison_table(spark, _compare(spark, d))


def _final(spark, d, name="random_forest", params=None):
    planted = stored(X.planted_accounts(spark, d), "planted")
    split = stored(S.stratified_split(planted, KEY, LABEL, check_unique=False), "planted-split")
    parts = {s: split.filter(F.col("split") == s) for s in ("train", "validation", "test")}
    final = TR.fit_final(parts["train"], parts["validation"], "ACCOUNT", name, params or {})
    return final, parts


@query
def select_model(spark, d):
    winner = TR.select_candidate(_compare(spark, d))
    final, parts = _final(spark, d, winner.name, winner.best[0])
    record = TR.evaluate_final(final, parts["test"], "ACCOUNT")
    return record.drop("confusion").withColumn("estimator", F.lit(winner.name))


@query
def score_accounts(spark, d):
    final, _ = _final(spark, d)
    rows = X.defective_snapshot(spark, d, repeats=False)
    return score_batch(rows, final, "ACCOUNT", KEY, "v1").select(
        KEY, "ok", "error", "churn_probability", "prediction", "applied_threshold"
    )


@query
def feature_importance(spark, d):
    final, _ = _final(spark, d)
    rows = TR.feature_importances(final, "ACCOUNT")
    return small_table(spark, rows, "feature string, importance double")


@query
def registry_latest(spark, d):
    """Save two versions, load the latest, and gate every version."""
    folder = scratch_dir(spark, "models")
    final, parts = _final(spark, d)
    record = TR.evaluate_final(final, parts["test"], "ACCOUNT").first().asDict(recursive=True)
    used = [KEY, *ACCOUNT.features, LABEL]
    meta = registry.provenance(parts, used, folds=5, seed=S.SEED)
    for version in ("1.0.0", "1.0.1"):
        registry.save_model(spark, folder, final, version, list(ACCOUNT.features), record, meta)
    loaded, row = registry.load_model(spark, folder)
    scored = TR._scored(loaded.model, parts["test"], KEY)
    n = M.confusion_metrics(scored, "label", "p", loaded.threshold).select("f1").first()["f1"]
    digest = registry.provenance(parts, used, folds=5, seed=S.SEED)["data_digest"]
    return registry.regression_gate(registry.versions(spark, folder), digest=digest).select(
        "version",
        "estimator",
        "threshold",
        "f1",
        "roc_auc",
        "passed",
        (F.col("version") == row["version"]).alias("is_latest"),
        F.lit(float(n)).alias("f1_after_load"),
    )


@query
def improvement_gate(spark, d):
    final, parts = _final(spark, d, "logreg")
    record = TR.evaluate_final(final, parts["test"], "ACCOUNT")
    base = TR.majority_baseline(parts["train"], parts["test"]).first()["f1"]
    return TR.improvement_gate(record, base)


# --- streaming -------------------------------------------------------------------------


def _event_stream(spark, d):
    from tallyloom.functions.text import utc_micros

    schema = table(spark, d, "events").schema
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(d)
        .withColumn("ts_us", utc_micros("ts"))
    )


def _run_to_table(spark, stream, name):
    base = scratch_dir(spark, name)
    (
        stream.writeStream.format("parquet")
        .option("path", f"{base}/out")
        .option("checkpointLocation", f"{base}/checkpoint")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.parquet(f"{base}/out")


@query
def stream_quota(spark, d):
    flags = stream_quota_flags(
        _event_stream(spark, d), "user_id", "ts_us", "event_id", QUOTA_LIMIT, QUOTA_WINDOW
    )
    return _run_to_table(spark, flags, "stream-quota")


@query
def stream_drift(spark, d):
    reference = _reference(spark, d)
    stream = X.with_event_features(_event_stream(spark, d)).withColumn(
        "event_time", F.timestamp_micros("ts_us")
    )
    edges = D.reference_edges(reference)
    cells = windowed_cells(
        stream, "event_time", "1 day", "1 hour", edges, D.reference_categories(reference)
    )
    base = scratch_dir(spark, "stream-drift")
    started = start_cell_updates(cells, f"{base}/out", f"{base}/checkpoint")
    started.awaitTermination()
    return psi_with_open_windows(
        latest_cells(spark, f"{base}/out"), reference, reached_watermark(started)
    ).select(
        F.date_format("window_start", "yyyy-MM-dd").alias("day"), "feature", "psi", "status",
        "provisional",
    )


@query
def stream_tail_drift(spark, d):
    """A log is followed; after its batch the last 500 records are compared."""
    base = scratch_dir(spark, "stream-tail")
    names = [*X.EVENT_NUMERIC, *X.EVENT_CATEGORICAL]
    feats = X.event_features(spark, d).withColumn("p", F.lit(0.0)).withColumn("v", F.lit("No"))
    records = prediction_log.log_records(
        feats, names, "event_id", "p", "v", "v1",
        F.lpad(F.col("event_id").cast("string"), 12, "0"), F.col("ts").cast("timestamp"),
    )
    prediction_log.append_log(records, f"{base}/log")
    logged = T.StructType([*feats.select(*names).schema.fields])
    start_tail_drift(
        spark, f"{base}/log", prediction_log.log_schema(logged), _reference(spark, d),
        f"{base}/reports", f"{base}/checkpoint",
    ).awaitTermination()
    return spark.read.parquet(f"{base}/reports").select("feature", "psi", "status")


def _score_log(spark, d):
    """All requests through the scoring stream: its log and what it refused."""
    base = scratch_dir(spark, "stream-score")
    X.request_bodies(spark, d).select("value").write.text(f"{base}/requests")
    final, _ = _final(spark, d, "logreg")
    start_score_log(
        spark, f"{base}/requests", final, "ACCOUNT", "v1", f"{base}/log", f"{base}/checkpoint"
    ).awaitTermination()
    schema = prediction_log.log_schema(prediction_log.feature_struct(ACCOUNT))
    log = prediction_log.read_log(spark, f"{base}/log", schema)
    return log, spark.read.parquet(f"{base}/log-refused")


@query
def stream_score_log(spark, d):
    log, refused = _score_log(spark, d)
    # refused items and batches have no prediction
    without = refused.select(
        F.lit(None).cast("string").alias("prediction"),
        F.lit("v1").alias("model_version"),
        "customer_id_hash",
    )
    rows = log.select(*without.columns).unionByName(without)
    return rows.groupBy("prediction", "model_version").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("customer_id_hash").alias("n_clients")
    )


@query
def stream_request_verdicts(spark, d):
    """Items, clients and requests by error; the accepted ones, with a latency, have none."""
    log, refused = _score_log(spark, d)
    ids = ["customer_id_hash", "request_id"]
    accepted = log.select(F.lit("").alias("error"), *ids, (F.col("inference_ms") > 0).alias("timed"))
    rows = accepted.unionByName(refused.select("error", *ids, F.lit(False).alias("timed")))
    return rows.groupBy("error").agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("customer_id_hash").alias("n_clients"),
        F.countDistinct("request_id").alias("n_requests"),
        F.count_if("timed").alias("n_timed"),
    )
