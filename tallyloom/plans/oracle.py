"""The catalogue queries as plain SQL over the same tables, written independently."""

from __future__ import annotations

# --- account snapshot ------------------------------------------------------------------

_TYPES = ("economy", "large", "medium", "promo", "small", "standard")

_SNAP = f"""
hist AS (
  SELECT o_custkey,
         min(o_orderdate) FILTER (o_orderdate < TIMESTAMP '2000-08-01') AS first_day,
         sum(CAST(round(o_totalprice * 100) AS BIGINT))
           FILTER (o_orderdate < TIMESTAMP '2000-08-01') AS life_cents,
         coalesce(sum(CAST(round(o_totalprice * 100) AS BIGINT)) FILTER (
           o_orderdate >= TIMESTAMP '1999-08-01' AND o_orderdate < TIMESTAMP '2000-08-01'
         ), 0) AS recent_cents,
         count(*) FILTER (
           o_orderdate >= TIMESTAMP '1999-08-01' AND o_orderdate < TIMESTAMP '2000-08-01'
         ) AS n_recent,
         count(*) FILTER (
           o_orderdate >= TIMESTAMP '1999-08-01' AND o_orderdate < TIMESTAMP '2000-08-01'
           AND o_orderpriority = '1-URGENT'
         ) AS n_urgent,
         count(*) FILTER (o_orderdate >= TIMESTAMP '2000-08-01') AS n_later
  FROM orders GROUP BY o_custkey
),
latest AS (
  SELECT o_custkey, o_orderstatus, o_orderpriority FROM (
    SELECT *, row_number() OVER (
      PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
    FROM orders WHERE o_orderdate < TIMESTAMP '2000-08-01'
  ) WHERE rn = 1
),
bought AS (
  SELECT o_custkey,
         {", ".join(f"bool_or(p_type = '{t.upper()}') AS has_{t}" for t in _TYPES)}
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey
  WHERE o_orderdate >= TIMESTAMP '1999-08-01' AND o_orderdate < TIMESTAMP '2000-08-01'
  GROUP BY o_custkey
),
snap AS (
  SELECT c_custkey AS account_id,
         CASE WHEN c_acctbal < 0 THEN 'Neg' ELSE 'Pos' END AS sign_flag,
         CAST(coalesce(n_urgent, 0) > 0 AS BIGINT) AS urgent_flag,
         CAST(coalesce(2000 * 12 + 8 - (year(first_day) * 12 + month(first_day)), 0)
              AS BIGINT) AS tenure,
         CASE WHEN coalesce(n_recent, 0) > 0 THEN 'Yes' ELSE 'No' END AS active,
         coalesce(o_orderstatus, 'No') AS last_status,
         {", ".join(f"CASE WHEN has_{t} THEN 'Yes' ELSE 'No' END AS bought_{t}" for t in _TYPES)},
         c_mktsegment AS segment,
         coalesce(o_orderpriority, 'none') AS last_priority,
         round(coalesce(recent_cents, 0)::DOUBLE / 1200.0::DOUBLE, 6) AS monthly_charges,
         CASE WHEN life_cents IS NULL THEN ' ' ELSE
           CAST(life_cents // 100 AS VARCHAR) || '.'
           || lpad(CAST(life_cents % 100 AS VARCHAR), 2, '0') END AS total_charges,
         CASE WHEN coalesce(n_later, 0) = 0 THEN 'Yes' ELSE 'No' END AS churn
  FROM customer
  LEFT JOIN hist ON hist.o_custkey = c_custkey
  LEFT JOIN latest ON latest.o_custkey = c_custkey
  LEFT JOIN bought ON bought.o_custkey = c_custkey
)"""

_COLUMNS = (
    "account_id, sign_flag, urgent_flag, tenure, active, last_status, "
    + ", ".join(f"bought_{t}" for t in _TYPES)
    + ", segment, last_priority, monthly_charges, total_charges, churn"
)

_NUM = """
num AS (
  SELECT *, TRY_CAST(trim(total_charges) AS DOUBLE) AS total,
         CAST(churn = 'Yes' AS INTEGER) AS label
  FROM snap
)"""

_GROUP = """CASE WHEN tenure <= 12 THEN '0-12m' WHEN tenure <= 24 THEN '13-24m'
            WHEN tenure <= 48 THEN '25-48m' ELSE '49m+' END"""

# Defects planted by account number.
_BAD = """
bad AS (
  SELECT * REPLACE (
    CASE WHEN account_id % 37 = 5 THEN 'Unknown' ELSE segment END AS segment,
    CASE WHEN account_id % 41 = 3 THEN -1 ELSE tenure END AS tenure,
    CASE WHEN account_id % 43 = 7 THEN 'abc' ELSE total_charges END AS total_charges,
    CASE WHEN account_id % 59 = 2 THEN -5.0 ELSE monthly_charges END AS monthly_charges,
    CASE WHEN account_id % 61 = 1 THEN NULL ELSE last_priority END AS last_priority,
    CASE WHEN account_id % 53 = 11 THEN NULL ELSE churn END AS churn
  ) FROM snap
),
twice AS (
  SELECT * FROM bad UNION ALL SELECT * FROM bad WHERE account_id % 101 = 4
),
report AS (
  SELECT account_id, 'segment' AS "column", 'one_of' AS rule, segment AS value
    FROM twice WHERE segment = 'Unknown'
  UNION ALL SELECT account_id, 'tenure', 'in_range', CAST(tenure AS VARCHAR)
    FROM twice WHERE tenure NOT BETWEEN 0 AND 72
  UNION ALL SELECT account_id, 'total_charges', 'number_or_blank', total_charges
    FROM twice WHERE total_charges = 'abc'
  UNION ALL SELECT account_id, 'monthly_charges', 'in_range', CAST(monthly_charges AS VARCHAR)
    FROM twice WHERE monthly_charges NOT BETWEEN 0 AND 1000000
  UNION ALL SELECT account_id, 'last_priority', 'not_null', NULL
    FROM twice WHERE last_priority IS NULL
  UNION ALL SELECT account_id, 'churn', 'not_null', NULL FROM twice WHERE churn IS NULL
  UNION ALL SELECT account_id, 'account_id', 'unique', CAST(account_id AS VARCHAR)
    FROM twice WHERE account_id IN (
      SELECT account_id FROM twice GROUP BY account_id HAVING count(*) > 1)
)"""

_BATCH = """CASE WHEN account_id % 97 = 13 THEN 'one-' || account_id
            WHEN (account_id // 64) % 9 = 4 THEN 'big-' || (account_id // 128)
            ELSE 'b-' || (account_id // 64) END"""

# every item sent, with the errors of its batch, its values and its keys
_SENT = f"""
sent AS (
  SELECT account_id, batch_id,
    row_number() OVER (PARTITION BY batch_id ORDER BY account_id) AS i,
    count(*) OVER (PARTITION BY batch_id) AS batch_size,
    CASE WHEN batch_id LIKE 'b-%' AND (account_id // 64) % 11 = 7 THEN 'batch: extra keys: foo'
         WHEN count(*) OVER (PARTITION BY batch_id) > 64 THEN 'batch: more than 64 items'
         ELSE '' END AS batch_error,
    concat_ws(',', CASE WHEN account_id % 31 = 8 THEN 'note' END,
                   CASE WHEN account_id % 29 = 6 THEN 'ssn' END) AS extra_keys,
    concat_ws('; ',
      CASE WHEN tenure NOT BETWEEN 0 AND 120 THEN 'tenure: in_range' END,
      CASE WHEN monthly_charges NOT BETWEEN 0 AND 10000000
        THEN 'monthly_charges: in_range' END,
      CASE WHEN TRY_CAST(trim(total_charges) AS DOUBLE) IS NULL
        THEN 'total_charges: coercible' END,
      CASE WHEN last_priority IS NULL THEN 'last_priority: not_null' END,
      CASE WHEN segment = 'Unknown' THEN 'segment: one_of' END) AS error
  FROM (SELECT *, {_BATCH} AS batch_id FROM bad)
)"""

_RANKED = """
ranked AS (
  SELECT account_id, churn, segment,
         row_number() OVER (PARTITION BY churn ORDER BY md5('42:' || account_id), account_id) AS r,
         count(*) OVER (PARTITION BY churn) AS n
  FROM snap
),
cuts AS (
  SELECT *, floor(n * 0.15::DOUBLE + 0.5::DOUBLE) AS n_test FROM ranked
),
split AS (
  SELECT account_id, churn, segment,
         CASE WHEN r <= n_test THEN 'test'
              WHEN r <= n_test + floor((n - n_test) * 0.1765::DOUBLE + 0.5::DOUBLE)
                THEN 'validation'
              ELSE 'train' END AS split
  FROM cuts
)"""


def _with(*ctes: str, body: str) -> str:
    return "WITH " + ", ".join(c.strip() for c in ctes) + "\n" + body.strip()


def _snap(body: str, *more: str) -> str:
    return _with(_SNAP, *more, body=body)


_RATE_COLUMNS = ("segment", "last_status", "last_priority", "active", "tenure_group")
_RATES = f"""
grouped AS (SELECT *, {_GROUP} AS tenure_group FROM snap),
rates AS (
  {" UNION ALL ".join(
      f'''SELECT '{c}' AS "column", {c} AS value, count(*) AS n,
          avg(CAST(churn = 'Yes' AS INTEGER)) AS rate FROM grouped GROUP BY 1, 2'''
      for c in _RATE_COLUMNS)}
)"""

_CATEGORICAL = (
    "sign_flag", "active", "last_status", *[f"bought_{t}" for t in _TYPES], "segment",
    "last_priority",
)


def _boxes(pairs: list[tuple[str, str]], group: str) -> str:
    """Quartiles, fences and outliers of (name, expression) pairs by a grouping column."""
    series = " UNION ALL ".join(
        f"SELECT '{name}' AS \"column\", {group} AS \"group\", CAST({expr} AS DOUBLE) AS x FROM num"
        for name, expr in pairs
    )
    return _with(
        _SNAP,
        _NUM,
        f"series AS (SELECT * FROM ({series}) WHERE x IS NOT NULL)",
        """box AS (
          SELECT "column", "group", count(*) AS n, min(x) AS mn, quantile_cont(x, 0.25) AS q1,
                 quantile_cont(x, 0.5) AS md, quantile_cont(x, 0.75) AS q3, max(x) AS mx
          FROM series GROUP BY 1, 2
        )""",
        """fence AS (
          SELECT *, q1 - 1.5::DOUBLE * (q3 - q1) AS lf, q3 + 1.5::DOUBLE * (q3 - q1) AS hf FROM box
        )""",
        body="""
        SELECT f."column", f."group", f.n,
               round(mn, 4) AS min,
               round(q1, 4) AS q1,
               round(md, 4) AS median,
               round(q3, 4) AS q3,
               round(mx, 4) AS max,
               round(lf, 4) AS low_fence,
               round(hf, 4) AS high_fence,
               count(*) FILTER (s.x < lf OR s.x > hf) AS n_outliers
        FROM fence f JOIN series s ON s."column" = f."column" AND s."group" = f."group"
        GROUP BY ALL""",
    )


_NUMBERS = [("tenure", "tenure"), ("monthly_charges", "monthly_charges"), ("total_charges", "total")]

# --- scored events ---------------------------------------------------------------------

_SCORED = """
scored AS (
  SELECT event_id, CAST(event_type = 'purchase' AS INTEGER) AS y,
         least(value / 500.0::DOUBLE, 1.0::DOUBLE) AS p
  FROM events
)"""

_RATE_SELECT = """
  round(CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp) ELSE 0 END, 6) AS precision,
  round(CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn) ELSE 0 END, 6) AS recall,
  round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp::DOUBLE / (2 * tp + fp + fn) ELSE 0 END, 6)
    AS f1,
  round((tp + tn)::DOUBLE / (tp + tn + fp + fn), 6) AS accuracy,
  round((CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp::DOUBLE / (2 * tp + fp + fn) ELSE 0 END
         + CASE WHEN 2 * tn + fp + fn > 0 THEN 2 * tn::DOUBLE / (2 * tn + fp + fn) ELSE 0 END)
        / (CAST(2 * tp + fp + fn > 0 AS INTEGER) + CAST(2 * tn + fp + fn > 0 AS INTEGER)), 6)
    AS f1_macro"""

_CONF = """
conf AS (
  SELECT count(*) AS n, avg(y) AS rate,
         count(*) FILTER (y = 0 AND p < 0.1::DOUBLE) AS tn,
         count(*) FILTER (y = 0 AND p >= 0.1::DOUBLE) AS fp,
         count(*) FILTER (y = 1 AND p < 0.1::DOUBLE) AS fn,
         count(*) FILTER (y = 1 AND p >= 0.1::DOUBLE) AS tp
  FROM scored
)"""

_SWEEP = """
grid AS (SELECT i / 100.0::DOUBLE AS t FROM range(10, 91) AS g(i)),
sweep AS (
  SELECT t AS threshold,
         count(*) FILTER (y = 1 AND p >= t) AS tp, count(*) FILTER (y = 0 AND p >= t) AS fp,
         count(*) FILTER (y = 1 AND p < t) AS fn, count(*) FILTER (y = 0 AND p < t) AS tn
  FROM grid CROSS JOIN scored GROUP BY t
)"""

_CURVE = """
cells AS (
  SELECT p, sum(y)::BIGINT AS pos, sum(1 - y)::BIGINT AS neg FROM scored GROUP BY p
),
curve AS (
  SELECT p, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
         sum(pos) OVER () AS np, sum(neg) OVER () AS nn
  FROM cells WINDOW w AS (ORDER BY p DESC)
),
pr AS (
  SELECT p, tp::DOUBLE / np AS recall, tp::DOUBLE / (tp + fp) AS prec FROM curve
),
steps AS (
  SELECT recall, prec, lag(recall, 1, 0::DOUBLE) OVER (ORDER BY p DESC) AS r0,
         lag(prec, 1, 1::DOUBLE) OVER (ORDER BY p DESC) AS p0 FROM pr
)"""

_AUC = """
mid AS (
  SELECT y, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0::DOUBLE AS r
  FROM scored
),
auc AS (
  SELECT (sum(r) FILTER (y = 1) - count(*) FILTER (y = 1) * (count(*) FILTER (y = 1) + 1) / 2.0)
         / (count(*) FILTER (y = 1) * count(*) FILTER (y = 0))::DOUBLE AS a FROM mid
)"""

# --- drift -----------------------------------------------------------------------------

_FEATS = """
feats AS (
  SELECT event_id, ts, strftime(ts, '%Y-%m-%d') AS day, value,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
         CAST(hour(ts) AS DOUBLE) AS hour,
         CAST(hour(ts) >= 18 AS INTEGER)::DOUBLE AS evening,
         event_type, 'w' || ((day(ts) - 1) // 7) AS week
  FROM events
),
long_num AS (
  SELECT event_id, ts, day, 'value' AS feature, value AS x FROM feats
  UNION ALL SELECT event_id, ts, day, 'k', k FROM feats
  UNION ALL SELECT event_id, ts, day, 'hour', hour FROM feats
  UNION ALL SELECT event_id, ts, day, 'evening', evening FROM feats
),
long_cat AS (
  SELECT event_id, ts, day, 'event_type' AS feature, event_type AS cat FROM feats
  UNION ALL SELECT event_id, ts, day, 'week', week FROM feats
  UNION ALL SELECT event_id, ts, day, 'evening', CASE WHEN evening = 1 THEN '1.0' ELSE '0.0' END
    FROM feats
)"""


def _reference(compat: bool) -> str:
    """Reference bins and category shares of the events before the cut."""
    keep_num = "" if compat else "AND feature <> 'evening'"
    keep_cat = "AND feature <> 'evening'" if compat else ""
    return f"""
qs AS (
  SELECT feature, unnest(quantile_cont(x, [0,0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9,1])) AS e
  FROM long_num WHERE ts < TIMESTAMP '2024-01-16' {keep_num} GROUP BY feature
),
edges AS (
  SELECT feature, e AS lo, lead(e) OVER (PARTITION BY feature ORDER BY e) AS hi,
         CAST(row_number() OVER (PARTITION BY feature ORDER BY e) - 1 AS INTEGER) AS bin,
         count(*) OVER (PARTITION BY feature) AS n_edges
  FROM (SELECT DISTINCT feature, e FROM qs)
),
bins AS (SELECT * FROM edges WHERE hi IS NOT NULL),
placed AS (
  SELECT l.event_id, l.ts, l.day, l.feature, b.bin
  FROM long_num l JOIN bins b ON b.feature = l.feature AND l.x >= b.lo
   AND (l.x < b.hi OR (b.bin = b.n_edges - 2 AND l.x = b.hi))
),
ref_num AS (
  SELECT b.feature, b.bin, b.lo, b.hi,
         count(p.event_id)::DOUBLE / sum(count(p.event_id)) OVER (PARTITION BY b.feature) AS e
  FROM bins b LEFT JOIN placed p ON p.feature = b.feature AND p.bin = b.bin
   AND p.ts < TIMESTAMP '2024-01-16'
  GROUP BY b.feature, b.bin, b.lo, b.hi
),
ref_cat AS (
  SELECT feature, cat, count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY feature) AS e
  FROM long_cat WHERE ts < TIMESTAMP '2024-01-16' {keep_cat} GROUP BY feature, cat
)"""


def _psi_ctes(group: str, current: str) -> str:
    """PSI per (grp, feature) of the rows that satisfy ``current``; grp is an expression."""
    return f"""
cur_num AS (SELECT {group} AS grp, * FROM long_num WHERE {current}),
cur_cat AS (SELECT {group} AS grp, * FROM long_cat WHERE {current}),
grid_num AS (
  SELECT g.grp, r.feature, r.bin, r.e
  FROM (SELECT DISTINCT grp, feature FROM cur_num) g JOIN ref_num r USING (feature)
),
seen_num AS (
  SELECT {group} AS grp, feature, bin, count(*) AS n FROM placed WHERE {current} GROUP BY ALL
),
pair_num AS (
  SELECT g.grp, g.feature, greatest(g.e, 1e-6::DOUBLE) AS e,
         greatest(coalesce(s.n, 0)::DOUBLE
           / greatest(coalesce(sum(s.n) OVER (PARTITION BY g.grp, g.feature), 0), 1), 1e-6::DOUBLE)
           AS a
  FROM grid_num g LEFT JOIN seen_num s
    ON s.grp = g.grp AND s.feature = g.feature AND s.bin = g.bin
),
seen_cat AS (
  SELECT c.grp, c.feature, coalesce(r.cat, '__other__') AS cat, count(*) AS n
  FROM cur_cat c LEFT JOIN ref_cat r ON r.feature = c.feature AND r.cat = c.cat
  WHERE c.feature IN (SELECT feature FROM ref_cat)
  GROUP BY ALL
),
all_cat AS (
  SELECT feature, cat, e FROM ref_cat
  UNION ALL SELECT DISTINCT feature, '__other__', 0::DOUBLE FROM ref_cat
),
pair_cat AS (
  SELECT g.grp, g.feature, greatest(a.e, 1e-6::DOUBLE) AS e,
         greatest(coalesce(s.n, 0)::DOUBLE, 1e-6::DOUBLE) AS a
  FROM (SELECT DISTINCT grp, feature FROM cur_cat) g JOIN all_cat a USING (feature)
  LEFT JOIN seen_cat s ON s.grp = g.grp AND s.feature = g.feature AND s.cat = a.cat
),
pairs AS (
  SELECT 'numeric' AS kind, * FROM pair_num UNION ALL SELECT 'categorical', * FROM pair_cat
),
normal AS (
  SELECT kind, grp, feature, e / sum(e) OVER w AS e, a / sum(a) OVER w AS a
  FROM pairs WINDOW w AS (PARTITION BY kind, grp, feature)
),
psis AS (
  SELECT kind, grp, feature, sum((a - e) * ln(a / e)) AS psi FROM normal GROUP BY ALL
),
outside AS (
  SELECT c.grp, c.feature, count(*) - count(p.event_id) AS n_out
  FROM cur_num c LEFT JOIN placed p ON p.event_id = c.event_id AND p.feature = c.feature
  GROUP BY ALL
),
result AS (
  SELECT s.grp, s.feature, s.kind, s.psi, round(s.psi, 4) AS psi4,
         CASE WHEN s.psi < 0.1 THEN 'ok' WHEN s.psi < 0.2 THEN 'warning' ELSE 'alert' END
           AS status,
         CASE WHEN s.kind = 'numeric' THEN o.n_out ELSE 0 END::BIGINT AS n_out_of_range
  FROM psis s LEFT JOIN outside o ON o.grp = s.grp AND o.feature = s.feature
)"""


_AFTER = "ts >= TIMESTAMP '2024-01-16'"


def _drift(body: str, compat: bool = False, group: str = "1", current: str = _AFTER) -> str:
    return _with(_FEATS, _reference(compat), _psi_ctes(group, current), body=body)


def _reference_sql(compat: bool) -> str:
    return _with(
        _FEATS,
        _reference(compat),
        body="""
        SELECT feature, 'numeric' AS kind, bin, round(lo, 6) AS lo, round(hi, 6) AS hi,
               NULL::VARCHAR AS category, round(e, 6) AS expected FROM ref_num
        UNION ALL
        SELECT feature, 'categorical', NULL, NULL, NULL, cat, round(e, 6) FROM ref_cat""",
    )


# --- quota: windows followed one by one from the first event of each key ------------------


def _quota(key: str, seconds: int, limit: int) -> str:
    us = seconds * 1_000_000
    return f"""
WITH RECURSIVE ev AS (
  SELECT CAST({key} AS VARCHAR) AS key, event_id, epoch_us(ts) AS us FROM events
),
nxt AS (
  SELECT DISTINCT key, us,
         min(us) OVER (PARTITION BY key ORDER BY us
                       RANGE BETWEEN {us} FOLLOWING AND UNBOUNDED FOLLOWING) AS after
  FROM ev
),
starts AS (
  SELECT key, min(us) AS us FROM ev GROUP BY key
  UNION ALL
  SELECT n.key, n.after FROM starts s JOIN nxt n ON n.key = s.key AND n.us = s.us
  WHERE n.after IS NOT NULL
),
placed AS (
  SELECT e.key, e.event_id, e.us, s.us AS ws
  FROM ev e ASOF JOIN starts s ON e.key = s.key AND e.us >= s.us
),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY key, ws ORDER BY us, event_id) AS n FROM placed
)
SELECT key, event_id, us AS ts_us, ws AS window_start_us, n AS n_in_window, n <= {limit} AS allowed
FROM numbered""".strip()


_LOG = """
logged AS (
  SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' AS ts,
         CASE WHEN event_id % 2 = 0 THEN 'r-' ELSE 'q-' END || event_id AS request_id,
         CASE WHEN user_id % 50 = 0 THEN NULL
              ELSE substr(sha256(CAST(user_id AS VARCHAR)), 1, 16) END AS customer_id_hash,
         event_type,
         CASE WHEN event_id % 10 = 3 THEN NULL
              ELSE CAST(CAST(value AS DECIMAL(12,2)) AS DOUBLE) END AS amount,
         round(least(value / 500.0::DOUBLE, 1.0::DOUBLE), 6) AS churn_probability,
         CASE WHEN least(value / 500.0::DOUBLE, 1.0::DOUBLE) >= 0.1::DOUBLE THEN 'Yes' ELSE 'No' END
           AS prediction,
         'v1' AS model_version
  FROM events
)"""


def _scaled(name: str, expr: str) -> tuple[str, str]:
    """Moments of one column on the training rows, and its scaled expression."""
    cte = (
        f"m_{name} AS (SELECT quantile_cont({expr}, 0.5) AS med FROM tr), "
        f"s_{name} AS (SELECT avg(coalesce({expr}, med)) AS mu, "
        f"stddev_pop(coalesce({expr}, med)) AS sd, max(med) AS med FROM tr, m_{name})"
    )
    scaled = (
        f"round((coalesce({expr}, s_{name}.med) - s_{name}.mu) / s_{name}.sd, 6) AS {name}_scaled"
    )
    return cte, scaled


_SCALED = [
    _scaled(n, e)
    for n, e in (
        ("tenure", "tenure::DOUBLE"),
        ("monthly_charges", "monthly_charges"),
        ("total_charges", "total"),
        ("avg_monthly_charges", "total / (tenure + 1)::DOUBLE"),
    )
]

_SCREEN = [
    ("tenure", "tenure::DOUBLE"),
    ("monthly_charges", "monthly_charges"),
    ("total_charges", "coalesce(total, 0)"),
    ("urgent_flag", "urgent_flag::DOUBLE"),
    ("sign_flag", "(sign_flag = 'Neg')::INTEGER::DOUBLE"),
    ("active", "(active = 'No')::INTEGER::DOUBLE"),
    *[(f"bought_{t}", f"(bought_{t} = 'No')::INTEGER::DOUBLE") for t in _TYPES],
]

_CORR = [
    ("tenure", "tenure"),
    ("monthly_charges", "monthly_charges"),
    ("total_charges", "total"),
    ("urgent_flag", "urgent_flag"),
    ("label", "label"),
]

ORACLES: dict[str, str] = {
    "churn_by_tenure_group": _snap(
        f"""SELECT {_GROUP} AS tenure_group, count(*) AS n,
            round(avg(CAST(churn = 'Yes' AS INTEGER)), 6) AS rate FROM snap GROUP BY 1"""
    ),
    "snapshot": _snap(f"SELECT {_COLUMNS} FROM snap"),
    "csv_roundtrip": _snap(f"SELECT {_COLUMNS} FROM snap"),
    "clean_snapshot": _snap(
        f"""SELECT {_COLUMNS.replace('total_charges', 'total AS total_charges')} FROM num""", _NUM
    ),
    "engineered_features": _snap(
        f"""SELECT account_id, {_GROUP} AS tenure_group,
            CAST({" + ".join(f"(bought_{t} = 'Yes')::INTEGER" for t in _TYPES)}
              + (active = 'Yes')::INTEGER + (last_status <> 'No')::INTEGER AS BIGINT)
              AS service_count,
            total / (tenure + 1)::DOUBLE AS avg_monthly_charges,
            CAST(last_status <> 'No' AND bought_economy <> 'Yes' AND bought_promo <> 'Yes'
              AS BIGINT) AS no_security_support
            FROM num""",
        _NUM,
    ),
    "feature_label_frame": _snap(
        f"""SELECT {_COLUMNS.replace(', churn', '')}, CAST(churn = 'Yes' AS INTEGER) AS label
            FROM snap"""
    ),
    "contract_violations": _snap('SELECT account_id, "column", rule, value FROM report', _BAD),
    "contract_summary": _snap(
        'SELECT "column", rule, count(*) AS n FROM report GROUP BY ALL', _BAD
    ),
    "top_violations": _snap(
        'SELECT account_id, "column", rule, value FROM report ORDER BY 1, 2, 3 LIMIT 20', _BAD
    ),
    "quarantine_rows": _snap(
        """SELECT account_id, error = '' AS ok, nullif(error, '') AS error FROM (
             SELECT account_id, concat_ws('; ',
               CASE WHEN tenure NOT BETWEEN 0 AND 120 THEN 'tenure: in_range' END,
               CASE WHEN monthly_charges NOT BETWEEN 0 AND 10000000
                 THEN 'monthly_charges: in_range' END,
               CASE WHEN last_priority IS NULL THEN 'last_priority: not_null' END) AS error
             FROM twice)""",
        _BAD,
    ),
    "accepted_rows": _snap(
        """SELECT segment, count(*) AS n FROM twice
           WHERE segment <> 'Unknown' AND tenure BETWEEN 0 AND 72 AND total_charges <> 'abc'
             AND monthly_charges BETWEEN 0 AND 1000000 AND last_priority IS NOT NULL
             AND churn IS NOT NULL GROUP BY segment""",
        _BAD,
    ),
    "request_items": _snap(
        """SELECT batch_id, CAST(i - 1 AS INTEGER) AS "index",
           CAST(account_id AS VARCHAR) AS customer_id, error = '' AS ok, error, extra_keys
           FROM sent WHERE batch_error = ''""",
        _BAD,
        _SENT,
    ),
    "batch_cap": _snap(
        """SELECT batch_id, CAST(count(*) AS INTEGER) AS n_items, min(batch_error) AS batch_error
           FROM sent GROUP BY 1""",
        _BAD,
        _SENT,
    ),
    "stream_request_verdicts": _snap(
        """SELECT concat_ws('; ', nullif(batch_error, ''), nullif(error, ''),
             CASE WHEN extra_keys <> '' THEN 'extra keys: ' || extra_keys END) AS error,
           count(*) AS n, count(DISTINCT account_id) AS n_clients,
           count(DISTINCT batch_id) AS n_requests,
           count(*) FILTER (batch_error = '' AND error = '' AND extra_keys = '') AS n_timed
           FROM sent GROUP BY 1""",
        _BAD,
        _SENT,
    ),
    "edge_extra_keys": """SELECT event_type, 'k' AS extra_key, count(*) AS n FROM events
        WHERE json_extract_string(props, '$.k') IS NOT NULL GROUP BY 1""",
    "duplicate_keys": """SELECT user_id, count(*) AS n FROM events GROUP BY user_id
        HAVING count(*) > 1""",
    "duplicate_key_count": _snap(
        """SELECT CAST(count(*) - count(DISTINCT account_id) AS BIGINT) AS n_duplicates,
           count(*) AS n_rows FROM twice""",
        _BAD,
    ),
    "duplicate_rows": """SELECT count(*) - count(DISTINCT text) AS n_duplicates,
        count(*) AS n_rows FROM documents""",
    "duplicate_snapshot_rows": _snap(
        """SELECT CAST((SELECT count(*) FROM twice)
             - (SELECT count(*) FROM (SELECT DISTINCT * FROM twice)) AS BIGINT) AS n_duplicates,
           (SELECT count(*) FROM twice) AS n_rows""",
        _BAD,
    ),
    "null_profile": _snap(
        """SELECT 'last_priority' AS "column", count(*) AS n_null FROM twice
             WHERE last_priority IS NULL
           UNION ALL SELECT 'churn', count(*) FROM twice WHERE churn IS NULL""",
        _BAD,
    ),
    "table_facts": _snap(
        """SELECT count(*) AS n_rows, 17 AS n_columns,
           count(*) FILTER (total IS NULL) AS n_blank_total,
           count(*) FILTER (tenure = 0) AS n_zero_tenure FROM num""",
        _NUM,
    ),
    "cardinality": _snap(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct FROM snap"
            for c in (*_CATEGORICAL, "churn")
        )
    ),
    "value_counts": _snap(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", {c} AS value, count(*) AS n,
                round(count(*)::DOUBLE / sum(count(*)) OVER (), 6) AS share FROM snap GROUP BY 2"""
            for c in _CATEGORICAL
        )
    ),
    "class_balance": _snap(
        """SELECT count(*) FILTER (label = 1) AS n_positive,
           count(*) FILTER (label = 0) AS n_negative, round(avg(label), 6) AS positive_rate,
           round(count(*) FILTER (label = 0)::DOUBLE / greatest(count(*) FILTER (label = 1), 1), 2)
             AS imbalance_ratio FROM num""",
        _NUM,
    ),
    "rate_by_tenure": _snap(
        "SELECT tenure, count(*) AS n, round(avg(label), 6) AS rate FROM num GROUP BY tenure", _NUM
    ),
    "rate_by_group": _snap(
        'SELECT "column", value, n, round(rate, 6) AS rate FROM rates', _RATES
    ),
    "top2_rate_per_column": _snap(
        """SELECT "column", value, n, round(rate, 6) AS rate, CAST(rn AS INTEGER) AS rank FROM (
             SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY rate DESC, value) AS rn
             FROM rates) WHERE rn <= 2""",
        _RATES,
    ),
    "five_number_by_class": _boxes(_NUMBERS, "churn"),
    "five_number_by_service": _boxes([_NUMBERS[1]], "last_status"),
    "corr_matrix": _snap(
        " UNION ALL ".join(
            f"SELECT '{a}' AS a, '{b}' AS b, round(corr({ea}, {eb}), 6) AS r FROM num"
            for i, (a, ea) in enumerate(_CORR)
            for b, eb in _CORR[i + 1 :]
        ),
        _NUM,
    ),
    "redundancy_check": _snap(
        """SELECT count(*) AS n, round(corr(total, tenure * monthly_charges), 6) AS r,
           round(avg(CASE WHEN total <> 0
             THEN abs(total - tenure * monthly_charges) / abs(total) END), 4) AS mean_relative_gap
           FROM num WHERE total IS NOT NULL""",
        _NUM,
    ),
    "stratified_split": _snap("SELECT account_id, split FROM split", _RANKED),
    "split_balance": _snap(
        """SELECT split, count(*) AS n, round(avg(CAST(churn = 'Yes' AS INTEGER)), 6)
           AS positive_rate FROM split GROUP BY split""",
        _RANKED,
    ),
    "split_disjoint": _snap(
        """SELECT count(*) AS n_overlapping FROM (
             SELECT account_id FROM (
               SELECT account_id, split FROM split
               UNION ALL SELECT account_id, 'test' FROM split WHERE account_id % 83 = 9)
             GROUP BY account_id HAVING count(DISTINCT split) > 1)""",
        _RANKED,
    ),
    "split_membership": _snap(
        "SELECT split, segment, count(*) AS n FROM split GROUP BY ALL", _RANKED
    ),
    "hash_split": """WITH h AS (
          SELECT c_custkey AS account_id,
            ('0x' || substr(md5('42:' || c_custkey), 1, 8))::BIGINT % 1000000 AS h FROM customer)
        SELECT account_id, CASE WHEN h < 150000 THEN 'test' WHEN h < 300025 THEN 'validation'
          ELSE 'train' END AS split FROM h""",
    "kfold_assignment": _snap(
        "SELECT account_id, CAST(r % 5 AS INTEGER) AS fold FROM ranked", _RANKED
    ),
    "seeded_sample": _snap(
        """SELECT account_id, churn FROM snap
           ORDER BY md5('42:' || account_id), account_id LIMIT 1000"""
    ),
    "class_weights": _snap(
        """SELECT churn, count(*) AS n,
           round((SELECT count(*) FROM snap)::DOUBLE
             / ((SELECT count(DISTINCT churn) FROM snap) * count(*)), 6) AS weight
           FROM snap GROUP BY churn"""
    ),
    "majority_baseline": _snap(
        """SELECT CAST(m AS INTEGER) AS majority, n,
           round(CASE WHEN m = 1 THEN pos::DOUBLE / n ELSE 0 END, 6) AS precision,
           round(CASE WHEN m = 1 THEN 1 ELSE 0 END::DOUBLE, 6) AS recall,
           round(CASE WHEN m = 1 THEN 2 * pos::DOUBLE / (n + pos) ELSE 0 END, 6) AS f1,
           0.5::DOUBLE AS roc_auc
           FROM (SELECT CAST(churn = 'Yes' AS INTEGER) AS m FROM split WHERE split = 'train'
                 GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
                (SELECT count(*) AS n, count(*) FILTER (churn = 'Yes') AS pos
                 FROM split WHERE split = 'test')""",
        _RANKED,
    ),
    "confusion_metrics": _with(
        _SCORED,
        _CONF,
        body=f"SELECT n, tn, fp, fn, tp, round(rate, 6) AS positive_rate, {_RATE_SELECT} FROM conf",
    ),
    "brier": _with(_SCORED, body="SELECT round(avg((p - y) * (p - y)), 6) AS brier FROM scored"),
    "threshold_sweep": _with(
        _SCORED, _SWEEP, body=f"SELECT threshold, tp, fp, fn, tn, {_RATE_SELECT} FROM sweep"
    ),
    "best_threshold": _with(
        _SCORED,
        _SWEEP,
        body="""SELECT threshold, round(2 * tp::DOUBLE / (2 * tp + fp + fn), 6) AS f1 FROM sweep
                ORDER BY 2 * tp::DOUBLE / (2 * tp + fp + fn) DESC, threshold LIMIT 1""",
    ),
    "roc_auc": _with(_SCORED, _AUC, body="SELECT round(a, 6) AS roc_auc FROM auc"),
    "pr_auc": _with(
        _SCORED,
        _CURVE,
        body="SELECT round(sum((recall - r0) * (prec + p0) / 2), 6) AS pr_auc FROM steps",
    ),
    "roc_points": _with(
        _SCORED,
        _CURVE,
        body="""SELECT round(p, 6) AS threshold, round(fp::DOUBLE / nn, 6) AS fpr,
                round(tp::DOUBLE / np, 6) AS tpr FROM curve
                UNION ALL SELECT NULL, 0.0::DOUBLE, 0.0::DOUBLE""",
    ),
    "pr_points": _with(
        _SCORED,
        _CURVE,
        body="""SELECT round(p, 6) AS threshold, round(prec, 6) AS precision,
                round(recall, 6) AS recall FROM pr
                UNION ALL SELECT NULL, 1.0::DOUBLE, 0.0::DOUBLE""",
    ),
    "calibration": _with(
        _SCORED,
        """edges AS (SELECT quantile_cont(p, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9]) AS e
           FROM scored)""",
        body="""SELECT CAST(len(list_filter(e, lambda x: x < p)) AS INTEGER) AS bin, count(*) AS n,
                round(avg(p), 6) AS mean_score, round(avg(y), 6) AS fraction_positive
                FROM scored, edges GROUP BY 1""",
    ),
    "score_histogram": _with(
        _SCORED,
        "rng AS (SELECT y, min(p) AS lo, (max(p) - min(p)) / 40 AS w, count(*) AS nc "
        "FROM scored GROUP BY y)",
        """hit AS (SELECT s.y, CAST(least(floor((p - lo) / w), 39) AS INTEGER) AS bin,
             count(*) AS n FROM scored s JOIN rng r ON r.y = s.y GROUP BY 1, 2)""",
        body="""SELECT rng.y, CAST(b.bin AS INTEGER) AS bin, round(lo + b.bin * w, 9) AS left_edge,
                coalesce(n, 0) AS n, round(coalesce(n, 0) / (nc * w), 6) AS density
                FROM rng CROSS JOIN range(40) AS b(bin)
                LEFT JOIN hit ON hit.y = rng.y AND hit.bin = b.bin""",
    ),
    "metric_record": _with(
        _SCORED,
        _CONF,
        _CURVE,
        _AUC,
        body=f"""SELECT 0.1::DOUBLE AS threshold, n AS n_samples, round(rate, 6) AS positive_rate,
                 {_RATE_SELECT}, round(a, 6) AS roc_auc,
                 (SELECT round(sum((recall - r0) * (prec + p0) / 2), 6) FROM steps) AS pr_auc,
                 (SELECT round(avg((p - y) * (p - y)), 6) FROM scored) AS brier, tn, fp, fn, tp
                 FROM conf, auc""",
    ),
    "fairness_slices": _snap(
        """SELECT attribute, "group", count(*) AS n, round(avg(label), 4) AS churn_rate,
           round(avg(hit) FILTER (label = 1), 4) AS tpr, round(avg(hit) FILTER (label = 0), 4) AS fpr
           FROM (
             SELECT 'sign_flag' AS attribute, sign_flag AS "group", label, hit FROM h
             UNION ALL SELECT 'urgent_flag', CAST(urgent_flag AS VARCHAR), label, hit FROM h)
           GROUP BY ALL""",
        _NUM,
        """h AS (SELECT *, CAST(1.0::DOUBLE - tenure / 80.0::DOUBLE >= 0.25::DOUBLE AS INTEGER)
             AS hit FROM num)""",
    ),
    "feature_auc_screen": _snap(
        """SELECT feature, round(greatest(a, 1 - a), 4) AS auc,
           CASE WHEN greatest(a, 1 - a) >= 0.97 THEN 'investigate'
                WHEN greatest(a, 1 - a) >= 0.9 THEN 'review' ELSE '' END AS flag
           FROM (SELECT feature,
             (sum(r) FILTER (y = 1) - count(*) FILTER (y = 1) * (count(*) FILTER (y = 1) + 1) / 2.0)
             / (count(*) FILTER (y = 1) * count(*) FILTER (y = 0))::DOUBLE AS a
             FROM mid GROUP BY feature)""",
        _NUM,
        "sc AS ("
        + " UNION ALL ".join(
            f"SELECT '{f}' AS feature, {e} AS x, label AS y FROM num" for f, e in _SCREEN
        )
        + ")",
        """mid AS (SELECT feature, y, rank() OVER (PARTITION BY feature ORDER BY x)
             + (count(*) OVER (PARTITION BY feature, x) - 1) / 2.0::DOUBLE AS r FROM sc)""",
    ),
    "reference_stats": _reference_sql(False),
    "reference_stats_compat": _reference_sql(True),
    "psi_numeric": _drift(
        """SELECT feature, round(psi, 6) AS psi, n_out_of_range FROM result
           WHERE kind = 'numeric'""",
        compat=True,
    ),
    "psi_categorical": _drift(
        """SELECT feature, round(psi, 6) AS psi FROM result
           WHERE kind = 'categorical' AND feature <> 'evening'"""
    ),
    "drift_report": _drift(
        "SELECT feature, kind, psi4 AS psi, status, n_out_of_range FROM result"
    ),
    "drift_summary": _drift(
        """SELECT count(*) AS features_checked, max(psi4) AS worst_psi,
           count(*) FILTER (status = 'ok') AS n_ok,
           count(*) FILTER (status = 'warning') AS n_warning,
           count(*) FILTER (status = 'alert') AS n_alert,
           count(*) FILTER (status = 'alert') > 0 AS has_alert FROM result"""
    ),
    "drift_top_features": _drift(
        "SELECT feature, psi4 AS psi FROM result ORDER BY psi4 DESC, feature LIMIT 3"
    ),
    "retrain_trigger": _drift(
        """SELECT count(*) FILTER (status = 'alert') AS n_alert,
           count(*) FILTER (status = 'alert') >= 3 AS retrain FROM result"""
    ),
    "drift_by_window": _drift(
        "SELECT grp AS day, feature, kind, psi4 AS psi, status, n_out_of_range FROM result",
        group="day",
    ),
    "drift_recent_records": _drift(
        """SELECT CAST(least(500, (SELECT count(*) FROM events)) AS BIGINT) AS n_records, (SELECT count(*) FROM result) AS features_checked,
           (SELECT max(psi4) FROM result) AS worst_psi,
           (SELECT count(*) FILTER (status = 'alert') FROM result) AS n_alert,
           feature, psi4 AS psi, status FROM result""",
        current="event_id IN (SELECT event_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 500)",
    ),
    "stream_tail_drift": _drift(
        "SELECT feature, psi4 AS psi, status FROM result",
        current="event_id IN (SELECT event_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 500)",
    ),
    "pseudonymised_log": _with(_LOG, body="SELECT * FROM logged"),
    "recent_log": _with(
        _LOG,
        body="SELECT ts, request_id FROM logged ORDER BY ts DESC, request_id DESC LIMIT 500",
    ),
    "client_keys": """SELECT CASE WHEN event_id % 3 = 0 THEN '10.0.0.' || (user_id % 7)
          WHEN event_id % 3 = 1 THEN 'host-' || (user_id % 5) ELSE 'unknown' END AS client,
        count(*) AS n FROM events GROUP BY 1""",
    "quota_flags_by_user": _quota("user_id", 86_400, 2),
    "quota_flags_by_type": _quota("event_type", 3600, 5),
    "table_digests": """WITH h AS (
          SELECT event_type, md5(concat_ws(',', length(event_id::VARCHAR) || ':' || event_id,
            coalesce(length(user_id::VARCHAR) || ':' || user_id, '-'),
            coalesce(length(props::VARCHAR) || ':' || props, '-'))) AS r FROM events),
        s AS (SELECT event_type, count(*) AS n_rows,
                sum(('0x' || substr(r, 1, 15))::BIGINT::HUGEINT) AS s0,
                sum(('0x' || substr(r, 16, 15))::BIGINT::HUGEINT) AS s1 FROM h GROUP BY 1)
        SELECT event_type, n_rows, sha256(concat_ws(':', n_rows, s0, s1)) AS digest FROM s""",
    "request_rollup_daily": """SELECT strftime(ts, '%Y-%m-%d') AS window_start,
        event_type AS path, count(*) AS n,
        round(count(*) FILTER (value > 100)::DOUBLE / count(*), 6) AS error_share,
        quantile_disc(value, 0.5) AS latency_p50, quantile_disc(value, 0.95) AS latency_p95
        FROM events GROUP BY 1, 2""",
    "impute_scale": _snap(
        "SELECT num.account_id, "
        + ", ".join(s for _, s in _SCALED)
        + " FROM num, s_tenure, s_monthly_charges, s_total_charges, s_avg_monthly_charges",
        _NUM,
        _RANKED,
        "tr AS (SELECT num.* FROM num JOIN split USING (account_id) WHERE split = 'train')",
        *[c for c, _ in _SCALED],
    ),
    "one_hot_slots": _snap(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", CAST(k.slot AS INTEGER) AS slot, count(*) AS n,
                k.v AS category
                FROM snap JOIN (
                  SELECT v, dense_rank() OVER (ORDER BY v) - 1 AS slot FROM (
                    SELECT DISTINCT snap.{c} AS v FROM snap JOIN split USING (account_id)
                    WHERE split = 'train')) k ON k.v = snap.{c} GROUP BY ALL"""
            for c in ("last_status", "segment", "last_priority")
        ),
        _RANKED,
    ),
    "stream_quota": _quota("user_id", 86_400, 2),
    "stream_drift": _drift(
        """SELECT grp AS day, feature, psi4 AS psi, status,
             CAST(grp AS TIMESTAMP) + INTERVAL 1 DAY
               > (SELECT max(ts) - INTERVAL 1 HOUR FROM events) AS provisional
           FROM result""",
        group="day",
        current="true",
    ),
}
