"""Independent DuckDB SQL for every registered query (the correctness oracle).

Each string is self-contained: a chain of CTEs derives the raw transactions
from the ``events`` view, cleans, masks and builds the star on natural keys,
then runs the query. Only views pre-registered by the checker are read.
"""

from __future__ import annotations

from .schemas import MERCHANT_CATEGORIES, REGIONS, TRANSACTION_TYPES

TEST_SALT = "salt"


def _sql_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


_REGIONS = _sql_list(REGIONS)
_CATEGORIES = _sql_list(MERCHANT_CATEGORIES)


def _region(col: str) -> str:
    return f"list_element({_REGIONS}, (('0x' || substr({col}, 1, 4))::INTEGER % 6) + 1)"


def _category(col: str) -> str:
    return f"list_element({_CATEGORIES}, (('0x' || substr({col}, 5, 4))::INTEGER % 8) + 1)"


def _mask(col: str, salt: str = TEST_SALT) -> str:
    return f"substr(sha256('{salt}' || {col}), 1, 32)"


_TYPES_VALUES = ", ".join(
    f"({i}, '{c}', '{ch}', '{d}')" for i, (c, ch, d) in enumerate(TRANSACTION_TYPES, start=1))

# -- raw rows mapped from events (with event_id) --------------------------------
RAW_BASE = """
raw_map AS (
    SELECT
        event_id,
        CAST(1 + date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) * 24 + hour(ts) AS INTEGER) AS step,
        CASE event_type WHEN 'click' THEN 'CASH_OUT' WHEN 'view' THEN 'CASH_IN'
             WHEN 'signup' THEN 'DEBIT' WHEN 'purchase' THEN 'PAYMENT'
             WHEN 'error' THEN 'TRANSFER' END AS type,
        CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS amount,
        value AS _value,
        CAST(user_id AS DOUBLE) AS _uid,
        'C' || CAST(user_id AS VARCHAR) AS nameOrig,
        CASE WHEN event_type = 'purchase' THEN 'M' ELSE 'C' END AS _prefix,
        json_extract_string(props, '$.k') AS _k
    FROM events
),
raw_flags AS (
    SELECT *,
        (type IN ('TRANSFER', 'CASH_OUT') AND event_id % 97 = 0) AS _fraud,
        (type = 'PAYMENT') AS _payment,
        CAST(_k AS DOUBLE) AS _kd
    FROM raw_map
),
raw_base AS (
    SELECT
        event_id, step, type, amount, nameOrig,
        CASE WHEN _fraud THEN 0.0 ELSE _uid END AS oldbalanceOrg,
        CASE WHEN _fraud OR _uid < amount THEN 0.0 ELSE _uid - amount END AS newbalanceOrig,
        _prefix || _k AS nameDest,
        CASE WHEN _fraud OR _payment THEN 0.0 ELSE _kd END AS oldbalanceDest,
        CASE WHEN _fraud OR _payment THEN 0.0 ELSE _kd + amount END AS newbalanceDest,
        CAST(_fraud AS INTEGER) AS isFraud,
        CAST(type = 'TRANSFER' AND _value > 200.0 AS INTEGER) AS isFlaggedFraud
    FROM raw_flags
)"""

RAW_DIRTY = RAW_BASE + """,
raw_dirty1 AS (
    SELECT
        event_id,
        CASE WHEN event_id % 89 = 5 THEN step + 744 ELSE step END AS step,
        CASE WHEN event_id % 10 = 3 THEN
                 CASE WHEN type IN ('CASH_IN', 'CASH_OUT') THEN replace(type, '_', '-') ELSE type END
             WHEN event_id % 101 = 7 THEN 'UNKNOWN' ELSE type END AS type,
        CASE WHEN event_id % 71 = 2 THEN -amount
             WHEN event_id % 73 = 2 THEN NULL ELSE amount END AS amount,
        CASE WHEN event_id % 79 = 1 THEN NULL
             WHEN event_id % 83 = 1 THEN '  '
             WHEN event_id % 61 = 1 THEN nameOrig || ' ' ELSE nameOrig END AS nameOrig,
        oldbalanceOrg, newbalanceOrig,
        CASE WHEN event_id % 67 = 1 THEN '' ELSE nameDest END AS nameDest,
        oldbalanceDest, newbalanceDest, isFraud, isFlaggedFraud
    FROM raw_base
),
raw AS (
    SELECT step, type, amount, nameOrig, oldbalanceOrg, newbalanceOrig, nameDest,
           oldbalanceDest, newbalanceDest, isFraud, isFlaggedFraud FROM raw_dirty1
    UNION ALL
    SELECT step, type, amount, nameOrig, oldbalanceOrg, newbalanceOrig, nameDest,
           oldbalanceDest, newbalanceDest, isFraud, isFlaggedFraud FROM raw_dirty1
    WHERE event_id % 50 = 0
)"""

_RAW_COLS = ("step, type, amount, nameOrig, oldbalanceOrg, newbalanceOrig, nameDest, "
             "oldbalanceDest, newbalanceDest, isFraud, isFlaggedFraud")

# -- clean: normalise type, the five row rules, full-row dedup ------------------
CLEAN = RAW_DIRTY + f""",
raw_norm AS (
    SELECT step, replace(upper(type), '-', '_') AS type, amount, nameOrig, oldbalanceOrg,
           newbalanceOrig, nameDest, oldbalanceDest, newbalanceDest, isFraud, isFlaggedFraud
    FROM raw
),
clean AS (
    SELECT DISTINCT {_RAW_COLS}
    FROM raw_norm
    WHERE nameOrig IS NOT NULL AND trim(nameOrig) <> ''
      AND nameDest IS NOT NULL AND trim(nameDest) <> ''
      AND amount IS NOT NULL AND amount >= 0 AND NOT isnan(amount)
      AND step BETWEEN 1 AND 744
      AND type IN ('PAYMENT', 'TRANSFER', 'CASH_OUT', 'CASH_IN', 'DEBIT')
)"""

# -- enrich: masks, destination class, time keys ---------------------------------
ENRICH = CLEAN + f""",
txn AS (
    SELECT *,
        CAST(year(full_timestamp) * 1000000 + month(full_timestamp) * 10000
             + day(full_timestamp) * 100 + hour(full_timestamp) AS BIGINT) AS date_key,
        CAST(full_timestamp AS DATE) AS calendar_date,
        CAST(hour(full_timestamp) AS INTEGER) AS hour_of_day
    FROM (
        SELECT
            step, type AS type_code, amount, oldbalanceOrg, newbalanceOrig,
            oldbalanceDest, newbalanceDest, isFraud, isFlaggedFraud,
            {_mask('nameOrig')} AS orig_account_id,
            {_mask('nameDest')} AS dest_id_masked,
            starts_with(nameDest, 'M') AS dest_is_merchant,
            TIMESTAMP '2024-01-01 00:00:00' + to_hours(step - 1) AS full_timestamp
        FROM clean
    )
)"""

# -- star on natural keys ---------------------------------------------------------
STAR = ENRICH + f""",
dim_account AS (
    SELECT account_id, {_region('account_id')} AS region, 'ACTIVE' AS account_status
    FROM (
        SELECT orig_account_id AS account_id FROM txn
        UNION
        SELECT dest_id_masked FROM txn WHERE NOT dest_is_merchant
    )
),
dim_merchant AS (
    SELECT merchant_id, {_category('merchant_id')} AS merchant_category,
           {_region('merchant_id')} AS region
    FROM (SELECT DISTINCT dest_id_masked AS merchant_id FROM txn WHERE dest_is_merchant)
),
dim_date AS (
    SELECT date_key, full_timestamp, step, calendar_date, hour_of_day,
        CAST(isodow(full_timestamp) AS INTEGER) AS day_of_week,
        dayname(full_timestamp) AS day_name,
        CAST(ceil(day(full_timestamp) / 7.0) AS INTEGER) AS week_of_month,
        CAST(month(full_timestamp) AS INTEGER) AS month_number,
        monthname(full_timestamp) AS month_name,
        CAST(quarter(full_timestamp) AS INTEGER) AS quarter,
        CAST(year(full_timestamp) AS INTEGER) AS year,
        isodow(full_timestamp) IN (6, 7) AS is_weekend
    FROM (SELECT DISTINCT date_key, full_timestamp, step, calendar_date, hour_of_day FROM txn)
),
dim_transaction_type AS (
    SELECT * FROM (VALUES {_TYPES_VALUES})
        AS t(transaction_type_key, type_code, channel_category, description)
),
fact_staging AS (
    SELECT
        orig_account_id,
        CASE WHEN NOT dest_is_merchant THEN dest_id_masked END AS dest_account_id,
        CASE WHEN dest_is_merchant THEN dest_id_masked END AS dest_merchant_id,
        date_key,
        calendar_date AS partition_date,
        type_code,
        amount,
        oldbalanceOrg AS balance_before_orig,
        newbalanceOrig AS balance_after_orig,
        oldbalanceDest AS balance_before_dest,
        newbalanceDest AS balance_after_dest,
        isFraud = 1 AS is_fraud,
        isFlaggedFraud = 1 AS is_flagged_by_system,
        step AS source_step
    FROM txn
),
fact AS (
    SELECT
        orig_account_id, dest_account_id, dest_merchant_id, date_key, partition_date, type_code,
        CAST(amount AS DECIMAL(18,2)) AS amount,
        CAST(balance_before_orig AS DECIMAL(18,2)) AS balance_before_orig,
        CAST(balance_after_orig AS DECIMAL(18,2)) AS balance_after_orig,
        CAST(balance_before_dest AS DECIMAL(18,2)) AS balance_before_dest,
        CAST(balance_after_dest AS DECIMAL(18,2)) AS balance_after_dest,
        is_fraud, is_flagged_by_system, source_step
    FROM fact_staging
)"""


def with_star(body: str) -> str:
    return "WITH " + STAR.strip() + "\n" + body


def with_clean(body: str) -> str:
    return "WITH " + CLEAN.strip() + "\n" + body


def with_raw(body: str) -> str:
    return "WITH " + RAW_DIRTY.strip() + "\n" + body


def with_enrich(body: str) -> str:
    return "WITH " + ENRICH.strip() + "\n" + body


def half_up_avg(sum_expr: str, n_expr: str, scale: int = 2) -> str:
    """Half-up mean of a DECIMAL(.,2) sum over a count, exact in integers."""
    f = 10 ** scale
    # value = sum*f / n rounded half up; sum*100 is an integer number of cents
    num = f"CAST(round(({sum_expr}) * 100) AS HUGEINT) * {f}"
    den = f"(CAST({n_expr} AS HUGEINT) * 100)"
    return f"CAST((2 * {num} + {den}) // (2 * {den}) AS DOUBLE) / {f}"


# ---------------------------------------------------------------------------
# The eighteen analytical queries, on natural keys
# ---------------------------------------------------------------------------
def _pct(num: str, den: str, scale: int) -> str:
    return f"CAST(round(100.0 * ({num}) / NULLIF({den}, 0), {scale}) AS DOUBLE)"


def _r2(x: str, scale: int = 2) -> str:
    return f"CAST(round({x}, {scale}) AS DOUBLE)"


_FD = "fact f JOIN dim_date d ON d.date_key = f.date_key"
_FT = "fact f JOIN dim_transaction_type tt ON tt.type_code = f.type_code"
_FA = "fact f JOIN dim_account a ON a.account_id = f.orig_account_id"

_DAILY = f"""daily AS (
    SELECT d.calendar_date, COUNT(*) AS txn_count, SUM(f.amount) AS value
    FROM {_FD} GROUP BY d.calendar_date
)"""

QUERY_SQL: dict[str, str] = {}

QUERY_SQL["q1_1_daily_change"] = with_star(f""", {_DAILY}
SELECT calendar_date, txn_count, {_r2('value')} AS total_value,
       txn_count - LAG(txn_count) OVER (ORDER BY calendar_date) AS count_change,
       {_pct('txn_count - LAG(txn_count) OVER (ORDER BY calendar_date)',
             'LAG(txn_count) OVER (ORDER BY calendar_date)', 1)} AS count_pct_change
FROM daily ORDER BY calendar_date""")

QUERY_SQL["q1_2_moving_avg"] = with_star(f""", {_DAILY},
framed AS (
    SELECT calendar_date, txn_count,
           SUM(txn_count) OVER (ORDER BY calendar_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS s,
           COUNT(*) OVER (ORDER BY calendar_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS c
    FROM daily
)
SELECT calendar_date, txn_count,
       CAST((20 * CAST(s AS HUGEINT) + c) // (2 * c) AS DOUBLE) / 10 AS moving_avg_7d
FROM framed ORDER BY calendar_date""")

QUERY_SQL["q1_3_type_mix"] = with_star(f""",
g AS (
    SELECT tt.type_code, tt.channel_category, COUNT(*) AS txn_count, SUM(f.amount) AS value
    FROM {_FT} GROUP BY tt.type_code, tt.channel_category
)
SELECT type_code, channel_category, txn_count,
       {_pct('txn_count', 'SUM(txn_count) OVER ()', 1)} AS pct_of_txns,
       {_r2('value')} AS total_value,
       {_pct('value', 'SUM(value) OVER ()', 1)} AS pct_of_value,
       {half_up_avg('value', 'txn_count')} AS avg_txn_value
FROM g ORDER BY total_value DESC""")

QUERY_SQL["x10_same_day_drops"] = with_star(f""",
{_DAILY}
SELECT calendar_date, txn_count, {_r2('value')} AS total_value FROM daily""")

QUERY_SQL["q1_4_hourly"] = with_star(f""",
g AS (
    SELECT d.hour_of_day, COUNT(*) AS txn_count, SUM(f.amount) AS value
    FROM {_FD} GROUP BY d.hour_of_day
)
SELECT hour_of_day, txn_count, {half_up_avg('value', 'txn_count')} AS avg_value,
       CAST(RANK() OVER (ORDER BY txn_count DESC) AS BIGINT) AS busiest_rank
FROM g ORDER BY hour_of_day""")

QUERY_SQL["q1_5_weekend"] = with_star(f""",
g AS (
    SELECT d.is_weekend, COUNT(*) AS txn_count, COUNT(DISTINCT d.calendar_date) AS num_days,
           SUM(f.amount) AS value
    FROM {_FD} GROUP BY d.is_weekend
)
SELECT CASE WHEN is_weekend THEN 'Weekend' ELSE 'Weekday' END AS day_type,
       txn_count, CAST(num_days AS BIGINT) AS num_days,
       CAST((2 * txn_count + num_days) // (2 * num_days) AS DOUBLE) AS avg_txns_per_day,
       {half_up_avg('value', 'txn_count')} AS avg_txn_value
FROM g ORDER BY day_type""")

QUERY_SQL["q2_1_fraud_by_type"] = with_star(f""",
g AS (
    SELECT tt.type_code, COUNT(*) AS total_txns,
           COUNT(*) FILTER (WHERE f.is_fraud) AS fraud_txns,
           SUM(f.amount) FILTER (WHERE f.is_fraud) AS fraud_value
    FROM {_FT} GROUP BY tt.type_code
)
SELECT type_code, total_txns, fraud_txns,
       {_pct('fraud_txns', 'total_txns', 4)} AS fraud_rate_pct,
       {_r2('COALESCE(fraud_value, 0)')} AS fraud_value
FROM g ORDER BY fraud_txns DESC""")

QUERY_SQL["q2_2_fraud_by_hour"] = with_star(f""",
g AS (
    SELECT d.hour_of_day, COUNT(*) AS txns, COUNT(*) FILTER (WHERE f.is_fraud) AS fraud_txns
    FROM {_FD} GROUP BY d.hour_of_day
)
SELECT hour_of_day, txns, fraud_txns,
       {_pct('fraud_txns', 'txns', 4)} AS hourly_fraud_rate,
       {_pct('SUM(fraud_txns) OVER ()', 'SUM(txns) OVER ()', 4)} AS overall_fraud_rate
FROM g ORDER BY hourly_fraud_rate DESC""")


def _pcont(p: str) -> str:
    h = f"(1 + (n - 1) * {p})"
    lo = f"MAX(amount) FILTER (WHERE rn = floor({h}))"
    hi = f"MAX(amount) FILTER (WHERE rn = ceil({h}))"
    return f"{lo} + (MAX({h}) - floor(MAX({h}))) * ({hi} - {lo})"


QUERY_SQL["q2_3_percentiles"] = with_star(f""",
ranked AS (
    SELECT tt.type_code, f.amount,
           ROW_NUMBER() OVER (PARTITION BY tt.type_code ORDER BY f.amount) AS rn,
           COUNT(*) OVER (PARTITION BY tt.type_code) AS n
    FROM {_FT}
),
g AS (
    SELECT type_code, {_pcont('0.5')} AS median, {_pcont('0.9')} AS p90,
           {_pcont('0.99')} AS p99, MAX(amount) AS max_amount
    FROM ranked GROUP BY type_code
)
SELECT type_code, {_r2('median')} AS median, {_r2('p90')} AS p90, {_r2('p99')} AS p99,
       {_r2('max_amount')} AS max_amount
FROM g ORDER BY p99 DESC""")

QUERY_SQL["q2_4_confusion"] = with_star(f""",
g AS (
    SELECT is_fraud, COUNT(*) FILTER (WHERE is_flagged_by_system) AS flagged,
           COUNT(*) FILTER (WHERE NOT is_flagged_by_system) AS not_flagged, COUNT(*) AS total
    FROM fact GROUP BY is_fraud
)
SELECT CASE WHEN is_fraud THEN 'Actual fraud' ELSE 'Legitimate' END AS actual,
       flagged, not_flagged, total, {_pct('flagged', 'total', 2)} AS pct_flagged
FROM g ORDER BY actual""")

#: Facts with the account version that each was resolved to; here one version per account.
_VERSION_FACT = """,
vfact AS (
    SELECT f.*, a.account_id, a.region, a.account_id AS version
    FROM fact f JOIN dim_account a ON a.account_id = f.orig_account_id
)"""


def _tile(place: str, k: int) -> str:
    """Which of k equal shares of n rows the row at ``place`` (from 0) falls in; the first n % k shares hold one more."""
    return f"CAST(CASE WHEN {place} < (n % {k}) * (n // {k} + 1) THEN {place} // (n // {k} + 1) ELSE ({place} - n % {k}) // (n // {k}) END + 1 AS BIGINT)"


_Q2_5 = f""",
g AS (
    SELECT account_id, region,
           COUNT(*) FILTER (WHERE is_fraud) AS fraud_txns,
           SUM(amount) FILTER (WHERE is_fraud) AS fraud_value,
           COUNT(*) AS total_txns
    FROM vfact
    GROUP BY account_id, region
    HAVING COUNT(*) FILTER (WHERE is_fraud) > 0
)
SELECT account_id, region, fraud_txns, {_r2('fraud_value')} AS fraud_value, total_txns,
       CAST(RANK() OVER (ORDER BY fraud_value DESC NULLS LAST) AS BIGINT) AS exposure_rank
FROM g ORDER BY fraud_value DESC NULLS LAST, account_id, region NULLS FIRST LIMIT 20"""

_RFM = f""",
spent AS (
    SELECT account_id, region, MAX(partition_date) AS last_day, COUNT(*) AS times, round(SUM(amount), 2) AS total
    FROM vfact GROUP BY ALL
),
lined_up AS (
    SELECT *, COUNT(*) OVER () AS n,
           ROW_NUMBER() OVER (ORDER BY last_day, account_id, region NULLS FIRST) - 1 AS by_day,
           ROW_NUMBER() OVER (ORDER BY times, account_id, region NULLS FIRST) - 1 AS by_times,
           ROW_NUMBER() OVER (ORDER BY total, account_id, region NULLS FIRST) - 1 AS by_total
    FROM spent
)
SELECT account_id, region, date_diff('day', last_day, (SELECT MAX(calendar_date) FROM dim_date)) AS recency_days,
       times AS frequency, CAST(total AS DOUBLE) AS monetary,
       {_tile('by_day', 5)} AS r_score, {_tile('by_times', 5)} AS f_score, {_tile('by_total', 5)} AS m_score
FROM lined_up"""

_Q3_1 = _RFM + """
ORDER BY total DESC, account_id, region NULLS FIRST LIMIT 25"""

_Q3_2 = f""",
spent AS (SELECT account_id, version, SUM(amount) AS total, COUNT(*) AS times FROM vfact GROUP BY ALL),
lined_up AS (SELECT *, COUNT(*) OVER () AS n, ROW_NUMBER() OVER (ORDER BY total DESC, account_id, version) - 1 AS place FROM spent),
shares AS (SELECT {_tile('place', 10)} AS value_decile, COUNT(*) AS accounts, SUM(total) AS total, SUM(times) AS times FROM lined_up GROUP BY 1)
SELECT value_decile, accounts, {_r2('total')} AS decile_value,
       {_pct('total', '(SELECT SUM(amount) FROM vfact)', 1)} AS pct_of_total_value,
       CAST((20 * CAST(times AS HUGEINT) + accounts) // (2 * accounts) AS DOUBLE) / 10 AS avg_txns_per_account
FROM shares ORDER BY value_decile"""

_Q3_3 = f""",
g AS (
    SELECT region, COUNT(DISTINCT version) AS accounts, COUNT(*) AS txns, SUM(amount) AS value
    FROM vfact GROUP BY region
)
SELECT region, accounts, txns, {_r2('value')} AS total_value,
       {half_up_avg('value', 'accounts')} AS value_per_account,
       {_pct('value', 'SUM(value) OVER ()', 1)} AS pct_of_value
FROM g ORDER BY total_value DESC"""

_Q3_4 = f""",
largest AS (SELECT version, MAX(amount) AS amount FROM vfact GROUP BY version)
SELECT account_id, region, MIN(type_code) AS type_code, {_r2('MAX(largest.amount)')} AS largest_txn
FROM vfact JOIN largest ON vfact.version = largest.version AND vfact.amount = largest.amount
GROUP BY account_id, region, vfact.version
ORDER BY MAX(largest.amount) DESC, account_id, type_code LIMIT 20"""

_Q4_3 = f""",
spent AS (SELECT region, account_id, SUM(amount) AS total, COUNT(*) AS txns FROM vfact GROUP BY ALL),
beaten AS (
    SELECT a.region, a.account_id, a.total, a.txns, COUNT(b.account_id) AS by_others
    FROM spent a LEFT JOIN spent b ON a.region IS NOT DISTINCT FROM b.region AND b.total > a.total
    GROUP BY ALL
)
SELECT region, by_others + 1 AS rank_in_region, account_id, {_r2('total')} AS total_value, txns
FROM beaten WHERE by_others < 3 ORDER BY region, rank_in_region, account_id"""

#: Queries that read account attributes, over any ``vfact``.
ACCOUNT_SQL = {"q2_5_fraud_accounts": _Q2_5, "q3_1_rfm": _Q3_1, "q3_2_deciles": _Q3_2, "q3_3_regions": _Q3_3,
               "q3_4_largest_txn": _Q3_4, "q4_3_top_accounts": _Q4_3}
QUERY_SQL.update({name: with_star(_VERSION_FACT + sql) for name, sql in ACCOUNT_SQL.items()})

QUERY_SQL["q4_1_merchant_spend"] = with_star(f""",
g AS (
    SELECT m.merchant_category, COUNT(*) AS payments, COUNT(DISTINCT m.merchant_id) AS merchants,
           SUM(f.amount) AS value
    FROM fact f JOIN dim_merchant m ON m.merchant_id = f.dest_merchant_id
    GROUP BY m.merchant_category
)
SELECT merchant_category, payments, merchants, {_r2('value')} AS total_spend,
       {half_up_avg('value', 'payments')} AS avg_payment,
       {_pct('value', 'SUM(value) OVER ()', 1)} AS pct_of_spend
FROM g ORDER BY total_spend DESC""")

QUERY_SQL["q4_2_cumulative"] = with_star(f""", {_DAILY}
SELECT calendar_date, {_r2('value')} AS daily_value,
       {_r2('SUM(value) OVER (ORDER BY calendar_date)')} AS cumulative_value,
       {_pct('SUM(value) OVER (ORDER BY calendar_date)', 'SUM(value) OVER ()', 1)} AS pct_of_month_to_date
FROM daily ORDER BY calendar_date""")

QUERY_SQL["q4_4_busiest_day"] = with_star("""
SELECT type_code, partition_date AS busiest_day, txns
FROM (
    SELECT type_code, partition_date, COUNT(*) AS txns, MAX(COUNT(*)) OVER (PARTITION BY type_code) AS peak
    FROM fact GROUP BY type_code, partition_date
)
WHERE txns = peak ORDER BY txns DESC, type_code, busiest_day""")


# ---------------------------------------------------------------------------
# Transform stages and quality checks
# ---------------------------------------------------------------------------
_RULES = """(nameOrig IS NOT NULL AND trim(nameOrig) <> '') AS p1,
        (nameDest IS NOT NULL AND trim(nameDest) <> '') AS p2,
        COALESCE(amount IS NOT NULL AND amount >= 0 AND NOT isnan(amount), FALSE) AS p3,
        COALESCE(step BETWEEN 1 AND 744, FALSE) AS p4,
        COALESCE(replace(upper(type), '-', '_') IN ('PAYMENT', 'TRANSFER', 'CASH_OUT', 'CASH_IN', 'DEBIT'), FALSE) AS p5"""

STAGE_SQL: dict[str, str] = {}

STAGE_SQL["clean_rows"] = with_clean("SELECT * FROM clean")

STAGE_SQL["clean_rows_strict"] = with_clean(f"""
SELECT DISTINCT {_RAW_COLS} FROM raw
WHERE nameOrig IS NOT NULL AND trim(nameOrig) <> ''
  AND nameDest IS NOT NULL AND trim(nameDest) <> ''
  AND amount IS NOT NULL AND amount >= 0 AND NOT isnan(amount)
  AND step BETWEEN 1 AND 744
  AND type IN ('PAYMENT', 'TRANSFER', 'CASH_OUT', 'CASH_IN', 'DEBIT')""")

STAGE_SQL["clean_report"] = with_clean(f""",
flags AS (SELECT *, {_RULES} FROM raw),
agg AS (
    SELECT COUNT(*) AS rows_in,
        COUNT(*) FILTER (WHERE NOT p1) AS dropped_blank_orig,
        COUNT(*) FILTER (WHERE p1 AND NOT p2) AS dropped_blank_dest,
        COUNT(*) FILTER (WHERE p1 AND p2 AND NOT p3) AS dropped_bad_amount,
        COUNT(*) FILTER (WHERE p1 AND p2 AND p3 AND NOT p4) AS dropped_bad_step,
        COUNT(*) FILTER (WHERE p1 AND p2 AND p3 AND p4 AND NOT p5) AS dropped_bad_type,
        COUNT(*) FILTER (WHERE p1 AND p2 AND p3 AND p4 AND p5) AS passed,
        COUNT(*) FILTER (WHERE p1 AND p2 AND p3 AND p4 AND p5 AND nameOrig <> trim(nameOrig)) AS padded_orig_ids
    FROM flags
)
SELECT rows_in, dropped_blank_orig, dropped_blank_dest, dropped_bad_amount, dropped_bad_step,
       dropped_bad_type, passed - (SELECT COUNT(*) FROM clean) AS dropped_duplicates,
       padded_orig_ids, (SELECT COUNT(*) FROM clean) AS rows_out
FROM agg""")

STAGE_SQL["dedup_rows"] = with_clean(f""",
flags AS (SELECT * FROM raw_norm, LATERAL (SELECT {_RULES}))
SELECT {_RAW_COLS}, COUNT(*) AS copies FROM flags
WHERE p1 AND p2 AND p3 AND p4 AND p5
GROUP BY {_RAW_COLS} HAVING COUNT(*) > 1""")

STAGE_SQL["mask_ids"] = with_clean(f"""
SELECT raw_id, {_mask('raw_id')} AS masked_id
FROM (SELECT nameOrig AS raw_id FROM clean UNION SELECT nameDest FROM clean)""")

STAGE_SQL["classify_dest"] = with_enrich("""
SELECT dest_is_merchant, COUNT(*) AS txns, COUNT(DISTINCT dest_id_masked) AS destinations
FROM txn GROUP BY dest_is_merchant""")

STAGE_SQL["step_time_keys"] = with_enrich("""
SELECT step, full_timestamp, calendar_date, hour_of_day, date_key, COUNT(*) AS txns
FROM txn GROUP BY step, full_timestamp, calendar_date, hour_of_day, date_key""")

STAGE_SQL["normalise_type"] = with_raw("""
SELECT type AS raw_type, replace(upper(type), '-', '_') AS type_code,
       COALESCE(replace(upper(type), '-', '_') IN ('PAYMENT', 'TRANSFER', 'CASH_OUT', 'CASH_IN', 'DEBIT'), FALSE) AS valid,
       COUNT(*) AS rows
FROM raw GROUP BY type""")

STAGE_SQL["region_bucket"] = with_star("""
SELECT COALESCE(a.region, m.region) AS region, COALESCE(a.n, 0) AS accounts, COALESCE(m.n, 0) AS merchants
FROM (SELECT region, COUNT(*) AS n FROM dim_account GROUP BY region) a
FULL OUTER JOIN (SELECT region, COUNT(*) AS n FROM dim_merchant GROUP BY region) m
ON a.region = m.region""")

STAGE_SQL["merchant_category_bucket"] = with_star("""
SELECT merchant_category, region, COUNT(*) AS merchants FROM dim_merchant
GROUP BY merchant_category, region""")

STAGE_SQL["dim_account"] = with_star("SELECT * FROM dim_account")
STAGE_SQL["dim_merchant"] = with_star("SELECT * FROM dim_merchant")
STAGE_SQL["dim_date"] = with_star("SELECT * FROM dim_date")
STAGE_SQL["fact_staging"] = with_star("SELECT * FROM fact_staging")
STAGE_SQL["dim_transaction_type"] = with_star("""
SELECT t.transaction_type_key, t.type_code, t.channel_category, t.description,
       COALESCE(c.n, 0) AS txns
FROM dim_transaction_type t
LEFT JOIN (SELECT type_code, COUNT(*) AS n FROM txn GROUP BY type_code) c ON c.type_code = t.type_code""")


def _checks(pairs: list[tuple[str, str]]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS \"check\", CAST(({expr}) AS BIGINT) AS violations" for name, expr in pairs)


STAGE_SQL["dq_report"] = with_star("\n" + _checks([
    ("dest_both_set", "SELECT COUNT(*) FROM fact_staging WHERE dest_account_id IS NOT NULL AND dest_merchant_id IS NOT NULL"),
    ("dest_neither_set", "SELECT COUNT(*) FROM fact_staging WHERE dest_account_id IS NULL AND dest_merchant_id IS NULL"),
    ("negative_amounts", "SELECT COUNT(*) FROM fact_staging WHERE amount < 0"),
    ("orphan_originators", "SELECT COUNT(*) FROM (SELECT DISTINCT orig_account_id FROM fact_staging) s "
                           "WHERE orig_account_id NOT IN (SELECT account_id FROM dim_account)"),
    ("bad_account_ids", "SELECT COUNT(*) FROM dim_account WHERE NOT regexp_full_match(account_id, '[0-9a-f]{32}')"),
    ("hour_out_of_range", "SELECT COUNT(*) FROM dim_date WHERE hour_of_day NOT BETWEEN 0 AND 23"),
    ("day_of_week_out_of_range", "SELECT COUNT(*) FROM dim_date WHERE day_of_week NOT BETWEEN 1 AND 7"),
    ("month_out_of_range", "SELECT COUNT(*) FROM dim_date WHERE month_number NOT BETWEEN 1 AND 12"),
    ("quarter_out_of_range", "SELECT COUNT(*) FROM dim_date WHERE quarter NOT BETWEEN 1 AND 4"),
    ("fact_negative_amount", "SELECT COUNT(*) FROM fact WHERE amount < 0"),
    ("fact_dest_not_exactly_one", "SELECT COUNT(*) FROM fact WHERE (dest_account_id IS NOT NULL) = (dest_merchant_id IS NOT NULL)"),
]))

STAGE_SQL["dq_orphans"] = with_star("""
SELECT DISTINCT orig_account_id AS account_id FROM fact_staging
WHERE orig_account_id NOT IN (
    SELECT orig_account_id FROM txn WHERE calendar_date <= DATE '2024-01-15'
    UNION
    SELECT dest_id_masked FROM txn WHERE calendar_date <= DATE '2024-01-15' AND NOT dest_is_merchant)""")

_DUP = "SELECT COUNT(*) FROM (SELECT {k} FROM {t} GROUP BY {k} HAVING COUNT(*) > 1)"
STAGE_SQL["dq_uniqueness"] = with_star("\n" + _checks([
    ("dim_date.date_key", _DUP.format(k="date_key", t="dim_date")),
    ("dim_transaction_type.type_code", _DUP.format(k="type_code", t="dim_transaction_type")),
    ("dim_account.account_id_effective_start", _DUP.format(k="account_id", t="dim_account")),
    ("dim_account.current_per_account", _DUP.format(k="account_id", t="dim_account")),
    ("dim_merchant.merchant_id", _DUP.format(k="merchant_id", t="dim_merchant")),
    ("dim_account.account_key", _DUP.format(k="account_id", t="dim_account")),
    ("dim_merchant.merchant_key", _DUP.format(k="merchant_id", t="dim_merchant")),
    ("fact.transaction_key", _DUP.format(k="fact", t="fact")),
]))

_ANTI = ("SELECT COUNT(*) FROM fact f WHERE f.{fk} IS NOT NULL AND NOT EXISTS "
         "(SELECT 1 FROM {t} d WHERE d.{pk} = f.{fk})")
STAGE_SQL["dq_foreign_keys"] = with_star("\n" + _checks([
    ("fact.date_key", _ANTI.format(fk="date_key", t="dim_date", pk="date_key")),
    ("fact.transaction_type_key", _ANTI.format(fk="type_code", t="dim_transaction_type", pk="type_code")),
    ("fact.orig_account_key", _ANTI.format(fk="orig_account_id", t="dim_account", pk="account_id")),
    ("fact.dest_account_key", _ANTI.format(fk="dest_account_id", t="dim_account", pk="account_id")),
    ("fact.dest_merchant_key", _ANTI.format(fk="dest_merchant_id", t="dim_merchant", pk="merchant_id")),
]))

_NN = {
    "dim_date": [(c, c) for c in ["date_key", "full_timestamp", "step", "calendar_date", "hour_of_day",
                                  "day_of_week", "day_name", "week_of_month", "month_number",
                                  "month_name", "quarter", "year", "is_weekend"]],
    "dim_account": [("account_key", "account_id"), ("account_id", "account_id"),
                    ("account_status", "account_status"), ("effective_start", None),
                    ("is_current", None)],
    "dim_merchant": [("merchant_key", "merchant_id"), ("merchant_id", "merchant_id")],
    "fact_transactions": [("date_key", "date_key"), ("transaction_type_key", "type_code"),
                          ("orig_account_key", "orig_account_id"), ("amount", "amount"),
                          ("is_fraud", "is_fraud"), ("is_flagged_by_system", "is_flagged_by_system"),
                          ("source_step", "source_step"), ("loaded_at", None)],
}
_NN_TABLE = {"dim_date": "dim_date", "dim_account": "dim_account", "dim_merchant": "dim_merchant",
             "fact_transactions": "fact"}
STAGE_SQL["dq_not_null"] = with_star("\n" + _checks([
    (f"not_null:{t}_{c}", f"SELECT COUNT(*) FROM {_NN_TABLE[t]} WHERE {src} IS NULL" if src else "SELECT 0")
    for t, cols in _NN.items() for c, src in cols
]))

STAGE_SQL["dq_masked_ids"] = with_clean(f""",
ids AS (SELECT nameOrig AS id FROM clean UNION ALL SELECT nameDest FROM clean),
masked AS (SELECT {_mask('id')} AS id FROM ids)
""" + _checks([
    ("collisions", "(SELECT COUNT(DISTINCT id) FROM ids) - (SELECT COUNT(DISTINCT id) FROM masked)"),
    ("bad_format", "SELECT COUNT(*) FROM masked WHERE NOT regexp_full_match(id, '[0-9a-f]{32}')"),
]))


# ---------------------------------------------------------------------------
# Five-batch load scenario (closed-form set logic per batch)
# ---------------------------------------------------------------------------
def _hx(col: str) -> str:
    return f"(('0x' || substr({col}, 9, 2))::INTEGER)"


_SCEN = f""",
early_ids AS (
    SELECT orig_account_id AS account_id FROM txn WHERE calendar_date <= DATE '2024-01-15'
    UNION
    SELECT dest_id_masked FROM txn WHERE calendar_date <= DATE '2024-01-15' AND NOT dest_is_merchant
),
a1 AS (SELECT * FROM dim_account WHERE account_id IN (SELECT account_id FROM early_ids)),
a2 AS (
    SELECT account_id,
        CASE WHEN {_hx('account_id')} % 11 = 0 THEN NULL
             WHEN {_hx('account_id')} % 5 = 0 THEN 'Prairies' ELSE region END AS region,
        CASE WHEN {_hx('account_id')} % 7 = 0 THEN 'DORMANT' ELSE account_status END AS account_status
    FROM dim_account
),
changed AS (
    SELECT a1.account_id FROM a1 JOIN a2 ON a1.account_id = a2.account_id
    WHERE a1.region IS DISTINCT FROM a2.region OR a1.account_status IS DISTINCT FROM a2.account_status
),
batch_fact AS (
    SELECT 1 AS batch, * FROM fact WHERE partition_date <= DATE '2024-01-15'
    UNION ALL SELECT 2, * FROM fact
    UNION ALL SELECT 3, * FROM fact
    UNION ALL SELECT 4, * FROM fact WHERE partition_date = DATE '2024-01-10'
    UNION ALL SELECT 5, * FROM fact WHERE partition_date = DATE '2024-01-01'
),
batch_flags AS (
    SELECT batch, partition_date,
        batch = 5 AND {_hx('orig_account_id')} % 17 = 0 AS bad_type,
        batch = 5 AND {_hx('orig_account_id')} % 13 = 0 AS bad_acct
    FROM batch_fact
)"""

STAGE_SQL["load_insert_if_new"] = with_star(_SCEN + """
SELECT CAST(b AS BIGINT) AS batch, CAST(n AS BIGINT) AS inserted FROM (VALUES
    (1, (SELECT COUNT(DISTINCT date_key) FROM txn WHERE calendar_date <= DATE '2024-01-15')),
    (2, (SELECT COUNT(DISTINCT date_key) FROM txn WHERE calendar_date > DATE '2024-01-15')),
    (3, 0), (4, 0), (5, 0)) AS t(b, n)""")

STAGE_SQL["load_type1_upsert"] = with_star(f"""
SELECT merchant_id, merchant_category,
    CASE WHEN {_hx('merchant_id')} % 11 = 0 THEN NULL
         WHEN {_hx('merchant_id')} % 5 = 0 THEN 'Prairies' ELSE region END AS region
FROM dim_merchant""")

STAGE_SQL["scd2_history"] = with_star(_SCEN + """
SELECT account_id, region, account_status, TIMESTAMP '2024-02-01 00:00:00' AS effective_start,
    CASE WHEN account_id IN (SELECT account_id FROM changed) THEN TIMESTAMP '2024-03-01 00:00:00' END AS effective_end,
    account_id NOT IN (SELECT account_id FROM changed) AS is_current
FROM a1
UNION ALL
SELECT account_id, region, account_status, TIMESTAMP '2024-03-01 00:00:00', CAST(NULL AS TIMESTAMP), TRUE
FROM a2
WHERE account_id NOT IN (SELECT account_id FROM a1) OR account_id IN (SELECT account_id FROM changed)""")

STAGE_SQL["scd2_current"] = with_star(_SCEN + """
SELECT account_id, region, account_status,
    CASE WHEN account_id IN (SELECT account_id FROM a1) AND account_id NOT IN (SELECT account_id FROM changed)
         THEN TIMESTAMP '2024-02-01 00:00:00' ELSE TIMESTAMP '2024-03-01 00:00:00' END AS effective_start
FROM a2""")

STAGE_SQL["scd2_changes"] = with_star(_SCEN + """
SELECT CAST(b AS BIGINT) AS batch, CAST(c AS BIGINT) AS closed_and_reopened, CAST(n AS BIGINT) AS inserted_new
FROM (VALUES
    (1, 0, (SELECT COUNT(*) FROM a1)),
    (2, (SELECT COUNT(*) FROM changed), (SELECT COUNT(*) FROM a2) - (SELECT COUNT(*) FROM a1)),
    (3, 0, 0), (4, 0, 0), (5, 0, 0)) AS t(b, c, n)""")

STAGE_SQL["fact_resolved"] = with_star("""
SELECT orig_account_id, dest_account_id, dest_merchant_id, date_key, partition_date, type_code,
    CAST(amount AS DOUBLE) AS amount, CAST(balance_before_orig AS DOUBLE) AS balance_before_orig,
    CAST(balance_after_orig AS DOUBLE) AS balance_after_orig,
    CAST(balance_before_dest AS DOUBLE) AS balance_before_dest,
    CAST(balance_after_dest AS DOUBLE) AS balance_after_dest,
    is_fraud, is_flagged_by_system, source_step
FROM fact""")

#: Two loads: days 1-15 as they are, days 16-31 with changed attributes.
_TWO_VERSIONS = _SCEN + """,
vfact AS (
    SELECT f.*, f.orig_account_id AS account_id,
           CASE WHEN f.partition_date <= DATE '2024-01-15' THEN a.region ELSE o.region END AS region,
           f.orig_account_id || CASE WHEN f.partition_date <= DATE '2024-01-15'
               OR (f.orig_account_id IN (SELECT account_id FROM a1) AND f.orig_account_id NOT IN (SELECT account_id FROM changed)) THEN ' 1' ELSE ' 2' END AS version
    FROM fact f JOIN dim_account a ON a.account_id = f.orig_account_id JOIN a2 o ON o.account_id = f.orig_account_id
)"""

STAGE_SQL.update({f"{name}_versions": with_star(_TWO_VERSIONS + sql) for name, sql in ACCOUNT_SQL.items()})

STAGE_SQL["fact_replace_partitions"] = with_star(f"""
SELECT partition_date, COUNT(*) AS rows, CAST(SUM(amount) AS DOUBLE) AS total_amount,
    CAST(1 AS BIGINT) AS loads, MAX(loaded_at) AS loaded_at
FROM (
    SELECT partition_date, amount * 2 AS amount, TIMESTAMP '2024-05-01 00:00:00' AS loaded_at
    FROM fact WHERE partition_date = DATE '2024-01-10'
    UNION ALL
    SELECT partition_date, amount, TIMESTAMP '2024-06-01 00:00:00'
    FROM fact WHERE partition_date = DATE '2024-01-01'
      AND NOT ({_hx('orig_account_id')} % 17 = 0 OR {_hx('orig_account_id')} % 13 = 0)
    UNION ALL
    SELECT partition_date, amount, TIMESTAMP '2024-04-01 00:00:00'
    FROM fact WHERE partition_date NOT IN (DATE '2024-01-01', DATE '2024-01-10')
)
GROUP BY partition_date""")

STAGE_SQL["load_audit"] = with_star(_SCEN + """,
prior AS (
    SELECT 1 AS batch, 0 AS deleted
    UNION ALL SELECT 2, (SELECT COUNT(*) FROM fact WHERE partition_date <= DATE '2024-01-15')
    UNION ALL SELECT 3, (SELECT COUNT(*) FROM fact)
    UNION ALL SELECT 4, (SELECT COUNT(*) FROM fact WHERE partition_date = DATE '2024-01-10')
    UNION ALL SELECT 5, (SELECT COUNT(*) FROM fact WHERE partition_date = DATE '2024-01-01')
)
SELECT CAST(f.batch AS BIGINT) AS batch, COUNT(*) AS staged,
    COUNT(*) FILTER (WHERE NOT bad_type AND NOT bad_acct) AS inserted,
    CAST(MAX(p.deleted) AS BIGINT) AS deleted,
    COUNT(*) FILTER (WHERE bad_type) AS unresolved_type,
    COUNT(*) FILTER (WHERE NOT bad_type AND bad_acct) AS unresolved_account
FROM batch_flags f JOIN prior p ON p.batch = f.batch
GROUP BY f.batch""")


# ---------------------------------------------------------------------------
# Distributed ranking keys and the extra reports
# ---------------------------------------------------------------------------
_ACCT_VALUE = f""",
acct_value AS (
    SELECT orig_account_id AS account_id, SUM(amount) AS value, COUNT(*) AS txns
    FROM fact GROUP BY orig_account_id
)"""

STAGE_SQL["rank_with_nulls"] = with_star("""
SELECT account_id, CAST(round(value, 2) AS DOUBLE) AS fraud_value, RANK() OVER (ORDER BY value DESC NULLS LAST) AS fraud_rank
FROM (SELECT orig_account_id AS account_id, SUM(amount) FILTER (WHERE is_fraud) AS value FROM fact GROUP BY 1)""")

STAGE_SQL["global_ntile"] = with_star(_ACCT_VALUE + """
SELECT account_id, CAST(round(value, 2) AS DOUBLE) AS total_value,
       CAST(NTILE(10) OVER (ORDER BY value DESC, account_id) AS BIGINT) AS value_decile
FROM acct_value""")

STAGE_SQL["global_rank"] = with_star(_ACCT_VALUE + """
SELECT account_id, txns, CAST(RANK() OVER (ORDER BY txns DESC) AS BIGINT) AS txn_rank
FROM acct_value""")

STAGE_SQL["x1_rolling_counts"] = with_star(""",
hourly AS (
    SELECT orig_account_id AS account_id, source_step AS step, COUNT(*) AS txns_in_hour
    FROM fact GROUP BY orig_account_id, source_step
)
SELECT account_id, step, txns_in_hour,
       CAST(SUM(txns_in_hour) OVER (PARTITION BY account_id ORDER BY step
            RANGE BETWEEN 23 PRECEDING AND CURRENT ROW) AS BIGINT) AS txns_last_24h
FROM hourly""")

STAGE_SQL["x2_hourly_spikes"] = with_star(""",
hourly AS (
    SELECT f.date_key, d.step, COUNT(*) AS txns FROM fact f JOIN dim_date d ON d.date_key = f.date_key
    GROUP BY f.date_key, d.step
),
s AS (
    SELECT date_key, step, txns,
        AVG(txns) OVER (ORDER BY step ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS m,
        STDDEV_SAMP(txns) OVER (ORDER BY step ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS sd
    FROM hourly
)
SELECT date_key, step, txns, round(m, 3) AS baseline_mean,
       round((txns - m) / NULLIF(sd, 0.0), 3) AS z_score,
       COALESCE((txns - m) / NULLIF(sd, 0.0) > 3.0, FALSE) AS is_spike
FROM s""")

STAGE_SQL["x2_off_hours_accounts"] = with_star(f""",
g AS (
    SELECT f.orig_account_id AS account_id,
           COUNT(*) FILTER (WHERE d.hour_of_day BETWEEN 0 AND 5) AS off_hours_txns, COUNT(*) AS txns
    FROM fact f JOIN dim_date d ON d.date_key = f.date_key GROUP BY f.orig_account_id
)
SELECT account_id, off_hours_txns, txns, {_pct('off_hours_txns', 'txns', 1)} AS off_hours_pct,
       off_hours_txns > txns * 0.5 AS is_flagged
FROM g WHERE txns >= 5""")

STAGE_SQL["x3_cohorts"] = with_star(""",
per_day AS (
    SELECT f.orig_account_id AS account_id, d.calendar_date, COUNT(*) AS n
    FROM fact f JOIN dim_date d ON d.date_key = f.date_key GROUP BY 1, 2
),
firsts AS (SELECT account_id, MIN(calendar_date) AS first_day FROM per_day GROUP BY 1)
SELECT CAST(date_trunc('week', first_day) AS DATE) AS cohort_week,
       CAST(date_diff('day', CAST(date_trunc('week', first_day) AS DATE),
                      CAST(date_trunc('week', calendar_date) AS DATE)) / 7 AS BIGINT) AS weeks_since_first,
       COUNT(DISTINCT p.account_id) AS active_accounts, CAST(SUM(n) AS BIGINT) AS txns
FROM per_day p JOIN firsts USING (account_id)
GROUP BY 1, 2""")

STAGE_SQL["x4_counterparties"] = with_star("""
SELECT dest_account_id AS counterparty_id, 'customer' AS kind, COUNT(*) AS txns,
       CAST(round(SUM(amount), 2) AS DOUBLE) AS total_value
FROM fact WHERE dest_account_id IS NOT NULL GROUP BY dest_account_id
UNION ALL
SELECT dest_merchant_id, 'merchant', COUNT(*), CAST(round(SUM(amount), 2) AS DOUBLE)
FROM fact WHERE dest_merchant_id IS NOT NULL GROUP BY dest_merchant_id""")

STAGE_SQL["x5_account_recent"] = with_star(f"""
SELECT orig_account_id AS account_id, partition_date AS calendar_date, COUNT(*) AS txns,
       CAST(round(SUM(amount), 2) AS DOUBLE) AS total_value
FROM fact
WHERE orig_account_id = {_mask("'C7'")}
  AND partition_date > (SELECT MAX(calendar_date) FROM dim_date) - INTERVAL 7 DAY
GROUP BY 1, 2""")

STAGE_SQL["x6_zero_balance_profile"] = with_star(f""",
g AS (
    SELECT is_fraud, COUNT(*) AS txns,
        COUNT(*) FILTER (WHERE COALESCE(balance_before_orig, 0) = 0 AND COALESCE(balance_after_orig, 0) = 0
                           AND COALESCE(balance_before_dest, 0) = 0 AND COALESCE(balance_after_dest, 0) = 0)
            AS all_balances_zero
    FROM fact GROUP BY is_fraud
)
SELECT CASE WHEN is_fraud THEN 'Actual fraud' ELSE 'Legitimate' END AS actual, txns, all_balances_zero,
       {_pct('all_balances_zero', 'txns', 2)} AS pct_all_zero
FROM g""")

STAGE_SQL["x7_rule_flag"] = with_star("""
SELECT (type_code = 'TRANSFER' AND amount > 200.0) AS rule_flag, is_flagged_by_system, is_fraud,
       COUNT(*) AS txns
FROM fact GROUP BY 1, 2, 3""")

STAGE_SQL["x8_dashboard_mart"] = with_star(f""",
g AS (
    SELECT f.partition_date AS calendar_date, a.region, f.type_code, COUNT(*) AS txns,
           SUM(f.amount) AS value, COUNT(*) FILTER (WHERE f.is_fraud) AS fraud_txns
    FROM fact f JOIN dim_account a ON a.account_id = f.orig_account_id
    GROUP BY 1, 2, 3
)
SELECT calendar_date, region, type_code, txns, {_r2('value')} AS total_value,
       {half_up_avg('value', 'txns')} AS avg_value, fraud_txns
FROM g""")

STAGE_SQL["x9_weekly_layout"] = with_star("""
SELECT CAST(date_trunc('week', partition_date) AS DATE) AS partition_week, COUNT(*) AS rows,
       COUNT(DISTINCT partition_date) AS days, CAST(round(SUM(amount), 2) AS DOUBLE) AS total_value
FROM fact GROUP BY 1""")

STAGE_SQL["x10_incremental_type_mix"] = QUERY_SQL["q1_3_type_mix"]

STAGE_SQL["csv_roundtrip"] = STAGE_SQL["clean_rows"]
STAGE_SQL["fact_partition_write"] = with_star("""
SELECT partition_date, COUNT(*) AS rows, CAST(1 AS BIGINT) AS files, round(SUM(amount), 2) AS total_amount
FROM fact_staging GROUP BY partition_date""")

STAGE_SQL["rfm_scores_all"] = with_star(_VERSION_FACT + _RFM)

STAGE_SQL["dim_single_file"] = with_star("""
SELECT 'dim_date' AS dimension, COUNT(*) AS rows, COUNT(DISTINCT date_key) AS keys, CAST(1 AS BIGINT) AS files FROM dim_date
UNION ALL SELECT 'dim_merchant', COUNT(*), COUNT(DISTINCT merchant_id), 1 FROM dim_merchant
UNION ALL SELECT 'dim_transaction_type', COUNT(*), COUNT(DISTINCT type_code), 1 FROM dim_transaction_type""")

STAGE_SQL["nan_balances"] = with_star(f"""
SELECT partition_date, COUNT(*) AS rows,
    COUNT(*) FILTER (WHERE balance_before_orig IS NULL OR {_hx('orig_account_id')} % 7 = 0) AS unknown_balance_before_orig,
    COUNT(*) FILTER (WHERE balance_after_dest IS NULL OR {_hx('orig_account_id')} % 5 = 0) AS unknown_balance_after_dest,
    CAST(SUM(balance_before_orig) FILTER (WHERE {_hx('orig_account_id')} % 7 <> 0) AS DOUBLE) AS sum_balance_before_orig,
    CAST(SUM(balance_after_dest) FILTER (WHERE {_hx('orig_account_id')} % 5 <> 0) AS DOUBLE) AS sum_balance_after_dest
FROM fact GROUP BY partition_date""")

_TWO_WEEKS = "f.partition_date BETWEEN DATE '2024-01-08' AND DATE '2024-01-21'"

STAGE_SQL["q2_3_range"] = with_star(f""",
ranked AS (
    SELECT f.type_code, f.amount, ROW_NUMBER() OVER (PARTITION BY f.type_code ORDER BY f.amount) AS rn,
           COUNT(*) OVER (PARTITION BY f.type_code) AS n
    FROM fact f WHERE {_TWO_WEEKS}
),
g AS (
    SELECT type_code, {_pcont('0.5')} AS median, {_pcont('0.9')} AS p90, {_pcont('0.99')} AS p99, MAX(amount) AS max_amount
    FROM ranked GROUP BY type_code
)
SELECT type_code, {_r2('median')} AS median, {_r2('p90')} AS p90, {_r2('p99')} AS p99, {_r2('max_amount')} AS max_amount
FROM g""")

STAGE_SQL["x8_filtered_feed"] = with_star(f"""
SELECT f.type_code, COUNT(*) AS txns, {_r2('SUM(f.amount)')} AS total_value, COUNT(*) FILTER (WHERE f.is_fraud) AS fraud_txns,
       COUNT(DISTINCT f.orig_account_id) AS accounts, COUNT(DISTINCT f.dest_merchant_id) AS merchants,
       TRUE AS accounts_within, TRUE AS merchants_within
FROM fact f WHERE {_TWO_WEEKS} GROUP BY f.type_code""")

STAGE_SQL["account_lookup"] = with_star(f""",
seen AS (
    SELECT 'sent' AS direction, * FROM fact WHERE orig_account_id = {_mask("'C7'")}
    UNION ALL SELECT 'received', * FROM fact WHERE dest_account_id = {_mask("'C7'")}
)
SELECT direction, partition_date AS calendar_date, type_code, COUNT(*) AS txns, {_r2('SUM(amount)')} AS total_value
FROM seen GROUP BY 1, 2, 3""")
