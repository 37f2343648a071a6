"""DuckDB SQL for the expected result of every query, from the generated tables alone.

Amounts stay DECIMAL until the last step. Means and percentages divide integers, rounding half
up, since DuckDB turns a DECIMAL quotient into a DOUBLE first.
"""

from __future__ import annotations

_TX = """
tx AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id,
         o_custkey AS customer_id,
         o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER))
                     + to_minutes(CAST(o_orderkey % 60 AS INTEGER)) AS transaction_date,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'Deposit' WHEN '2-HIGH' THEN 'Withdrawal'
              WHEN '3-MEDIUM' THEN 'Transfer' WHEN '4-NOT SPECIFIED' THEN 'Payment'
              WHEN '5-LOW' THEN 'Fee' END AS transaction_type,
         CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,4)) AS amount,
         CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Pending'
              WHEN 'P' THEN 'Failed' END AS status
  FROM orders)"""

_CUSTOMERS = """
cust AS (
  SELECT c_custkey AS customer_id,
         split_part(c_name, '#', 1) AS first_name,
         split_part(c_name, '#', 2) AS last_name,
         lower(replace(c_name, '#', '.')) || '@example.com' AS email,
         lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS phone_number,
         CASE WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD') THEN 'Checking'
              WHEN c_mktsegment IN ('AUTOMOBILE', 'FURNITURE') THEN 'Savings'
              WHEN c_mktsegment = 'MACHINERY' THEN 'Credit' END AS account_type,
         CAST(DATE '1996-08-02' + CAST((c_custkey * 37) % 1825 AS INTEGER) AS DATE) AS join_date
  FROM customer),
dim_customers AS (
  SELECT *, CAST(date_diff('day', join_date, DATE '2001-08-02') AS INTEGER) AS tenure_days FROM cust)"""

_FACT = """
clean AS (
  SELECT transaction_id, customer_id, transaction_date, transaction_type,
         ROUND(amount, 2) AS amount, status,
         amount > 4500 AS is_anomaly,
         CAST(year(transaction_date) AS INTEGER) AS tx_year,
         CAST(month(transaction_date) AS INTEGER) AS tx_month,
         CAST(dayofweek(transaction_date) + 1 AS INTEGER) AS tx_day_of_week,
         CAST(hour(transaction_date) AS INTEGER) AS tx_hour
  FROM tx WHERE status <> 'Failed'),
dim_type AS (
  SELECT * FROM (VALUES
    (CAST(1 AS INTEGER), 'Deposit', 'Funds added to account'),
    (2, 'Withdrawal', 'Funds removed from account'),
    (3, 'Transfer', 'Funds moved between accounts'),
    (4, 'Payment', 'Payment for goods or services')) AS t(type_key, type_name, type_description)),
dim_date AS (
  SELECT CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key, full_date,
         CAST(year(full_date) AS INTEGER) AS year,
         CAST(quarter(full_date) AS INTEGER) AS quarter,
         CAST(month(full_date) AS INTEGER) AS month,
         strftime(full_date, '%B') AS month_name,
         CAST(day(full_date) AS INTEGER) AS day,
         CAST(dayofweek(full_date) + 1 AS INTEGER) AS day_of_week,
         strftime(full_date, '%A') AS day_name,
         dayofweek(full_date) IN (0, 6) AS is_weekend
  FROM (SELECT DISTINCT CAST(transaction_date AS DATE) AS full_date FROM clean)),
fact AS (
  SELECT transaction_id, customer_id,
         CAST(strftime(transaction_date, '%Y%m%d') AS INTEGER) AS date_key,
         type_key, transaction_type, amount, status, is_anomaly, transaction_date,
         tx_year, tx_month, tx_day_of_week, tx_hour
  FROM clean LEFT JOIN dim_type ON transaction_type = type_name)"""

_RAW = f"WITH {_TX},{_CUSTOMERS}"
_STAR = f"{_RAW},{_FACT}"

_REVENUE = "CAST(SUM(amount) AS DOUBLE)"
_CENTS = "CAST(SUM(amount) * 100 AS HUGEINT)"


def _ratio(numerator: str, denominator: str, digits: int) -> str:
    scaled = f"2 * CAST({numerator} AS HUGEINT) * {10 ** digits} + {denominator}"
    return f"CAST(({scaled}) // (2 * {denominator}) AS DOUBLE) / {10 ** digits}"


_MEAN = f"{_ratio(_CENTS, 'COUNT(amount)', 0)} / 100"
_PERIOD = "tx_year || '-' || lpad(CAST(tx_month AS VARCHAR), 2, '0')"
_TENURE = """CASE WHEN tenure_days < 365 THEN '< 1 Year' WHEN tenure_days < 730 THEN '1-2 Years'
             WHEN tenure_days < 1095 THEN '2-3 Years' ELSE '3+ Years' END"""
_FACT_COLUMNS = """transaction_id, customer_id, date_key, type_key, transaction_type,
       CAST(amount AS DOUBLE) AS amount, status, is_anomaly, transaction_date,
       tx_year, tx_month, tx_day_of_week, tx_hour"""
_CLEAN_COLUMNS = """transaction_id, customer_id, transaction_date, transaction_type,
       CAST(amount AS DOUBLE) AS amount, status, is_anomaly,
       tx_year, tx_month, tx_day_of_week, tx_hour"""
_TX_COLUMNS = """transaction_id, customer_id, transaction_date, transaction_type,
       CAST(amount AS DOUBLE) AS amount, status"""
_STATUS = "CASE WHEN {0} = 0 THEN 'PASS' ELSE 'FAIL' END"


def _domain(column: str, valid: str) -> str:
    return f"""{_RAW} SELECT {column}, COUNT(*) AS row_count,
       COALESCE({column} IN ({valid}), FALSE) AS is_valid FROM tx GROUP BY {column}"""


def _figures(**counts: str) -> str:
    """Named counts as one text; give the names in their order."""
    return " || ',' || ".join(f"'{name}=' || {count}" for name, count in counts.items())


def _key_figures(key: str) -> str:
    return _figures(nulls=f"(COUNT(*) - COUNT({key}))", repeats=f"(COUNT({key}) - COUNT(DISTINCT {key}))")


def _long_figures(**limits: int) -> str:
    return _figures(**{name: f"COUNT(*) FILTER (length({name}) > {limit})" for name, limit in limits.items()})


_VALID_TYPES = "'Deposit', 'Withdrawal', 'Transfer', 'Payment'"
_VALID_STATUSES = "'Completed', 'Pending', 'Failed'"

_CHECK_ROWS = f"""{_RAW},
bad AS (
  SELECT 'record_counts' AS "check", 0 AS bad_count,
         {_figures(
             processed_record_count="COUNT(*) FILTER (status <> 'Failed')",
             removed="COUNT(*) FILTER (status = 'Failed')",
             removed_null_status="COUNT(*) FILTER (status IS NULL)",
             total_raw_records="COUNT(*)",
         )} AS details FROM tx
  UNION ALL SELECT 'null_critical_columns',
         COUNT(*) FILTER (transaction_id IS NULL OR transaction_id = '')
         + COUNT(*) FILTER (customer_id IS NULL) + COUNT(*) FILTER (amount IS NULL)
         + COUNT(*) FILTER (transaction_date IS NULL),
         {_figures(
             amount="COUNT(*) FILTER (amount IS NULL)",
             customer_id="COUNT(*) FILTER (customer_id IS NULL)",
             transaction_date="COUNT(*) FILTER (transaction_date IS NULL)",
             transaction_id="COUNT(*) FILTER (transaction_id IS NULL OR transaction_id = '')",
         )} FROM tx
  UNION ALL SELECT 'amount_positive', COUNT(*) FILTER (amount <= 0), '' FROM tx
  UNION ALL SELECT 'unique_transaction_ids', COUNT(*) - COUNT(DISTINCT transaction_id)
         - CASE WHEN COUNT(*) > COUNT(transaction_id) THEN 1 ELSE 0 END, '' FROM tx
  UNION ALL SELECT 'valid_transaction_type', COUNT(*), {_figures(distinct_invalid="COUNT(*)")} FROM
         (SELECT DISTINCT transaction_type FROM tx) WHERE transaction_type IS NULL
         OR transaction_type NOT IN ({_VALID_TYPES})
  UNION ALL SELECT 'valid_status', COUNT(*), {_figures(distinct_invalid="COUNT(*)")} FROM
         (SELECT DISTINCT status FROM tx) WHERE status IS NULL
         OR status NOT IN ({_VALID_STATUSES})),
everything AS (
  SELECT * FROM bad UNION ALL SELECT 'overall', COUNT(*) FILTER (bad_count > 0), '' FROM bad)
SELECT "check", {_STATUS.format('bad_count')} AS status, CAST(bad_count AS BIGINT) AS bad_count, details
FROM everything"""

_CONSTRAINT_ROWS = f"""{_RAW},
bad AS (
  SELECT 'transactions_primary_key' AS "check", COUNT(*) - COUNT(DISTINCT transaction_id) AS bad_count,
         {_key_figures('transaction_id')} AS details FROM tx
  UNION ALL SELECT 'customers_primary_key', COUNT(*) - COUNT(DISTINCT customer_id), {_key_figures('customer_id')} FROM cust
  UNION ALL SELECT 'customers_unique_email', COUNT(email) - COUNT(DISTINCT email), '' FROM cust
  UNION ALL SELECT 'transactions_text_lengths', COUNT(*) FILTER (length(transaction_id) > 36)
         + COUNT(*) FILTER (length(transaction_type) > 20) + COUNT(*) FILTER (length(status) > 20),
         {_long_figures(status=20, transaction_id=36, transaction_type=20)} FROM tx
  UNION ALL SELECT 'transactions_amount_range', COUNT(*) FILTER (abs(round(amount, 2)) >= 100000000), '' FROM tx
  UNION ALL SELECT 'customers_text_lengths', COUNT(*) FILTER (length(first_name) > 50)
         + COUNT(*) FILTER (length(last_name) > 50) + COUNT(*) FILTER (length(email) > 100)
         + COUNT(*) FILTER (length(phone_number) > 20) + COUNT(*) FILTER (length(account_type) > 20),
         {_long_figures(account_type=20, email=100, first_name=50, last_name=50, phone_number=20)} FROM cust),
everything AS (
  SELECT * FROM bad UNION ALL SELECT 'overall', COUNT(*) FILTER (bad_count > 0), '' FROM bad)
SELECT "check", {_STATUS.format('bad_count')} AS status, CAST(bad_count AS BIGINT) AS bad_count, details
FROM everything"""

_RECONCILED = f"""{_STAR}
SELECT 'raw_transactions' AS stage, COUNT(*) AS row_count FROM tx
UNION ALL SELECT 'kept', COUNT(*) FROM tx WHERE status <> 'Failed'
UNION ALL SELECT 'removed', COUNT(*) FROM tx WHERE status = 'Failed'
UNION ALL SELECT 'removed_null_status', COUNT(*) FROM tx WHERE status IS NULL
UNION ALL SELECT 'raw_customers', COUNT(*) FROM cust
UNION ALL SELECT 'processed', COUNT(*) FROM clean
UNION ALL SELECT 'fact_transactions', COUNT(*) FROM fact
UNION ALL SELECT 'dim_customers', COUNT(*) FROM dim_customers
UNION ALL SELECT 'dim_date', COUNT(*) FROM dim_date
UNION ALL SELECT 'dim_transaction_type', COUNT(*) FROM dim_type"""



def _prints(**columns: str) -> str:
    """Fingerprint of rows: both halves of the MD5 of all values, each behind its length."""
    row = " || ".join(f"coalesce(length({x}) || ':' || {x}, 'n')" for x in columns.values())
    half = "CAST('0x' || substr(md5({}), {}, 15) AS BIGINT)"
    return f"""COUNT(*) AS row_count, CAST(SUM({half.format(row, 1)}) AS VARCHAR) AS hash_sum,
       BIT_XOR({half.format(row, 17)}) AS hash_xor"""


_CLEAN_PRINTS = _prints(
    transaction_id="transaction_id",
    customer_id="CAST(customer_id AS VARCHAR)",
    transaction_date="CAST(transaction_date AS VARCHAR)",
    transaction_type="transaction_type",
    amount="CAST(CAST(amount AS DECIMAL(30,4)) AS VARCHAR)",
    status="status",
    is_anomaly="CAST(is_anomaly AS VARCHAR)",
)
_CUSTOMER_PRINTS = _prints(
    customer_id="CAST(customer_id AS VARCHAR)",
    first_name="first_name",
    last_name="last_name",
    email="email",
    phone_number="phone_number",
    account_type="account_type",
    join_date="CAST(join_date AS VARCHAR)",
)

_Q1 = f"""{_STAR} SELECT tx_year, tx_month, COUNT(*) AS total_transactions,
       {_REVENUE} AS total_revenue, {_MEAN} AS avg_transaction_amount
FROM fact GROUP BY tx_year, tx_month"""

_Q2 = f"""{_STAR} SELECT account_type, COUNT(*) AS transaction_count, {_REVENUE} AS total_revenue,
       {_MEAN} AS avg_amount, COUNT(DISTINCT f.customer_id) AS unique_customers
FROM fact f JOIN dim_customers c ON f.customer_id = c.customer_id GROUP BY account_type"""

_TOP = """FROM fact f JOIN dim_customers c ON f.customer_id = c.customer_id
GROUP BY c.customer_id, first_name, last_name, account_type
ORDER BY SUM(amount) DESC, c.customer_id LIMIT 10"""

_TOP_CUSTOMERS = f"""{_STAR} SELECT c.customer_id,
            first_name || ' ' || last_name AS customer_name, account_type,
            COUNT(*) AS transaction_count, {_REVENUE} AS total_spend {_TOP}"""

_CLEAN_ROWS = f"{_STAR} SELECT {_CLEAN_COLUMNS} FROM clean"
_FACT_ROWS = f"{_STAR} SELECT {_FACT_COLUMNS} FROM fact"
_TX_ROWS = f"{_RAW} SELECT {_TX_COLUMNS} FROM tx"
_CUSTOMER_ROWS = f"{_RAW} SELECT * FROM cust"
_DIM_CUSTOMER_ROWS = f"{_RAW} SELECT * FROM dim_customers"


def oracle_sql() -> dict[str, str]:
    return {
        "tx_clean": _CLEAN_ROWS,
        "dim_customers": _DIM_CUSTOMER_ROWS,
        "dim_date": f"{_STAR} SELECT * FROM dim_date",
        "dim_transaction_type": f"""{_STAR}
            SELECT d.*, COUNT(clean.transaction_id) AS used_by
            FROM dim_type d LEFT JOIN clean ON transaction_type = type_name GROUP BY ALL""",
        "fact_transactions": _FACT_ROWS,
        "q1_monthly_revenue": _Q1,
        "q2_revenue_by_account": _Q2,
        "q3_top10_customers": _TOP_CUSTOMERS,
        "q4_weekend_weekday": f"""{_STAR} SELECT is_weekend,
            CASE WHEN is_weekend THEN 'Weekend' ELSE 'Weekday' END AS period,
            COUNT(*) AS transaction_count, {_REVENUE} AS total_revenue, {_MEAN} AS avg_amount
            FROM fact f JOIN dim_date d ON f.date_key = d.date_key GROUP BY is_weekend""",
        "q5_anomaly_summary": f"""{_STAR} SELECT transaction_type, is_anomaly, COUNT(*) AS "count",
            {_REVENUE} AS total_amount, {_MEAN} AS avg_amount
            FROM fact GROUP BY transaction_type, is_anomaly""",
        "q6_tenure_segments": f"""{_STAR} SELECT {_TENURE} AS tenure_segment,
            COUNT(DISTINCT c.customer_id) AS customer_count, COUNT(*) AS transaction_count,
            {_REVENUE} AS total_revenue
            FROM fact f JOIN dim_customers c ON f.customer_id = c.customer_id GROUP BY 1""",
        "chart1_monthly_volume": f"""{_STAR} SELECT tx_year, tx_month, COUNT(*) AS tx_count,
            {_REVENUE} AS total_revenue, {_PERIOD} AS period FROM fact GROUP BY tx_year, tx_month""",
        "chart2_type_distribution": f"""{_STAR},
            per_type AS (SELECT transaction_type, COUNT(*) AS n, SUM(amount) AS amount
                         FROM fact GROUP BY transaction_type),
            whole AS (SELECT SUM(n) AS all_n, SUM(amount) AS all_amount FROM per_type)
            SELECT transaction_type, n AS "count", CAST(amount AS DOUBLE) AS total,
              {_ratio('n * 100', 'CAST(all_n AS HUGEINT)', 1)} AS count_share,
              {_ratio('amount * 10000', 'CAST(all_amount * 100 AS HUGEINT)', 1)} AS revenue_share
            FROM per_type, whole""",
        "chart3_top_customers": f"""{_STAR} SELECT c.customer_id, first_name, last_name, account_type,
            {_REVENUE} AS total_spend, COUNT(*) AS tx_count,
            first_name || ' ' || last_name AS name {_TOP}""",
        "chart4_account_revenue": f"""{_STAR} SELECT account_type, transaction_type, {_REVENUE} AS revenue
            FROM fact f JOIN dim_customers c ON f.customer_id = c.customer_id
            GROUP BY account_type, transaction_type""",
        "chart4_account_pivot": f"""{_STAR} SELECT account_type, """
        + ", ".join(
            f"COALESCE(CAST(SUM(amount) FILTER (transaction_type = '{name}') AS DOUBLE), 0) AS \"{name}\""
            for name in ("Deposit", "Withdrawal", "Transfer", "Payment")
        )
        + """, COALESCE(CAST(SUM(amount) FILTER (transaction_type IS NULL OR transaction_type NOT IN
            ('Deposit', 'Withdrawal', 'Transfer', 'Payment')) AS DOUBLE), 0) AS other"""
        + """ FROM fact f JOIN dim_customers c ON f.customer_id = c.customer_id GROUP BY account_type""",
        "chart5_anomaly_rate": f"""{_STAR} SELECT tx_year, tx_month, COUNT(*) AS total,
            COUNT(*) FILTER (is_anomaly) AS anomalies, {_PERIOD} AS period,
            {_ratio('COUNT(*) FILTER (is_anomaly) * 100', 'COUNT(*)', 2)} AS anomaly_rate
            FROM fact GROUP BY tx_year, tx_month""",
        "chart6_heatmap": f"""{_STAR},
            grid AS (SELECT CAST(d AS INTEGER) AS tx_day_of_week, CAST(h AS INTEGER) AS tx_hour
                     FROM generate_series(1, 7) AS a(d), generate_series(0, 23) AS b(h)),
            cells AS (SELECT tx_day_of_week, tx_hour, COUNT(transaction_id) AS tx_count
                      FROM grid LEFT JOIN fact USING (tx_day_of_week, tx_hour)
                      GROUP BY tx_day_of_week, tx_hour)
            SELECT tx_day_of_week,
                   CASE tx_day_of_week WHEN 1 THEN 'Sun' WHEN 2 THEN 'Mon' WHEN 3 THEN 'Tue'
                        WHEN 4 THEN 'Wed' WHEN 5 THEN 'Thu' WHEN 6 THEN 'Fri' ELSE 'Sat' END AS day_label,
                   tx_hour, lpad(CAST(tx_hour AS VARCHAR), 2, '0') || ':00' AS hour_label,
                   tx_count, tx_count > AVG(tx_count) OVER () AS above_mean
            FROM cells""",
        "kpi_summary": f"""{_STAR} SELECT COUNT(*) AS total_transactions, {_REVENUE} AS total_revenue,
            {_MEAN} AS avg_transaction, (SELECT COUNT(*) FROM dim_customers) AS total_customers,
            COUNT(*) FILTER (is_anomaly) AS anomalies,
            {_ratio('COUNT(*) FILTER (is_anomaly) * 100', 'COUNT(*)', 2)} AS anomaly_rate FROM fact""",
        "dq_null_critical": f"""{_RAW} SELECT *,
            {_STATUS.format('null_transaction_id + null_customer_id + null_amount + null_transaction_date')} AS status
            FROM (SELECT COUNT(*) FILTER (transaction_id IS NULL OR transaction_id = '') AS null_transaction_id,
                  COUNT(*) FILTER (customer_id IS NULL) AS null_customer_id,
                  COUNT(*) FILTER (amount IS NULL) AS null_amount,
                  COUNT(*) FILTER (transaction_date IS NULL) AS null_transaction_date FROM tx)""",
        "dq_amount_positive": f"""{_RAW} SELECT COUNT(*) AS invalid_count,
            {_STATUS.format('COUNT(*)')} AS status FROM tx WHERE amount <= 0""",
        "dq_duplicate_ids": f"""{_RAW} SELECT COUNT(*) - COUNT(DISTINCT transaction_id) AS duplicate_count,
            {_STATUS.format('COUNT(*) - COUNT(DISTINCT transaction_id)')} AS status FROM tx""",
        "dq_duplicate_lines": f"""SELECT SUM(n - 1)::BIGINT AS duplicate_count,
            {_STATUS.format('SUM(n - 1)')} AS status
            FROM (SELECT COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
        "dq_valid_types": _domain("transaction_type", _VALID_TYPES),
        "dq_valid_statuses": _domain("status", _VALID_STATUSES),
        "dq_amount_stats": f"""{_RAW},
            rounded AS (SELECT ROUND(amount, 2) AS amount FROM tx)
            SELECT COUNT(amount) AS amount_count, CAST(MIN(amount) AS DOUBLE) AS amount_min,
            CAST(MAX(amount) AS DOUBLE) AS amount_max,
            {_ratio(f'{_CENTS} * 10000', 'COUNT(amount)', 0)} / 1000000 AS amount_mean,
            ROUND(STDDEV_SAMP(CAST(amount AS DOUBLE)), 6) AS amount_stddev FROM rounded""",
        "dq_status_distribution": f"{_RAW} SELECT status, COUNT(*) AS row_count FROM tx GROUP BY status",
        "dq_type_distribution": f"""{_RAW} SELECT transaction_type, COUNT(*) AS row_count
            FROM tx GROUP BY transaction_type""",
        "dq_report": _CHECK_ROWS,
        "sink_quality_report": _CHECK_ROWS,
        "dq_constraints": _CONSTRAINT_ROWS,
        "dq_fk_integrity": f"""{_RAW} SELECT 'customer_id_reference' AS "check",
            {_STATUS.format('COUNT(*)')} AS status, COUNT(*) AS bad_count,
            {_figures(missing_keys="COUNT(DISTINCT customer_id)")} AS details
            FROM tx WHERE customer_id IS NOT NULL AND customer_id NOT IN (SELECT customer_id FROM cust)""",
        "dq_fk_orphans": """SELECT o_orderkey, COUNT(*) AS row_count FROM orders
            WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) GROUP BY o_orderkey""",
        "recon_counts": _RECONCILED,
        "recon_contents": f"""{_STAR}
            SELECT 'processed' AS stage, {_CLEAN_PRINTS} FROM clean
            UNION ALL SELECT 'fact_transactions', {_CLEAN_PRINTS} FROM fact
            UNION ALL SELECT 'raw_customers', {_CUSTOMER_PRINTS} FROM cust
            UNION ALL SELECT 'dim_customers', {_CUSTOMER_PRINTS} FROM dim_customers""",
        "recon_months": f"{_STAR} SELECT tx_year, tx_month, {_CLEAN_PRINTS} FROM clean GROUP BY tx_year, tx_month",
        "dim_customers_today": f"""{_RAW} SELECT * EXCLUDE (tenure_days),
            CAST(date_diff('day', join_date, current_date) AS INTEGER) AS tenure_days FROM dim_customers""",
        "batch_run_outputs": _RECONCILED,
        "batch_run_revenue": _Q2,
        "src_csv_transactions": _TX_ROWS,
        "src_csv_customers": _CUSTOMER_ROWS,
        "src_csv_multiline": "SELECT doc_id, NULLIF(text, '') AS text, lang, source, n_chars FROM documents",
        "sink_csv": _CLEAN_ROWS,
        "sink_parquet": _DIM_CUSTOMER_ROWS,
        "sink_parquet_by_type": _CLEAN_ROWS,
        "sink_parquet_by_month": _FACT_ROWS,
        "sink_parquet_clustered": _FACT_ROWS,
        "q2_bucketed": _Q2,
        "q3_bucketed": _TOP_CUSTOMERS,
        **{
            f"customers_by_{name}": f"{_STAR} SELECT {keys}, COUNT(DISTINCT customer_id) AS customers FROM fact GROUP BY {keys}"
            for name, keys in (
                ("month_type", "tx_year, tx_month, transaction_type"), ("year", "tx_year"), ("type", "transaction_type"),
            )
        },
        "sink_json": _Q1,
        "src_parquet_partitioned": f"""{_STAR} SELECT tx_year, tx_month, transaction_type,
            COUNT(*) AS row_count, {_REVENUE} AS revenue FROM fact GROUP BY ALL""",
        "src_warehouse": f"""{_STAR} SELECT d.year, d.month_name, c.account_type, t.type_name,
            COUNT(*) AS transaction_count, {_REVENUE} AS total_revenue
            FROM fact f JOIN dim_customers c ON f.customer_id = c.customer_id
            JOIN dim_date d ON f.date_key = d.date_key
            LEFT JOIN dim_type t ON f.type_key = t.type_key GROUP BY ALL""",
    }
