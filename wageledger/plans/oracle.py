"""The registered queries in DuckDB SQL, written from the definitions, to compare results with.

Each query lists the common table expressions it builds on; they are chained
into one WITH clause.
"""

from __future__ import annotations

from wageledger.operators.rollups import PAY_TYPES
from wageledger.operators.staging import MEASURES
from wageledger.plans.inputs import YEARS
from wageledger.plans.suite import declared
from wageledger.sources.order_ledger import SALT

AS_OF = "TIMESTAMP '2025-01-03 00:00:00'"
MARK = "TIMESTAMP '2025-01-02 12:00:00'"
STAMP = "'%Y-%m-%d %H:%M:%S'"


def _key(*parts: str) -> str:
    """The first 64 bits as a signed number; several parts are joined with their lengths in front."""
    texts = [f"CAST({p} AS VARCHAR)" for p in parts]
    text = parts[0] if len(parts) == 1 else " || ".join(f"length({t}) || ':' || {t}" for t in texts)
    high, low = (f"CAST('0x' || substr(sha256({text}), {at}, 8) AS BIGINT)" for at in (1, 9))
    return f"({high} - CASE WHEN {high} >= 2147483648 THEN 4294967296 ELSE 0 END) * 4294967296 + {low}"


def _label(column: str) -> str:
    return f"upper(trim(coalesce({column}, 'UNKNOWN')))"


def _date(column: str) -> str:
    return f"CAST(try_strptime({column}, '%m/%d/%Y') AS DATE)"


def _amount(column: str) -> str:
    return f"coalesce(TRY_CAST({column} AS DOUBLE), 0)"


SNAPSHOT = """
snapshot AS (
  SELECT
    CASE WHEN o_orderkey % 97 = 0 THEN 'FY' ELSE '' END || year(o_orderdate) AS Year,
    CASE WHEN o_custkey % 50 = 0 THEN NULL
         WHEN o_custkey % 3 = 0 THEN '  ' || c_name || ' ' ELSE c_name END AS Name,
    CASE WHEN o_orderkey % 89 = 0 THEN NULL
         WHEN o_orderkey % 5 = 0 THEN ' ' || lower(r_name) ELSE r_name END AS Working_Agency,
    strftime(date_trunc('year', o_orderdate) - to_days(CAST(CASE WHEN o_custkey % 2 = 1 THEN 365 ELSE 0 END AS INTEGER)),
             '%m/%d/%Y') AS Start_Date,
    CASE WHEN o_orderkey % 83 = 0 THEN '13/45/2025'
         WHEN o_orderstatus = 'F' THEN strftime(last_ship, '%m/%d/%Y') END AS Separation_Date,
    c_mktsegment AS Title,
    n_name AS Department,
    CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority END AS Pay_Basis,
    CASE WHEN o_orderkey % 79 = 0 THEN 'n/a' ELSE CAST(c_acctbal AS VARCHAR) END AS Hourly_Rate,
    CAST(pay_n AS VARCHAR) AS Regular_Pay,
    CAST(pay_r AS VARCHAR) AS Overtime_Pay,
    CAST(pay_af AS VARCHAR) AS Cash_Outs,
    CAST(pay_ao AS VARCHAR) AS Retro_Pay,
    '0.00' AS Other_Pay,
    CAST(coalesce(pay_n, 0) + coalesce(pay_r, 0) + coalesce(pay_af, 0) + coalesce(pay_ao, 0) AS VARCHAR) AS Total_Earnings,
    strftime(o_orderdate, '%m/%d/%Y') AS Updated_At,
    o_orderkey AS record_id
  FROM orders
  LEFT JOIN (
    SELECT l_orderkey,
      sum(CAST(l_extendedprice AS DECIMAL(18, 2))) FILTER (l_returnflag = 'N') AS pay_n,
      sum(CAST(l_extendedprice AS DECIMAL(18, 2))) FILTER (l_returnflag = 'R') AS pay_r,
      sum(CAST(l_extendedprice AS DECIMAL(18, 2))) FILTER (l_returnflag = 'A' AND l_linestatus = 'F') AS pay_af,
      sum(CAST(l_extendedprice AS DECIMAL(18, 2))) FILTER (l_returnflag = 'A' AND l_linestatus <> 'F') AS pay_ao,
      max(l_shipdate) AS last_ship
    FROM lineitem GROUP BY l_orderkey
  ) pay ON l_orderkey = o_orderkey
  JOIN customer ON c_custkey = o_custkey
  JOIN nation ON n_nationkey = c_nationkey
  JOIN region ON r_regionkey = n_regionkey
)"""

RAW = f"""
raw AS (
  SELECT * EXCLUDE (Name),
    CASE WHEN record_id % 101 <> 0
         THEN substr(sha256(trim(coalesce(Name, 'UNKNOWN_EMPLOYEE')) || '{SALT}'), 1, 16) END AS name_hash,
    TIMESTAMP '2025-01-01' + to_days(CAST(record_id % 4 AS INTEGER)) AS raw_ingested_at,
    'payroll_' || (record_id % 4) || '.csv' AS source_file
  FROM snapshot
)"""

STG = f"""
stg AS (
  SELECT
    TRY_CAST(Year AS BIGINT) AS fiscal_year,
    trim(name_hash) AS name_hash,
    {_label("Working_Agency")} AS agency_name,
    {_label("Title")} AS job_title,
    {_label("Department")} AS department_name,
    {_label("Pay_Basis")} AS pay_basis,
    {_date("Start_Date")} AS start_date,
    {_date("Separation_Date")} AS separation_date,
    {_date("Updated_At")} AS record_updated_at,
    {_amount("Hourly_Rate")} AS hourly_rate,
    {_amount("Regular_Pay")} AS regular_pay,
    {_amount("Overtime_Pay")} AS overtime_pay,
    {_amount("Cash_Outs")} AS cash_outs,
    {_amount("Retro_Pay")} AS retro_pay,
    {_amount("Other_Pay")} AS other_pay,
    {_amount("Total_Earnings")} AS total_earnings,
    source_file,
    raw_ingested_at
  FROM raw
)"""


def _employees(name: str, source: str, where: str = "TRUE") -> str:
    """The golden record per person and position, as a table expression."""
    key = _key("name_hash", "agency_name", "job_title", "coalesce(CAST(start_date AS VARCHAR), '0001-01-01')")
    return f"""
{name} AS (
  SELECT {key} AS employee_key,
    name_hash, start_date, separation_date, agency_name, department_name, job_title, pay_basis
  FROM {source}
  WHERE {where}
  QUALIFY row_number() OVER (
    PARTITION BY name_hash, agency_name, job_title, start_date
    ORDER BY coalesce(separation_date, DATE '9999-12-31') DESC, raw_ingested_at DESC NULLS LAST,
      source_file DESC NULLS LAST, department_name NULLS LAST, pay_basis NULLS LAST, separation_date NULLS LAST) = 1
)"""


EMP = _employees("emp", "stg")

# Keys found by joining the dimensions, record by record.
FACT = f"""
fact AS (
  SELECT {_key("k.employee_key", "k.agency_key", "k.title_key", "k.fiscal_year")} AS payroll_key,
    k.employee_key, k.agency_key, k.title_key AS job_title_key, k.fiscal_year,
    {", ".join("k." + m for m in MEASURES)}, k.record_updated_at, k.raw_ingested_at
  FROM (
    SELECT s.*, e.employee_key, a.agency_key, t.title_key
    FROM stg s
    LEFT JOIN emp e ON e.name_hash = s.name_hash AND e.agency_name = s.agency_name
      AND e.job_title = s.job_title AND e.start_date IS NOT DISTINCT FROM s.start_date
    LEFT JOIN (SELECT DISTINCT agency_name, {_key("agency_name")} AS agency_key FROM stg) a
      ON a.agency_name = s.agency_name
    LEFT JOIN (SELECT DISTINCT job_title, {_key("job_title")} AS title_key FROM stg) t
      ON t.job_title = s.job_title
  ) k
)"""

WIDE = f"""
wide AS (
  SELECT f.payroll_key, f.employee_key, f.agency_key, f.job_title_key,
    e.name_hash, e.start_date, e.separation_date, e.pay_basis, e.department_name,
    a.agency_name, t.job_title, f.fiscal_year,
    {", ".join("f." + m for m in MEASURES)}, f.record_updated_at, f.raw_ingested_at
  FROM fact f
  LEFT JOIN emp e USING (employee_key)
  LEFT JOIN (SELECT DISTINCT {_key("agency_name")} AS agency_key, agency_name FROM stg) a USING (agency_key)
  LEFT JOIN (SELECT DISTINCT {_key("job_title")} AS job_title_key, job_title FROM stg) t USING (job_title_key)
)"""

KPIS = """
kpis AS (
  SELECT fiscal_year, agency_name, count(DISTINCT employee_key) AS headcount, sum(total_earnings) AS payroll,
    sum(overtime_pay) AS overtime, sum(regular_pay) AS regular, count(*) AS records
  FROM wide GROUP BY ALL
)"""

MOVES = """
moves AS (
  SELECT fiscal_year, agency_name, job_title, kind, count(DISTINCT employee_key) AS n
  FROM (
    SELECT *, 'Hire' AS kind, start_date AS moved_on FROM wide
    UNION ALL BY NAME
    SELECT *, 'Separation' AS kind, separation_date AS moved_on FROM wide
  )
  WHERE year(moved_on) = fiscal_year
  GROUP BY ALL
)"""

BASE = [SNAPSHOT, RAW, STG]
STAR = [*BASE, EMP, FACT, WIDE]

OLD_EMP = _employees("old_emp", "stg", f"raw_ingested_at < {AS_OF}")
NEW_EMP = _employees("new_emp", "stg", f"raw_ingested_at > {MARK}")

_AMOUNTS = ", ".join(f"round({m}, 2) AS {m}" for m in MEASURES)
_STAMPED = f"strftime(raw_ingested_at, {STAMP}) AS raw_ingested_at"
_DATED = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in ("start_date", "separation_date"))
_STAGED = f"""fiscal_year, name_hash, agency_name, job_title, department_name, pay_basis, {_DATED},
  CAST(record_updated_at AS VARCHAR) AS record_updated_at, {_AMOUNTS}, source_file, {_STAMPED}"""
_PERSON = f"employee_key, name_hash, {_DATED}, agency_name, department_name, job_title, pay_basis"
_WIDE = f"""payroll_key, employee_key, agency_key, job_title_key, name_hash, {_DATED}, pay_basis, department_name,
  agency_name, job_title, fiscal_year, {_AMOUNTS}, CAST(record_updated_at AS VARCHAR) AS record_updated_at, {_STAMPED}"""

_STG_COLUMNS = (
    "fiscal_year name_hash agency_name job_title department_name pay_basis start_date separation_date "
    "record_updated_at " + " ".join(MEASURES) + " source_file raw_ingested_at"
).split()



def _relation(name: str, child: str, column: str, parent: str, parent_column: str) -> str:
    """One row: how many values and rows of the child have no parent."""
    orphan = "id IS NULL"
    return f"""SELECT '{name}' AS relation, count(*) AS child_values, CAST(sum(n) AS BIGINT) AS child_rows,
          count(*) FILTER ({orphan}) AS orphan_values, CAST(coalesce(sum(n) FILTER ({orphan}), 0) AS BIGINT) AS orphan_rows
        FROM (SELECT {column} AS v, count(*) AS n FROM {child} WHERE {column} IS NOT NULL GROUP BY 1)
        LEFT JOIN (SELECT DISTINCT {parent_column} AS id FROM {parent}) ON id = v"""


# name -> (table expressions, final SELECT)
_QUERIES: dict[str, tuple[list[str], str]] = {
    "payroll_kpis": (
        [*STAR, KPIS],
        """SELECT fiscal_year, agency_name, headcount, round(payroll, 2) AS total_payroll,
             round(overtime, 2) AS total_overtime, round(regular, 2) AS total_regular_pay, records AS total_records
           FROM kpis""",
    ),
    "overtime_by_job": (
        STAR,
        """SELECT fiscal_year, agency_name, job_title, round(sum(overtime_pay), 2) AS total_overtime_pay,
             round(sum(regular_pay), 2) AS total_regular_pay,
             round(sum(total_earnings), 2) AS total_earnings_combined, count(*) AS employee_count
           FROM wide GROUP BY ALL""",
    ),
    "hr_dynamics": (
        [*STAR, MOVES],
        "SELECT fiscal_year, agency_name, job_title, kind AS event_type, n AS volume_events FROM moves",
    ),
    "payroll_composition": (
        STAR,
        " UNION ALL ".join(
            f"SELECT fiscal_year, agency_name, '{kind}' AS pay_type, round(sum({column}), 2) AS total_amount "
            "FROM wide GROUP BY fiscal_year, agency_name"
            for column, kind in PAY_TYPES.items()
        ),
    ),
    "overtime_share_total": (
        [*STAR, KPIS],
        """SELECT round(sum(overtime), 2) AS total_overtime, round(sum(payroll), 2) AS total_payroll,
             round(sum(overtime) / nullif(sum(payroll), 0), 6) AS overtime_share FROM kpis""",
    ),
    "overtime_share_agency": (
        [*STAR, KPIS],
        """SELECT fiscal_year, agency_name, round(overtime / nullif(payroll, 0), 6) AS overtime_share,
             overtime / nullif(payroll, 0) > 0.33 AS is_critical FROM kpis""",
    ),
    "overtime_share_job": (
        STAR,
        """SELECT fiscal_year, agency_name, job_title,
             round(sum(overtime_pay) / nullif(sum(total_earnings), 0), 6) AS overtime_share
           FROM wide GROUP BY ALL""",
    ),
    "workforce_balance": (
        [*STAR, MOVES],
        """SELECT *, hires - separations AS net_balance FROM (
             SELECT fiscal_year, agency_name,
               CAST(coalesce(sum(n) FILTER (kind = 'Hire'), 0) AS BIGINT) AS hires,
               CAST(coalesce(sum(n) FILTER (kind = 'Separation'), 0) AS BIGINT) AS separations
             FROM moves GROUP BY ALL)""",
    ),
    "workforce_balance_job": (
        [*STAR, MOVES],
        """SELECT *, hires - separations AS net_balance FROM (
             SELECT fiscal_year, agency_name, job_title,
               CAST(coalesce(sum(n) FILTER (kind = 'Hire'), 0) AS BIGINT) AS hires,
               CAST(coalesce(sum(n) FILTER (kind = 'Separation'), 0) AS BIGINT) AS separations
             FROM moves GROUP BY ALL)""",
    ),
    "headcount_payroll_corr": (
        [*STAR, KPIS],
        """SELECT fiscal_year, round(corr(headcount, payroll), 6) AS headcount_payroll_corr, count(*) AS agencies
           FROM kpis GROUP BY fiscal_year""",
    ),
    "one_big_table": (STAR, f"SELECT {_WIDE} FROM wide"),
    "wide_records": (STAR, f"SELECT {_WIDE} FROM wide"),
    "fact_keys": (
        [*BASE, EMP, FACT],
        f"""SELECT payroll_key, employee_key, agency_key, job_title_key, fiscal_year, {_AMOUNTS},
              CAST(record_updated_at AS VARCHAR) AS record_updated_at, {_STAMPED} FROM fact""",
    ),
    "dim_agency": (BASE, f"SELECT DISTINCT {_key('agency_name')} AS agency_key, agency_name FROM stg"),
    "dim_job_title": (BASE, f"SELECT DISTINCT {_key('job_title')} AS job_title_key, job_title FROM stg"),
    "latest_employee": ([*BASE, EMP], f"SELECT {_PERSON} FROM emp"),
    "latest_event": (
        [],
        f"""SELECT user_id, event_type, strftime(ts, {STAMP}) AS ts, event_id, round(value, 2) AS value
            FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
    ),
    "calendar": (
        [],
        """SELECT strftime(d, '%Y-%m-%d') AS calendar_key, strftime(d, '%Y-%m-%d') AS full_date,
             year(d) AS year, CAST(strftime(d, '%U') AS BIGINT) AS year_week, day(d) AS year_day,
             year(d) AS fiscal_year, CAST(quarter(d) AS VARCHAR) AS fiscal_qtr, month(d) AS month,
             strftime(d, '%B') AS month_name, strftime(d, '%w') AS week_day, strftime(d, '%A') AS day_name,
             CAST(CASE WHEN strftime(d, '%w') IN ('0', '6') THEN 0 ELSE 1 END AS BIGINT) AS day_is_weekday
           FROM (SELECT unnest(generate_series(CAST(CAST(min(o_orderdate) AS DATE) AS TIMESTAMP),
             CAST(CAST(max(o_orderdate) AS DATE) AS TIMESTAMP), INTERVAL 1 DAY)) AS d FROM orders)""",
    ),
    "stage_records": (BASE, f"SELECT {_STAGED} FROM stg"),
    "latest_snapshot": (
        BASE,
        f"SELECT {_STAGED} FROM stg WHERE stg.raw_ingested_at = (SELECT max(raw_ingested_at) FROM stg)",
    ),
    "anonymize_names": (
        [SNAPSHOT],
        f"""SELECT record_id, substr(sha256(trim(coalesce(Name, 'UNKNOWN_EMPLOYEE')) || '{SALT}'), 1, 16) AS name_hash
            FROM snapshot""",
    ),
    "fill_names": ([SNAPSHOT], "SELECT record_id, trim(coalesce(Name, 'UNKNOWN_EMPLOYEE')) AS Name FROM snapshot"),
    "missing_names": (
        [SNAPSHOT],
        "SELECT count(*) FILTER (Name IS NULL) AS missing_names, count(*) AS total_rows FROM snapshot",
    ),
    "customer_name_hash": (
        [],
        f"SELECT c_custkey, substr(sha256(c_name || '{SALT}'), 1, 16) AS name_hash FROM customer",
    ),
    "new_source_files": (
        [SNAPSHOT, RAW],
        f"""SELECT DISTINCT source_file FROM raw WHERE source_file NOT IN
              (SELECT source_file FROM raw WHERE raw_ingested_at < {AS_OF})""",
    ),
    "raw_append_audit": (
        [SNAPSHOT, RAW],
        """SELECT record_id, Year, name_hash, Total_Earnings, '2025-02-01 00:00:00' AS raw_ingested_at, source_file
           FROM raw""",
    ),
    "incremental_since": (BASE, f"SELECT {_STAGED} FROM stg WHERE stg.raw_ingested_at > {MARK}"),
    "merge_upsert": (
        [*BASE, OLD_EMP, NEW_EMP],
        f"""SELECT {_PERSON}, '2025-01-02 12:00:00' AS dbt_updated_at FROM old_emp o
              WHERE NOT EXISTS (SELECT 1 FROM new_emp n WHERE n.employee_key = o.employee_key)
            UNION ALL
            SELECT {_PERSON}, '2025-02-01 00:00:00' AS dbt_updated_at FROM new_emp""",
    ),
    "lineitem_composition": (
        [],
        " UNION ALL ".join(
            f"SELECT l_returnflag, l_linestatus, '{c}' AS measure, round(sum(l_{c}), 2) AS total "
            "FROM lineitem GROUP BY l_returnflag, l_linestatus"
            for c in ("quantity", "extendedprice", "discount", "tax")
        ),
    ),
    "dq_not_null": (
        BASE,
        "SELECT * FROM ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_rows FROM stg" for c in _STG_COLUMNS
        )
        + ") WHERE null_rows > 0",
    ),
    "dq_unique": (
        [*BASE, EMP, FACT],
        """SELECT payroll_key AS value, count(*) AS n_records FROM fact
           WHERE payroll_key IS NOT NULL GROUP BY 1 HAVING count(*) > 1""",
    ),
    "dq_unique_documents": (
        [],
        "SELECT sha256(text) AS text_sha256, count(*) AS n_records FROM documents GROUP BY text HAVING count(*) > 1",
    ),
    "dq_in_set": (
        BASE,
        f"SELECT fiscal_year AS value, count(*) AS n_records FROM stg WHERE fiscal_year NOT IN {YEARS} GROUP BY 1",
    ),
    "dq_conversation_roles": (
        [],
        "SELECT role AS value, count(*) AS n_records FROM conversations WHERE role <> 'user' GROUP BY 1",
    ),
    "dq_between": (BASE, f"SELECT {_STAGED} FROM stg WHERE NOT (stg.total_earnings BETWEEN 1000 AND 450000)"),
    "dq_range": (
        [*STAR, KPIS],
        """SELECT fiscal_year, agency_name, headcount, round(payroll, 2) AS total_payroll,
             round(overtime, 2) AS total_overtime, round(regular, 2) AS total_regular_pay, records AS total_records
           FROM kpis WHERE records < 100""",
    ),
    "dq_relationships": (
        [*BASE, EMP, FACT],
        " UNION ALL ".join(
            _relation(f"fct_payroll.{key}", "fact", key, parent, key)
            for key, parent in (
                ("employee_key", "emp"),
                ("agency_key", f"(SELECT {_key('agency_name')} AS agency_key FROM stg)"),
                ("job_title_key", f"(SELECT {_key('job_title')} AS job_title_key FROM stg)"),
            )
        ),
    ),
    "dq_orphan_lineitems": ([], _relation("lineitem.l_orderkey", "lineitem", "l_orderkey", "orders", "o_orderkey")),
    "dq_orphan_labels": ([], _relation("labels.doc_id", "labels", "doc_id", "documents", "doc_id")),
    "dq_late_employees": (
        [*BASE, EMP, FACT, OLD_EMP],
        """SELECT employee_key AS value, count(*) AS n_records FROM fact f WHERE employee_key IS NOT NULL
             AND NOT EXISTS (SELECT 1 FROM old_emp o WHERE o.employee_key = f.employee_key) GROUP BY 1""",
    ),
    "dq_declared_ranges": (
        [*STAR, KPIS],
        " UNION ALL ".join(
            f"SELECT '{name}' AS column_name, count(*) FILTER ({column} < {low}) AS out_of_range FROM kpis"
            for name, column, low in (
                ("headcount", "headcount", 1),
                ("total_payroll", "payroll", 0),
                ("total_overtime", "overtime", 0),
                ("total_regular_pay", "regular", 0),
            )
        ),
    ),
    "dq_document_ids": (
        [],
        """SELECT count(*) AS ids, count(*) FILTER (n > 1) AS repeated_ids
           FROM (SELECT doc_id, count(*) AS n FROM documents WHERE doc_id IS NOT NULL GROUP BY doc_id)""",
    ),
    "totals_agree": (
        STAR,
        """SELECT round(sum(total_earnings), 2) AS src_total_payroll, round(sum(overtime_pay), 2) AS src_total_overtime,
             round(sum(regular_pay), 2) AS src_total_regular_pay, round(sum(total_earnings), 2) AS view_total_payroll,
             round(sum(overtime_pay), 2) AS view_total_overtime, round(sum(regular_pay), 2) AS view_total_regular_pay,
             TRUE AS is_reconciled
           FROM wide""",
    ),
    "landed_round_trip": (
        [SNAPSHOT],
        """SELECT name_hash, agency, n_records FROM (
             SELECT substr(sha256(trim(coalesce(Name, 'UNKNOWN_EMPLOYEE')) || '%s'), 1, 16) AS name_hash,
               Working_Agency || chr(10) || Department AS agency, count(*) AS n_records
             FROM snapshot GROUP BY ALL)""" % SALT,
    ),
    "reconcile_totals": (
        STAR,
        """SELECT * FROM (
              SELECT round(sum(total_earnings), 2) AS src_total_payroll, round(sum(overtime_pay), 2) AS src_total_overtime,
                round(sum(regular_pay), 2) AS src_total_regular_pay,
                round(sum(total_earnings) FILTER (fiscal_year IS NOT NULL), 2) AS view_total_payroll,
                round(sum(overtime_pay) FILTER (fiscal_year IS NOT NULL), 2) AS view_total_overtime,
                round(sum(regular_pay) FILTER (fiscal_year IS NOT NULL), 2) AS view_total_regular_pay
              FROM wide)
            WHERE abs(src_total_payroll - view_total_payroll) > 0.01
              OR abs(src_total_overtime - view_total_overtime) > 0.01
              OR abs(src_total_regular_pay - view_total_regular_pay) > 0.01""",
    ),
    "reconcile_files": (
        [SNAPSHOT, RAW],
        """SELECT count(DISTINCT source_file) AS landed_files, count(DISTINCT source_file) AS loaded_files,
             count(*) AS loaded_rows, TRUE AS is_reconciled FROM raw""",
    ),
}


GOLDEN = _employees("gold", "stg", "source_file <> 'payroll_3.csv'")


def _quarantine() -> str:
    """Each staged row's broken rules, in the order they are declared."""
    rules = declared(YEARS)["stg_payroll"]
    tests = [f"CASE WHEN {c} IS NULL THEN 'not_null({c})' END" for c in rules.not_null if c != "stg_processed_at"]
    tests.append(f"CASE WHEN fiscal_year NOT IN ({', '.join(map(str, YEARS))}) THEN 'in_set(fiscal_year)' END")
    tests.append("CASE WHEN total_earnings < -100000 OR total_earnings > 1000000 THEN 'between(total_earnings)' END")
    listed = f"array_to_string(list_filter([{', '.join(tests)}], lambda r: r IS NOT NULL), ', ')"
    return f"""SELECT CASE WHEN rules = '' THEN 'none' ELSE rules END AS rules, count(*) AS n_records
        FROM (SELECT {listed} AS rules FROM stg) GROUP BY 1"""


_REPORT = """fiscal_year, agency_name, job_title, round(sum(overtime_pay), 2) AS total_overtime_pay,
  round(sum(regular_pay), 2) AS total_regular_pay, round(sum(total_earnings), 2) AS total_earnings_combined, count(*) AS employee_count"""

_HEADCOUNT = "count(DISTINCT employee_key) AS headcount FROM wide WHERE employee_key IS NOT NULL"

_QUERIES |= {
    "table_versions": (
        [*BASE, EMP, OLD_EMP],
        " UNION ALL ".join(
            f"""SELECT '{version}' AS version, agency_name, count(*) AS positions,
                  count(*) FILTER (separation_date IS NULL) AS open_positions FROM {source} GROUP BY agency_name"""
            for version, source in (("before", "old_emp"), ("now", "emp"))
        ),
    ),
    "bucket_merge": _QUERIES["merge_upsert"],
    "golden_state": ([*BASE, GOLDEN], f"SELECT {_PERSON} FROM gold"),
    "aggregate_refresh": (STAR, f"SELECT {_REPORT} FROM wide WHERE raw_ingested_at <> TIMESTAMP '2025-01-02 00:00:00' GROUP BY ALL"),
    "headcount_bitmaps": (
        STAR,
        f"""SELECT 'group' AS level, fiscal_year, agency_name, {_HEADCOUNT} GROUP BY fiscal_year, agency_name
            UNION ALL SELECT 'agency', NULL, agency_name, {_HEADCOUNT} GROUP BY agency_name
            UNION ALL SELECT 'year', fiscal_year, NULL, {_HEADCOUNT} GROUP BY fiscal_year
            UNION ALL SELECT 'all', NULL, NULL, {_HEADCOUNT}""",
    ),
    "quoted_records": (
        [SNAPSHOT, RAW],
        """SELECT name_hash, Working_Agency || chr(10) || '"' || Department || '"' || chr(10) || ',' AS agency, count(*) AS n_records
           FROM raw GROUP BY ALL""",
    ),
    "changed_files": (
        [SNAPSHOT, RAW],
        """SELECT DISTINCT source_file,
             CASE source_file WHEN 'payroll_0.csv' THEN 'same' WHEN 'payroll_3.csv' THEN 'new' ELSE 'suspect' END AS kind,
             source_file IN ('payroll_1.csv', 'payroll_3.csv') AS is_read FROM raw""",
    ),
    "ingest_twice": (
        [SNAPSHOT, RAW],
        """SELECT source_file, count(*) AS n_records, CAST(1 AS BIGINT) AS load_times,
             CAST(substr(source_file, 9, 1) AS BIGINT) // 2 AS hour, CAST(substr(source_file, 9, 1) AS BIGINT) % 2 AS place
           FROM raw WHERE name_hash IS NOT NULL GROUP BY source_file""",
    ),
    "partitioned_table": (
        [*BASE, EMP, FACT],
        f"""SELECT fiscal_year, agency_key, round(sum(total_earnings), 2) AS total, count(*) AS n_records FROM fact
            WHERE fiscal_year < {YEARS[2]} OR raw_ingested_at >= {AS_OF} GROUP BY fiscal_year, agency_key""",
    ),
    "stored_aggregate": (
        STAR,
        f"SELECT {_REPORT} FROM wide WHERE raw_ingested_at < {AS_OF} OR fiscal_year >= {YEARS[1]} GROUP BY ALL",
    ),
    "stored_views": (
        [*STAR, KPIS, MOVES],
        """SELECT k.fiscal_year, k.agency_name, headcount, round(payroll, 2) AS total_payroll, round(overtime, 2) AS total_overtime,
             round(regular, 2) AS total_regular_pay, records AS total_records, CAST(coalesce(events, 0) AS BIGINT) AS events,
             CAST(5 AS BIGINT) AS pay_types
           FROM kpis k LEFT JOIN (SELECT fiscal_year, agency_name, sum(n) AS events FROM moves GROUP BY ALL) m
             ON m.fiscal_year IS NOT DISTINCT FROM k.fiscal_year AND m.agency_name IS NOT DISTINCT FROM k.agency_name""",
    ),
    "dq_quarantine": (BASE, _quarantine()),
}


def oracle_sql() -> dict[str, str]:
    return {
        name: (f"WITH {','.join(parts)}\n{final}" if parts else final) for name, (parts, final) in _QUERIES.items()
    }
