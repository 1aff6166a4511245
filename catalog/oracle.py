"""The same results as `queries.py`, in SQL for DuckDB over the same tables."""

from __future__ import annotations

FIRST_MONTH = 1995 * 12


def log_sql(months: int = 6) -> str:
    first = FIRST_MONTH // months
    return f"""
base AS (
  SELECT o_orderkey AS k, o_custkey AS c, CAST(floor(o_totalprice) AS BIGINT) AS p,
         CAST(o_orderdate AS DATE) AS d, o_orderstatus AS st, o_orderpriority AS pr,
         CAST((year(o_orderdate) * 12 + month(o_orderdate) - 1) // {months} AS INTEGER)
           - {first} + 1 AS batch_seq
  FROM orders),
numbers AS (
  SELECT *,
         CASE WHEN k % 31 = 0 THEN NULL WHEN k % 37 = 0 THEN concat(p, '.5')
              ELSE concat(p, '.0') END AS annual,
         p % 20000 AS reliefs, d + CAST(k % 400 AS INTEGER) AS filed
  FROM base),
log AS (
  SELECT CASE WHEN k % 211 = 0 THEN NULL ELSE concat('T', c) END AS taxpayer_id,
         CASE WHEN k % 11 = 0 THEN NULL WHEN k % 13 = 0 THEN 'INVALID_NRIC'
              WHEN k % 53 = 0 THEN '  S0000001A  '
              ELSE concat('S', lpad(CAST(c % 10000000 AS VARCHAR), 7, '0'), 'A') END AS nric,
         concat('Customer ', c, CASE WHEN k % 3 = 0 THEN ' Jr' ELSE '' END) AS full_name,
         CASE WHEN c % 2 = 0 THEN 'Single' ELSE 'Married' END AS filing_status,
         CASE WHEN k % 101 = 0 THEN 'unknown' WHEN k % 97 = 0 THEN concat(year(d), '.0')
              WHEN k % 10 = 5 THEN CAST(year(d) - 1 AS VARCHAR)
              ELSE CAST(year(d) AS VARCHAR) END AS assessment_year,
         CASE WHEN k % 17 = 0 THEN 'invalid-date' WHEN k % 19 = 0 THEN '2024-02-30'
              WHEN k % 23 = 0 THEN strftime(filed, '%Y/%m/%d')
              WHEN k % 29 = 0 THEN concat(' ', strftime(filed, '%Y-%m-%d'), ' ')
              ELSE strftime(filed, '%Y-%m-%d') END AS filing_date,
         annual AS annual_income_sgd,
         CAST(p - reliefs + CASE WHEN k % 7 = 0 THEN 1000 ELSE 0 END AS VARCHAR)
           AS chargeable_income_sgd,
         CAST(p // 10 AS VARCHAR) AS tax_payable_sgd,
         CASE WHEN k % 43 = 0 THEN 'n/a' ELSE CAST(p // 11 AS VARCHAR) END AS tax_paid_sgd,
         CAST(reliefs AS VARCHAR) AS total_reliefs_sgd,
         CAST(c % 4 AS VARCHAR) AS number_of_dependents,
         pr AS occupation,
         CASE WHEN k % 5 = 0 THEN 'Non-Resident' ELSE 'Resident' END AS residential_status,
         CASE WHEN c % 47 = 0 THEN 'BADPOST'
              ELSE lpad(CAST(c % 1000000 AS VARCHAR), 6, '0') END AS postal_code,
         CASE st WHEN 'F' THEN 'HDB 4-room' WHEN 'O' THEN 'Private Condo'
                 ELSE 'Landed Property' END AS housing_type,
         CASE WHEN k % 23 = 1 THEN '0' ELSE CAST(p // 5 AS VARCHAR) END
           AS cpf_contributions_sgd,
         CASE WHEN k % 59 = 0 THEN '1e3' ELSE '0' END AS foreign_income_sgd,
         CASE WHEN k % 9 = 0 THEN NULL ELSE concat('EMP', p % 130) END AS employer_id,
         CASE WHEN batch_seq = 1 THEN NULL
              ELSE strftime(DATE '1995-01-01' + to_months(CAST(batch_seq * {months} AS INTEGER)),
                            '%Y-%m-%d') END AS batch_date,
         CASE WHEN batch_seq = 1 THEN 'new' WHEN k % 10 IN (0, 1, 2) THEN 'update' WHEN k % 10 IN (3, 4) THEN 'correction'
              WHEN k % 10 = 5 THEN 'late_arrival' ELSE 'new' END AS record_type,
         concat('day', batch_seq) AS batch, batch_seq, k AS row_pos
  FROM numbers)"""


LOG = log_sql()

FLAGS = """
flags AS (
  SELECT *,
    trim(coalesce(nric, '')) <> '' AS dq_rule1_nric_present_pass,
    regexp_full_match(trim(coalesce(nric, '')), '[STFG][0-9]{7}[A-Z]') AS dq_rule2_nric_format_pass,
    regexp_full_match(trim(postal_code), '[0-9]{6}') AS dq_rule3_postal_code_pass,
    coalesce(CASE WHEN regexp_full_match(filing_date, '[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}')
                  THEN year(TRY_CAST(filing_date AS DATE)) END
             > TRY_CAST(assessment_year AS DOUBLE), false) AS dq_rule4_filing_date_after_ay_pass,
    coalesce(TRY_CAST(chargeable_income_sgd AS DOUBLE)
             = TRY_CAST(annual_income_sgd AS DOUBLE) - TRY_CAST(total_reliefs_sgd AS DOUBLE), false)
      AS dq_rule5_chargeable_income_pass,
    coalesce(residential_status <> 'Resident', true)
      OR coalesce(TRY_CAST(cpf_contributions_sgd AS DOUBLE) > 0, false)
      AS dq_rule6_cpf_resident_pass
  FROM log),
domains AS (
  SELECT *,
    dq_rule1_nric_present_pass AS dq_completeness_pass,
    dq_rule2_nric_format_pass AND dq_rule3_postal_code_pass
      AND dq_rule4_filing_date_after_ay_pass AS dq_validity_pass,
    dq_rule5_chargeable_income_pass AND dq_rule6_cpf_resident_pass AS dq_accuracy_pass
  FROM flags),
long AS (
  SELECT batch, batch_seq, 'completeness' AS domain, dq_completeness_pass AS ok FROM domains
  UNION ALL SELECT batch, batch_seq, 'validity', dq_validity_pass FROM domains
  UNION ALL SELECT batch, batch_seq, 'accuracy', dq_accuracy_pass FROM domains)"""

SCORE = """
       round_even(CAST(sum(CAST(ok AS INTEGER)) AS DOUBLE) / count(*) * 100.0, 2) AS score,
       CAST(sum(CAST(ok AS INTEGER)) AS BIGINT) AS passing_count, count(*) AS total_count"""

# Versions in the order in which the statements of a load act: a taxpayer not seen before
# is inserted, corrections overwrite the current version, then updates are compared with
# it. Attributes that change together are carried as one struct.
VERSIONS = """
ok AS (
  SELECT * REPLACE (TRY_CAST(assessment_year AS INTEGER) AS assessment_year)
  FROM log
  WHERE taxpayer_id IS NOT NULL AND TRY_CAST(assessment_year AS INTEGER) IS NOT NULL),
steps AS (
  SELECT *, CASE record_type WHEN 'correction' THEN 1 WHEN 'update' THEN 2 ELSE 0 END AS step,
         min(batch_seq) OVER (PARTITION BY taxpayer_id) AS first_seq FROM ok),
last_of_step AS (
  SELECT *, batch_seq * 3 + step AS turn,
         {'a': occupation, 'b': postal_code, 'c': housing_type, 'd': residential_status,
          'e': filing_status, 'f': number_of_dependents} AS tracked
  FROM steps
  QUALIFY row_number() OVER (PARTITION BY batch_seq, taxpayer_id, step ORDER BY row_pos DESC) = 1),
inserted AS (
  SELECT *, true AS fresh FROM last_of_step WHERE batch_seq = first_seq
  QUALIFY row_number() OVER (PARTITION BY taxpayer_id
                             ORDER BY CAST(step > 0 AS INTEGER) DESC, row_pos DESC) = 1),
acting AS (
  SELECT *, lag(tracked) OVER (PARTITION BY taxpayer_id ORDER BY turn) AS before
  FROM (SELECT * FROM inserted UNION ALL
        SELECT *, false FROM last_of_step WHERE batch_seq > first_seq AND step > 0)),
opening AS (
  SELECT *, fresh OR (step = 2 AND tracked IS DISTINCT FROM before) AS opens FROM acting),
grouped AS (
  SELECT *, CAST(sum(CAST(opens AS INTEGER)) OVER (
              PARTITION BY taxpayer_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS INTEGER)
            AS version
  FROM opening),
merged AS (
  SELECT taxpayer_id, version,
         max_by(tracked, turn) AS tracked,
         max_by({'n': nric, 'f': full_name}, turn) FILTER (WHERE opens OR step = 1) AS ident,
         max(CASE WHEN NOT opens THEN NULL WHEN fresh THEN TRY_CAST(filing_date AS DATE)
                  ELSE TRY_CAST(batch_date AS DATE) END) AS valid_from,
         min(batch_seq) AS opened_seq
  FROM grouped GROUP BY taxpayer_id, version),
versions AS (
  SELECT taxpayer_id, version, ident.n AS nric, ident.f AS full_name,
         tracked.e AS filing_status, tracked.a AS occupation, tracked.d AS residential_status,
         tracked.b AS postal_code, tracked.c AS housing_type, tracked.f AS number_of_dependents,
         valid_from,
         CASE WHEN lead(version) OVER w IS NULL THEN DATE '9999-12-31'
              ELSE lead(valid_from) OVER w END AS valid_to,
         lead(version) OVER w IS NULL AS is_current, opened_seq
  FROM merged WINDOW w AS (PARTITION BY taxpayer_id ORDER BY version))"""

RETURNS = """
returns AS (
  SELECT taxpayer_id, assessment_year, employer_id, TRY_CAST(filing_date AS DATE) AS filing_date,
         TRY_CAST(batch_date AS DATE) AS batch_date, record_type,
         TRY_CAST(annual_income_sgd AS DOUBLE) AS annual_income_sgd,
         TRY_CAST(chargeable_income_sgd AS DOUBLE) AS chargeable_income_sgd,
         TRY_CAST(tax_payable_sgd AS DOUBLE) AS tax_payable_sgd,
         TRY_CAST(tax_paid_sgd AS DOUBLE) AS tax_paid_sgd,
         TRY_CAST(total_reliefs_sgd AS DOUBLE) AS total_reliefs_sgd,
         TRY_CAST(cpf_contributions_sgd AS DOUBLE) AS cpf_contributions_sgd,
         TRY_CAST(foreign_income_sgd AS DOUBLE) AS foreign_income_sgd,
         record_type = 'correction' AS is_corrected, batch_seq
  FROM (SELECT *, row_number() OVER (PARTITION BY batch_seq, taxpayer_id, assessment_year
                                     ORDER BY row_pos DESC) AS rn FROM ok)
  WHERE rn = 1)"""

# Later versions are invisible to a fact, and the last visible one is open-ended.
FACTS = """
final AS (
  SELECT * FROM returns
  QUALIFY row_number() OVER (PARTITION BY taxpayer_id, assessment_year ORDER BY batch_seq DESC) = 1),
visible AS (
  SELECT f.taxpayer_id, f.assessment_year, f.filing_date, v.version, v.valid_from,
         CASE WHEN v.version = max(v.version) OVER (PARTITION BY f.taxpayer_id, f.assessment_year)
              THEN DATE '9999-12-31' ELSE v.valid_to END AS valid_to
  FROM final f JOIN versions v
    ON v.taxpayer_id = f.taxpayer_id AND v.opened_seq <= f.batch_seq),
links AS (
  SELECT taxpayer_id, assessment_year,
         coalesce(max(version) FILTER (WHERE filing_date >= valid_from AND filing_date < valid_to),
                  max(version)) AS version
  FROM visible GROUP BY taxpayer_id, assessment_year),
facts AS (
  SELECT f.* REPLACE (
           CASE WHEN f.employer_id IN (SELECT employer_id FROM employers) THEN f.employer_id
                ELSE 'UNKNOWN' END AS employer_id),
         l.version
  FROM final f JOIN links l USING (taxpayer_id, assessment_year))"""

EMPLOYERS = """
parsed AS (
  SELECT s_suppkey AS k, s_name, s_nationkey,
         s_suppkey % 31 = 30 OR s_suppkey % 37 = 36 AS no_id,
         s_suppkey % 7 = 0 OR s_suppkey % 11 = 0 AS no_uen,
         CASE WHEN s_suppkey % 13 = 0 THEN 'uncoercible employee_count'
              WHEN s_suppkey % 17 = 0 THEN 'invalid employee_count type'
              WHEN s_suppkey % 19 = 0 OR s_suppkey % 23 = 0 THEN 'missing employee_count'
              WHEN s_suppkey % 29 = 0 THEN 'uncoercible employee_count'
              WHEN s_suppkey % 5 = 0 THEN 'employee_count was non-integer; coerced' END AS count_issue,
         s_suppkey % 3 = 1 AS extra
  FROM supplier),
employers AS (
  SELECT CASE WHEN no_id THEN concat('UNKNOWN_', k) ELSE concat('EMP', k) END AS employer_id,
         s_name AS company_name, CASE WHEN NOT no_uen THEN concat('U', k) END AS uen,
         concat('N', s_nationkey) AS industry, concat(s_nationkey, ' Road') AS address,
         CASE WHEN count_issue IS NULL OR count_issue LIKE '%coerced' AND count_issue NOT LIKE 'unco%'
              THEN k * 3 END AS employee_count,
         no_id OR no_uen OR count_issue IS NOT NULL OR extra AS has_schema_issues,
         nullif(concat_ws('; ', CASE WHEN no_id THEN 'missing employer_id' END,
                                CASE WHEN no_uen THEN 'missing uen' END, count_issue,
                                CASE WHEN extra
                                     THEN 'extra fields: [''global_hq'', ''subsidiary_of'']' END), '')
           AS schema_issue_detail
  FROM parsed)"""

AUDIT = """
overwritten AS (
  SELECT *,
         lag({'a': annual_income_sgd, 'c': chargeable_income_sgd, 'p': tax_payable_sgd,
              'q': tax_paid_sgd, 'r': total_reliefs_sgd}) OVER w AS old,
         row_number() OVER w AS i
  FROM returns WINDOW w AS (PARTITION BY taxpayer_id, assessment_year ORDER BY batch_seq)),
audit AS (
  SELECT taxpayer_id, assessment_year, batch_date AS corrected_at,
         old.a AS old_annual_income_sgd, old.c AS old_chargeable_income_sgd,
         old.p AS old_tax_payable_sgd, old.q AS old_tax_paid_sgd,
         old.r AS old_total_reliefs_sgd, batch_seq
  FROM overwritten
  WHERE record_type = 'correction' AND i > 1
    AND old IS DISTINCT FROM {'a': annual_income_sgd, 'c': chargeable_income_sgd,
                              'p': tax_payable_sgd, 'q': tax_paid_sgd, 'r': total_reliefs_sgd}
  QUALIFY row_number() OVER (PARTITION BY taxpayer_id, assessment_year, old ORDER BY batch_seq) = 1)"""


def with_(*parts: str, months: int | None = None) -> str:
    return "WITH " + ",".join(log_sql(months) if months and p is LOG else p for p in parts) + "\n"


HISTORY = (LOG, VERSIONS)
FULL = (LOG, VERSIONS, RETURNS, EMPLOYERS, FACTS)

VERSION_COLUMNS = """taxpayer_id, version, nric, full_name, filing_status, occupation,
       residential_status, postal_code, housing_type, number_of_dependents,
       CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to, is_current"""
FACT_COLUMNS = """taxpayer_id, assessment_year, version, employer_id,
       CAST(filing_date AS VARCHAR) AS filing_date, CAST(batch_date AS VARCHAR) AS batch_date,
       record_type, annual_income_sgd, chargeable_income_sgd, tax_payable_sgd, tax_paid_sgd,
       total_reliefs_sgd, cpf_contributions_sgd, foreign_income_sgd, is_corrected"""
AUDIT_COLUMNS = """taxpayer_id, assessment_year, CAST(corrected_at AS VARCHAR) AS corrected_at,
       old_annual_income_sgd, old_chargeable_income_sgd, old_tax_payable_sgd, old_tax_paid_sgd,
       old_total_reliefs_sgd"""
LOG_COLUMNS = """taxpayer_id, nric, full_name, filing_status, assessment_year, filing_date,
       annual_income_sgd, chargeable_income_sgd, tax_payable_sgd, tax_paid_sgd, total_reliefs_sgd,
       number_of_dependents, occupation, residential_status, postal_code, housing_type,
       cpf_contributions_sgd, foreign_income_sgd, employer_id, batch_date, record_type"""

EVENT_LOG = """
ev AS (
  SELECT user_id, event_id, ts, CAST(ts AS DATE) AS d, event_type, value,
         CAST(floor(value / 10) AS INTEGER) AS attr,
         CASE event_type WHEN 'error' THEN 'correction' WHEN 'signup' THEN 'late_arrival'
                         ELSE 'update' END AS record_type
  FROM events),
ev_log AS (
  SELECT * FROM ev
  QUALIFY row_number() OVER (PARTITION BY user_id, d ORDER BY ts DESC, event_id DESC) = 1),
ev_first AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY d) AS i FROM ev_log),
ev_acting AS (
  SELECT *, lag(attr) OVER (PARTITION BY user_id ORDER BY d) AS p
  FROM ev_first WHERE i = 1 OR record_type IN ('update', 'correction')),
ev_numbered AS (
  SELECT *, CAST(sum(CASE WHEN i = 1 OR (record_type = 'update' AND attr IS DISTINCT FROM p)
                          THEN 1 ELSE 0 END)
                 OVER (PARTITION BY user_id ORDER BY d ROWS UNBOUNDED PRECEDING) AS INTEGER) AS version
  FROM ev_acting),
ev_merged AS (
  SELECT user_id, version, min(d) AS valid_from, max_by(attr, d) AS attr
  FROM ev_numbered GROUP BY user_id, version),
ev_versions AS (
  SELECT user_id, version, attr, valid_from,
         coalesce(lead(valid_from) OVER w, DATE '9999-12-31') AS valid_to,
         lead(valid_from) OVER w IS NULL AS is_current
  FROM ev_merged WINDOW w AS (PARTITION BY user_id ORDER BY version))"""


def summary_sql(by: str, limit: int, offset: int) -> str:
    return with_(*FULL) + f"""
SELECT v.{by} AS group_value, count(*) AS num_returns,
       round(sum(f.tax_payable_sgd), 2) AS total_tax_payable,
       round(sum(f.annual_income_sgd) / count(f.annual_income_sgd), 2) AS avg_annual_income
FROM facts f JOIN versions v USING (taxpayer_id, version)
GROUP BY 1 ORDER BY total_tax_payable DESC NULLS LAST, group_value NULLS LAST
LIMIT {limit} OFFSET {offset}"""


TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def oracle_sql() -> dict[str, str]:
    counts = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS num_rows FROM {t}" for t in TABLE_NAMES
    )
    stamp = "strftime(DATE '2024-01-01' + CAST(batch_seq AS INTEGER), '%Y-%m-%d')"
    return {
        # ---- sources ----
        "schema_align": """
SELECT CAST(c_custkey AS VARCHAR) AS party_id, c_name AS name,
       CAST(c_nationkey AS VARCHAR) AS nation, c_mktsegment AS segment, 'new' AS record_type
FROM customer
UNION ALL
SELECT CAST(s_suppkey AS VARCHAR), s_name, CAST(s_nationkey AS VARCHAR), NULL, 'new' FROM supplier""",
        "csv_batches": with_(LOG) + f"SELECT batch, batch_seq, {LOG_COLUMNS} FROM log".replace(
            "batch_date,", "max(batch_date) OVER (PARTITION BY batch) AS batch_date,"
        ),
        "batch_catalogue": with_(LOG) + """
SELECT batch, batch_seq, min(batch_date) AS batch_date, count(*) AS num_rows
FROM log GROUP BY batch, batch_seq""",
        "batch_catalogue_mixed_dates": with_(LOG) + """
SELECT batch, batch_seq, arg_min(said, row_pos) FILTER (WHERE said IS NOT NULL) AS batch_date
FROM (SELECT batch, batch_seq, row_pos, CASE row_pos % 3 WHEN 0 THEN NULL
        WHEN 1 THEN strftime(CAST(batch_date AS DATE), '%d/%m/%Y') ELSE batch_date END AS said FROM log)
GROUP BY batch, batch_seq""",
        "csv_headers": """
SELECT concat('T', c_custkey) AS taxpayer_id, concat('S', c_custkey) AS nric, c_name AS full_name,
       'new' AS record_type FROM customer""",
        "employer_file": with_(EMPLOYERS) + """
SELECT CASE WHEN p.no_id THEN concat('UNKNOWN_', p.pos) ELSE concat('EMP', p.k) END AS employer_id,
       e.* EXCLUDE (employer_id)
FROM (SELECT *, row_number() OVER (PARTITION BY k // 100 ORDER BY k) - 1 AS pos FROM parsed) p
JOIN employers e ON e.employer_id = CASE WHEN p.no_id THEN concat('UNKNOWN_', p.k) ELSE concat('EMP', p.k) END""",
        "employer_lines": with_(EMPLOYERS) + """
SELECT e.* EXCLUDE (employer_id)
FROM parsed p
JOIN employers e ON e.employer_id = CASE WHEN p.no_id THEN concat('UNKNOWN_', p.k) ELSE concat('EMP', p.k) END
WHERE p.k % 10 NOT IN (3, 7)""",
        "employer_lines_refused": """
SELECT CASE WHEN s_suppkey % 10 = 3 THEN 'not JSON' ELSE 'not an object' END AS reason, s_name AS company_name
FROM supplier WHERE s_suppkey % 10 IN (3, 7)""",
        "one_batch_score": with_(LOG, FLAGS) + f"""
SELECT domain, {SCORE} FROM long WHERE batch = 'day3' GROUP BY domain""",
        "employer_records": with_(EMPLOYERS) + "SELECT * FROM employers",
        "employer_issue_count": with_(EMPLOYERS) + """
SELECT count(*) AS records, CAST(sum(CAST(has_schema_issues AS INTEGER)) AS BIGINT) AS flagged
FROM employers""",
        "employer_dimension": with_(EMPLOYERS) + """
SELECT employer_id, company_name, uen, industry, address, CAST(employee_count AS INTEGER) AS employee_count
FROM employers
UNION ALL SELECT 'UNKNOWN', 'Unknown / Self-employed', NULL, NULL, NULL, NULL""",
        "event_props": """
SELECT event_id, CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS INTEGER) AS k FROM events""",
        "rejected_rows": with_(LOG) + """
SELECT batch, row_pos, CASE WHEN taxpayer_id IS NULL THEN 'missing key'
            WHEN TRY_CAST(assessment_year AS INTEGER) IS NULL THEN 'unreadable period'
            ELSE 'superseded in batch' END AS reason
FROM log
QUALIFY taxpayer_id IS NULL OR TRY_CAST(assessment_year AS INTEGER) IS NULL
  OR row_number() OVER (PARTITION BY batch_seq, taxpayer_id, TRY_CAST(assessment_year AS INTEGER)
                        ORDER BY row_pos DESC) > 1""",
        # ---- quality ----
        "dq_row_flags": with_(LOG, FLAGS) + """
SELECT row_pos, dq_rule1_nric_present_pass, dq_rule2_nric_format_pass, dq_rule3_postal_code_pass,
       dq_rule4_filing_date_after_ay_pass, dq_rule5_chargeable_income_pass,
       dq_rule6_cpf_resident_pass, dq_completeness_pass, dq_validity_pass, dq_accuracy_pass
FROM domains""",
        "dq_custom_rules": """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
       trim(coalesce(nullif(l_returnflag, 'N'), '')) <> '' AS dq_flag_present_pass,
       regexp_full_match(o_orderpriority, '[1-3]-[A-Z]+') AS dq_priority_format_pass,
       coalesce(year(l_shipdate) > year(o_orderdate), false) AS dq_shipped_later_pass,
       coalesce(l_tax = 0.08::DOUBLE - l_discount, false) AS dq_tax_sum_pass,
       l_quantity - 1 = l_quantity - l_linenumber % 2 AS dq_price_difference_pass,
       l_returnflag <> 'R' OR l_tax > 0 AS dq_taxed_if_returned_pass,
       trim(coalesce(nullif(l_returnflag, 'N'), '')) <> '' AS dq_completeness_pass,
       regexp_full_match(o_orderpriority, '[1-3]-[A-Z]+')
         AND coalesce(year(l_shipdate) > year(o_orderdate), false) AS dq_validity_pass,
       coalesce(l_tax = 0.08::DOUBLE - l_discount, false) AND l_quantity - 1 = l_quantity - l_linenumber % 2
         AND (l_returnflag <> 'R' OR l_tax > 0) AS dq_accuracy_pass
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
        "score_absent_domain": with_(LOG, FLAGS) + f"""
SELECT domain, {SCORE} FROM long WHERE domain = 'completeness' GROUP BY domain""",
        "dq_domain_score": with_(LOG, FLAGS) + f"SELECT domain, {SCORE} FROM long GROUP BY domain",
        "dq_score_by_batch": with_(LOG, FLAGS) + f"""
SELECT batch, domain, {SCORE} FROM long GROUP BY batch, domain""",
        "dq_latest_per_domain": with_(LOG, FLAGS) + f"""
SELECT domain, {SCORE}, batch, {stamp} AS computed_at
FROM long GROUP BY domain, batch, batch_seq
QUALIFY row_number() OVER (PARTITION BY domain ORDER BY batch_seq DESC) = 1""",
        "dq_metric_listing": with_(LOG, FLAGS) + f"""
SELECT batch, domain, {SCORE} FROM long GROUP BY batch, domain ORDER BY batch, domain""",
        # ---- history ----
        "scd2_versions": with_(*HISTORY) + f"SELECT {VERSION_COLUMNS} FROM versions",
        "scd2_mixed_batch": with_(*HISTORY, months=24) + f"SELECT {VERSION_COLUMNS} FROM versions",
        "scd2_event_history": """
WITH b AS (SELECT user_id, CAST(ts AS DATE) AS d, event_type,
             row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE)
                                ORDER BY ts DESC, event_id DESC) AS rn
           FROM events),
c AS (SELECT user_id, d, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY d) AS p,
             row_number() OVER (PARTITION BY user_id ORDER BY d) AS i FROM b WHERE rn = 1),
v AS (SELECT user_id, d, event_type FROM c WHERE i = 1 OR event_type IS DISTINCT FROM p)
SELECT user_id, event_type, CAST(d AS VARCHAR) AS valid_from,
       CAST(coalesce(lead(d) OVER (PARTITION BY user_id ORDER BY d), DATE '9999-12-31') AS VARCHAR)
         AS valid_to,
       lead(d) OVER (PARTITION BY user_id ORDER BY d) IS NULL AS is_current
FROM v""",
        "scd2_event_corrections": with_(EVENT_LOG) + """
SELECT user_id, version, attr, CAST(valid_from AS VARCHAR) AS valid_from,
       CAST(valid_to AS VARCHAR) AS valid_to, is_current FROM ev_versions""",
        "asof_event_link": with_(EVENT_LOG) + """
SELECT e.event_id, e.user_id, coalesce(v.version, cur.version) AS version,
       v.version IS NOT NULL AS as_of
FROM events e
LEFT JOIN ev_versions v ON v.user_id = e.user_id
  AND CAST(e.ts AS DATE) - 3 >= v.valid_from AND CAST(e.ts AS DATE) - 3 < v.valid_to
LEFT JOIN ev_versions cur ON cur.user_id = e.user_id AND cur.is_current""",
        "surrogate_keys": """
SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) + 1000 AS sk FROM customer""",
        # ---- facts ----
        "fact_returns": with_(*FULL) + f"SELECT {FACT_COLUMNS} FROM facts",
        "unknown_member_totals": """
SELECT coalesce(CAST(s.s_suppkey AS VARCHAR), 'UNKNOWN') AS supplier, count(*) AS n,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM lineitem l
LEFT JOIN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) s ON s.s_suppkey = l.l_suppkey
GROUP BY 1""",
        "line_item_upsert": """
WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag FROM lineitem),
target AS (SELECT * FROM l WHERE l_returnflag <> 'R'
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                             ORDER BY l_partkey DESC, l_suppkey DESC, l_quantity DESC) = 1),
batch AS (SELECT * FROM l WHERE l_returnflag = 'R'
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                             ORDER BY l_partkey DESC, l_suppkey DESC, l_quantity DESC) = 1)
SELECT * FROM batch
UNION ALL
SELECT * FROM target
WHERE (l_orderkey, l_linenumber) NOT IN (SELECT (l_orderkey, l_linenumber) FROM batch)""",
        "correction_audit": with_(LOG, VERSIONS.split("steps AS")[0].rstrip().rstrip(","), RETURNS, AUDIT)
        + f"SELECT {AUDIT_COLUMNS} FROM audit",
        # ---- serving ----
        "summary_by_occupation": summary_sql("occupation", 50, 0),
        "summary_by_residential_status": summary_sql("residential_status", 50, 0),
        "summary_by_housing_type": summary_sql("housing_type", 2, 1),
        "summary_by_segment": """
SELECT c_mktsegment AS group_value, count(*) AS num_orders,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders JOIN customer ON o_custkey = c_custkey
GROUP BY c_mktsegment ORDER BY total DESC NULLS LAST, group_value LIMIT 3 OFFSET 1""",
        "profiles_of_customers": with_(*HISTORY) + """
SELECT taxpayer_id, nric, full_name, occupation, residential_status, postal_code, housing_type
FROM versions WHERE is_current AND taxpayer_id IN (SELECT concat('T', c_custkey) FROM customer)""",
        "profile_of_one": with_(*HISTORY) + """
SELECT taxpayer_id, nric, full_name, occupation, residential_status, postal_code, housing_type
FROM versions WHERE is_current AND taxpayer_id = 'T7'""",
        "returns_of_one": with_(*FULL) + """
SELECT assessment_year, CAST(filing_date AS VARCHAR) AS filing_date, annual_income_sgd,
       chargeable_income_sgd, tax_payable_sgd, tax_paid_sgd, employer_id, is_corrected
FROM facts WHERE taxpayer_id = 'T7' ORDER BY assessment_year""",
        "history_of_one": with_(*HISTORY) + """
SELECT CAST(version AS BIGINT) AS taxpayer_sk, occupation, postal_code, CAST(valid_from AS VARCHAR) AS valid_from,
       CAST(valid_to AS VARCHAR) AS valid_to, is_current
FROM versions WHERE taxpayer_id = 'T7' ORDER BY version""",
        "fact_sample": with_(*FULL) + """
SELECT taxpayer_id, assessment_year, employer_id, tax_payable_sgd, is_corrected
FROM facts ORDER BY taxpayer_id, assessment_year LIMIT 5""",
        "audit_listing": with_(LOG, VERSIONS.split("steps AS")[0].rstrip().rstrip(","), RETURNS, AUDIT)
        + "SELECT taxpayer_id, assessment_year, old_tax_payable_sgd FROM audit",
        "table_counts": counts,
        "warehouse_counts": with_(*FULL, AUDIT, FLAGS) + """
SELECT 'dim_taxpayer' AS table_name, count(*) AS num_rows FROM versions
UNION ALL SELECT 'dim_employer', count(*) + 1 FROM employers
UNION ALL SELECT 'fact_tax_returns', count(*) FROM facts
UNION ALL SELECT 'agg_data_quality_metrics', count(*) FROM (SELECT DISTINCT batch, domain FROM long)
UNION ALL SELECT 'fact_corrections', count(*) FROM audit""",
        # ---- checks ----
        "check_several_current": with_(*HISTORY) + """
SELECT taxpayer_id, count(*) AS n FROM versions WHERE is_current GROUP BY 1 HAVING count(*) > 1""",
        "check_version_gaps": with_(*HISTORY) + """
SELECT taxpayer_id, CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to,
       CAST(nf AS VARCHAR) AS next_from
FROM (SELECT *, lead(valid_from) OVER w AS nf, lead(version) OVER w AS nv FROM versions
      WINDOW w AS (PARTITION BY taxpayer_id ORDER BY opened_seq))
WHERE nv IS NOT NULL AND valid_to IS DISTINCT FROM nf""",
        "check_several_current_seeded": with_(*HISTORY) + """
SELECT taxpayer_id, count(*) AS n FROM versions WHERE is_current OR version = 1
GROUP BY 1 HAVING count(*) > 1""",
        "check_version_gaps_seeded": with_(*HISTORY) + """
SELECT taxpayer_id, CAST(valid_from AS VARCHAR) AS valid_from, CAST(late AS VARCHAR) AS valid_to,
       CAST(nf AS VARCHAR) AS next_from
FROM (SELECT *, lead(valid_from) OVER w AS nf, lead(version) OVER w AS nv,
             valid_to + CASE WHEN version % 2 = 1 AND NOT is_current THEN 1 ELSE 0 END AS late
      FROM versions WINDOW w AS (PARTITION BY taxpayer_id ORDER BY version))
WHERE nv IS NOT NULL AND late IS DISTINCT FROM nf""",
        "check_fact_grain": with_(*FULL) + """
SELECT taxpayer_id, assessment_year, count(*) AS n FROM facts GROUP BY 1, 2 HAVING count(*) > 1""",
        "check_line_item_grain": """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
        "check_dangling_suppliers": """
SELECT 'part' AS link, CAST(l_partkey AS VARCHAR) AS value, count(*) AS n FROM lineitem
WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10) GROUP BY 2
UNION ALL
SELECT 'supplier', CAST(l_suppkey AS VARCHAR), count(*) FROM lineitem
WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) GROUP BY 2""",
        "check_unknown_links": with_(*FULL) + """
SELECT count(*) AS num_facts, count(*) FILTER (WHERE employer_id = 'UNKNOWN') AS num_unknown FROM facts""",
        "check_content_difference": """
(SELECT o_custkey, o_orderstatus, 'before' AS side FROM orders WHERE o_orderpriority <> '5-LOW'
 EXCEPT ALL SELECT o_custkey, o_orderstatus, 'before' FROM orders WHERE o_orderpriority <> '1-URGENT')
UNION ALL
(SELECT o_custkey, o_orderstatus, 'after' FROM orders WHERE o_orderpriority <> '1-URGENT'
 EXCEPT ALL SELECT o_custkey, o_orderstatus, 'after' FROM orders WHERE o_orderpriority <> '5-LOW')""",
        "check_content_sums": """
WITH a AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders),
b AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 1009 <> 1 THEN o_orderstatus END AS o_orderstatus, o_orderpriority
      FROM a WHERE o_orderkey % 997 <> 0
      UNION ALL SELECT * FROM a WHERE o_orderkey % 2003 = 2)
(SELECT *, 'before' AS side FROM a EXCEPT ALL SELECT *, 'before' FROM b)
UNION ALL
(SELECT *, 'after' AS side FROM b EXCEPT ALL SELECT *, 'after' FROM a)""",
        "check_touched_keys": with_(*FULL) + """,
touched AS (SELECT DISTINCT taxpayer_id FROM log WHERE batch_seq = 9),
seeded AS (SELECT *, lead(valid_from) OVER w AS nf, lead(version) OVER w AS nv,
                  valid_to + CASE WHEN version % 2 = 1 AND NOT is_current THEN 1 ELSE 0 END AS late
           FROM versions SEMI JOIN touched USING (taxpayer_id)
           WINDOW w AS (PARTITION BY taxpayer_id ORDER BY version)),
filed AS (SELECT * FROM facts SEMI JOIN touched USING (taxpayer_id))
SELECT 'several current' AS "check", taxpayer_id AS value, count(*) AS n FROM seeded
WHERE is_current OR version = 1 GROUP BY 2 HAVING count(*) > 1
UNION ALL
SELECT 'gap between versions', taxpayer_id, count(*) FROM seeded
WHERE nv IS NOT NULL AND late IS DISTINCT FROM nf GROUP BY 2
UNION ALL
SELECT 'repeated grain', taxpayer_id || '|' || assessment_year, count(*) FROM filed
GROUP BY taxpayer_id, assessment_year HAVING count(*) > 1
UNION ALL
SELECT 'dangling link', 'employer_id=' || employer_id, count(*) FROM filed
WHERE employer_id LIKE '%7' GROUP BY 2""",
        # ---- stored warehouse ----
        "stored_overall_quality": with_(LOG, FLAGS) + f"SELECT domain, {SCORE} FROM long GROUP BY domain",
        "running_summary_by_occupation": summary_sql("occupation", 50, 0),
        "stored_dimension": with_(*HISTORY) + f"SELECT {VERSION_COLUMNS.replace('version, ', '')} FROM versions",
        "stored_corrections": with_(LOG, VERSIONS.split("steps AS")[0].rstrip().rstrip(","), RETURNS, AUDIT)
        + f"""SELECT row_number() OVER (ORDER BY batch_seq, taxpayer_id, assessment_year) AS correction_id,
       {AUDIT_COLUMNS} FROM audit""",
        "stored_metrics": with_(LOG, FLAGS) + f"""
SELECT batch, domain, {SCORE} FROM long GROUP BY batch, domain""",
        "stored_quality": with_(LOG, FLAGS) + f"""
SELECT domain, {SCORE}, batch FROM long WHERE batch_seq = (SELECT max(batch_seq) FROM log)
GROUP BY domain, batch""",
        "stored_rejects": with_(LOG) + f"""
SELECT batch, CASE WHEN taxpayer_id IS NULL THEN 'missing key'
            WHEN TRY_CAST(assessment_year AS INTEGER) IS NULL THEN 'unreadable period'
            ELSE 'superseded in batch' END AS reason, {LOG_COLUMNS}
FROM log
QUALIFY taxpayer_id IS NULL OR TRY_CAST(assessment_year AS INTEGER) IS NULL
  OR row_number() OVER (PARTITION BY batch_seq, taxpayer_id, TRY_CAST(assessment_year AS INTEGER)
                        ORDER BY row_pos DESC) > 1""",
        "replay_changes_nothing": """
SELECT table_name, count(*) - count(*) AS num_rows
FROM (VALUES ('dim_taxpayer'), ('dim_employer'), ('fact_tax_returns'), ('agg_data_quality_metrics'),
             ('fact_corrections')) t(table_name), (SELECT 1 FROM orders LIMIT 1)
GROUP BY table_name""",
        "warehouse_rebuild": with_(*FULL) + f"SELECT {FACT_COLUMNS} FROM facts",
        "folder_stream": with_(*FULL, months=24) + f"SELECT {FACT_COLUMNS} FROM facts",
        "folder_stream_dimension": with_(*HISTORY) + f"SELECT {VERSION_COLUMNS.replace('version, ', '')} FROM versions",
        "folder_stream_corrections": with_(LOG, VERSIONS.split("steps AS")[0].rstrip().rstrip(","), RETURNS, AUDIT)
        + f"""SELECT row_number() OVER (ORDER BY batch_seq, taxpayer_id, assessment_year) AS correction_id,
       {AUDIT_COLUMNS} FROM audit""",
        "folder_stream_metrics": with_(LOG, FLAGS) + f"""
SELECT batch, domain, {SCORE} FROM long GROUP BY batch, domain""",
        "folder_stream_rejects": with_(LOG) + f"""
SELECT batch, CASE WHEN taxpayer_id IS NULL THEN 'missing key'
            WHEN TRY_CAST(assessment_year AS INTEGER) IS NULL THEN 'unreadable period'
            ELSE 'superseded in batch' END AS reason, {LOG_COLUMNS}
FROM log
QUALIFY taxpayer_id IS NULL OR TRY_CAST(assessment_year AS INTEGER) IS NULL
  OR row_number() OVER (PARTITION BY batch_seq, taxpayer_id, TRY_CAST(assessment_year AS INTEGER)
                        ORDER BY row_pos DESC) > 1""",
    }
