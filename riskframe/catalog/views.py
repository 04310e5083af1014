"""The same views as :mod:`riskframe.fixtures`, as DuckDB common table expressions."""

from __future__ import annotations

HOME = """CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'RENT' WHEN 'BUILDING' THEN 'MORTGAGE'
  WHEN 'FURNITURE' THEN 'OWN' WHEN 'HOUSEHOLD' THEN 'OTHER' WHEN 'MACHINERY' THEN 'ANY' END"""
PURPOSE = """CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'debt_consolidation' WHEN '2' THEN 'credit_card'
  WHEN '3' THEN 'home_improvement' WHEN '5' THEN 'small_business' END"""
Y = """CASE WHEN (o_orderstatus = 'O' AND o_orderkey % 3 = 2)
  OR (o_orderstatus = 'P' AND o_orderkey % 4 IN (0, 1)) THEN 1 ELSE 0 END"""

LOANS = f"""
loan_lines AS (
  SELECT l_orderkey, count(*) AS n_lines, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty
  FROM lineitem GROUP BY l_orderkey
), loan_base AS (
  SELECT o.*, c.*, coalesce(n_lines, 0) AS n_lines, coalesce(qty, 0) AS qty,
         min(o_orderdate) OVER (PARTITION BY o_custkey) AS first_date,
         o_orderkey AS k, o_custkey AS c
  FROM orders o JOIN customer c ON o_custkey = c_custkey LEFT JOIN loan_lines ON l_orderkey = o_orderkey
), loans_once AS (
  SELECT k AS o_orderkey,
    CAST(k AS VARCHAR) AS loan_id,
    CASE WHEN k % 41 <> 0 THEN o_totalprice / 10 END AS loan_amnt,
    CASE WHEN k % 3 = 0 THEN '60 months' ELSE '36 months' END AS term,
    CASE WHEN k % 53 <> 0 THEN CAST(5 + k % 27 AS VARCHAR) || '.' || CAST((k * 7) % 10 AS VARCHAR) || '%' END AS int_rate,
    o_totalprice / 360 AS installment,
    CASE WHEN k % 97 = 0 THEN 'Z' ELSE substr('ABCDEFG', CAST(1 + k % 7 AS INT), 1) END AS grade,
    substr('ABCDEFG', CAST(1 + k % 7 AS INT), 1) || CAST(1 + k % 5 AS VARCHAR) AS sub_grade,
    CASE WHEN c % 13 = 0 THEN '< 1 year' WHEN c % 13 = 1 THEN '1 year'
         WHEN c % 13 <= 9 THEN CAST(c % 13 AS VARCHAR) || ' years'
         WHEN c % 13 = 10 THEN '10+ years' WHEN c % 13 = 11 THEN 'n/a' END AS emp_length,
    {HOME} AS home_ownership,
    c_acctbal * 12 AS annual_inc,
    CASE k % 3 WHEN 0 THEN 'Verified' WHEN 1 THEN 'Source Verified' ELSE 'Not Verified' END AS verification_status,
    {PURPOSE} AS purpose,
    CAST((k * 13) % 1200 AS DOUBLE) / 10 AS dti,
    CASE WHEN k % 29 <> 0 THEN CAST((k * 17) % 1010 AS DOUBLE) / 10 END AS revol_util,
    (c * 37) % 50000 AS revol_bal,
    20000 + (c * 53) % 60000 AS tot_hi_cred_lim,
    CAST(qty * 100 AS DOUBLE) AS total_debt,
    n_lines AS open_acc,
    CASE WHEN n_lines >= 7 THEN 1 ELSE 0 END AS delinq_2yrs,
    strftime(o_orderdate, '%b-%Y') AS issue_d,
    first_date AS earliest_cr_line,
    CASE WHEN k % 2 = 0 THEN 'f' ELSE 'w' END AS initial_list_status,
    CASE o_orderstatus WHEN 'F' THEN 'Fully Paid'
      WHEN 'O' THEN CASE k % 3 WHEN 0 THEN 'Current' WHEN 1 THEN 'In Grace Period' ELSE 'Late (31-120 days)' END
      ELSE CASE k % 4 WHEN 0 THEN 'Charged Off' WHEN 1 THEN 'Default' WHEN 2 THEN 'Issued' ELSE 'Somewhere Else' END
    END AS loan_status,
    CASE WHEN k % 10 >= 7 THEN CAST(k % 60 AS DOUBLE) END AS mths_since_last_delinq
  FROM loan_base
), loans AS (
  SELECT * FROM loans_once UNION ALL SELECT * FROM loans_once WHERE o_orderkey % 50 = 0
)"""

SCORED = f"""
scored AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS loan_id, o_orderdate AS ts, {Y} AS y,
         CAST((o_orderkey * 7919) % 1009 + 400 * ({Y}) AS DOUBLE) / 1409 AS p,
         CASE WHEN CAST((o_orderkey * 7919) % 1009 + 400 * ({Y}) AS DOUBLE) / 1409 > 0.5 THEN 1 ELSE 0 END AS y_pred,
         {HOME} AS home_ownership, {PURPOSE} AS purpose,
         CASE WHEN o_orderstatus = 'F' THEN 'closed' ELSE 'open' END AS family
  FROM orders JOIN customer ON o_custkey = c_custkey
)"""

LABEL_SCORED = """
label_scored AS (
  SELECT d.doc_id, quality AS y, CASE WHEN n_chars >= 200 THEN 1 ELSE 0 END AS y_pred, lang, source
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id
)"""

DRIFT = """
drift_ref AS (
  SELECT l_quantity, l_extendedprice, l_discount, l_returnflag, l_linestatus
  FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01 00:00:00'
), drift_cur AS (
  SELECT l_quantity, l_extendedprice * CAST(1.125 AS DOUBLE) AS l_extendedprice, l_discount,
         CASE WHEN l_returnflag = 'N' AND l_orderkey % 5 = 0 THEN 'X' ELSE l_returnflag END AS l_returnflag, l_linestatus
  FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01 00:00:00'
)"""

REQUEST_LOG = """
request_log AS (
  SELECT event_id, ts, CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status, value / 1000 AS latency_s
  FROM events
)"""

DRIFT_LOG = """
drift_log AS (
  SELECT ts, CASE WHEN late AND hour(ts) % 4 = 0 THEN value * CAST(1.5 AS DOUBLE) ELSE value END AS amount,
    CASE WHEN late AND hour(ts) = 10 AND event_type = 'view' THEN 'preview' ELSE event_type END AS kind, user_id % 3 = 0 AS flagged,
    CASE WHEN late AND hour(ts) % 6 = 0 THEN score * CAST(0.5 AS DOUBLE) ELSE score END AS score
  FROM (SELECT *, ts >= TIMESTAMP '2024-01-08 00:00:00' AS late, CAST((event_id * 7919) % 1009 AS DOUBLE) / 1009 AS score FROM events)
)"""

LOOKUP = """
requests AS (
  SELECT event_id, user_id AS loan_id, ts AS req_ts, value FROM events WHERE event_type = 'purchase'
), snapshots AS (
  SELECT user_id AS loan_id, ts AS feature_ts, event_id AS version, value FROM events WHERE event_type = 'view'
)"""


def with_(*parts: str) -> str:
    """One WITH clause from several view texts."""
    return "WITH " + ",\n".join(p.strip() for p in parts)

REQUEST_ROWS = """
request_rows AS (
  SELECT k AS o_orderkey, CAST(k AS VARCHAR) AS loan_id, l.loan_amnt, l.term,
    CASE WHEN k % 53 <> 0 THEN CAST(5 + k % 27 AS DOUBLE) + CAST((k * 7) % 10 AS DOUBLE) / 10 END AS int_rate,
    l.installment, CASE WHEN k % 11 = 0 THEN 'Z' ELSE l.grade END AS grade, l.sub_grade,
    CASE WHEN k % 13 <> 0 THEN CAST(k % 13 AS DOUBLE) END AS emp_length,
    l.home_ownership, l.annual_inc, l.verification_status, l.purpose, l.dti, l.delinq_2yrs,
    k % 4 AS inq_last_6mths, l.open_acc, k % 2 AS pub_rec, l.revol_bal, l.revol_util, 5 + k % 30 AS total_acc,
    l.initial_list_status, k % 1000 AS total_pymnt
  FROM (SELECT *, o_orderkey AS k FROM loans_once) l
), request_errors AS (
  SELECT *, list_filter([
    CASE WHEN loan_amnt IS NULL THEN 'loan_amnt: Field required' END,
    CASE WHEN loan_amnt <= 0 THEN 'loan_amnt: Input should be greater than 0' END,
    CASE WHEN int_rate IS NULL THEN 'int_rate: Field required' END,
    CASE WHEN int_rate <= 0 THEN 'int_rate: Input should be greater than 0' END,
    CASE WHEN int_rate > 100 THEN 'int_rate: Input should be less than or equal to 100' END,
    CASE WHEN installment <= 0 THEN 'installment: Input should be greater than 0' END,
    CASE WHEN NOT regexp_full_match(grade, '[A-G]') THEN 'grade: String should match pattern ''^[A-G]$''' END,
    CASE WHEN home_ownership IS NULL THEN 'home_ownership: Field required' END,
    CASE WHEN annual_inc < 0 THEN 'annual_inc: Input should be greater than or equal to 0' END,
    CASE WHEN purpose IS NULL THEN 'purpose: Field required' END,
    CASE WHEN dti < 0 THEN 'dti: Input should be greater than or equal to 0' END,
    CASE WHEN revol_util > 100 THEN 'revol_util: Input should be less than or equal to 100' END
  ], lambda x: x IS NOT NULL) AS errors
  FROM request_rows
)"""

REGISTRY = """
registry AS (
  SELECT 'model-' || o_custkey AS name, o_orderkey AS version,
    CASE o_orderstatus WHEN 'F' THEN 'Archived' WHEN 'O' THEN 'Staging' ELSE 'Production' END AS stage,
    CASE o_orderkey % 10 WHEN 0 THEN 'champion' WHEN 1 THEN 'challenger' END AS alias,
    o_orderdate AS creation_ts, 'run-' || o_orderkey AS run_id
  FROM orders
), promotions AS (
  SELECT name, version % 4 AS version, CASE WHEN version % 3 <> 0 THEN stage END AS stage, alias,
    CASE WHEN version % 4 = 1 THEN 'promoted by ' || run_id END AS description, creation_ts AS ts, version AS seq
  FROM registry
)"""
