"""Oracle: the raw GTM exports as DuckDB SQL over the driver tables.

Written from the projection rules (k = o_orderkey), independently of the
Spark code.  Every column is VARCHAR.
"""

from oracle.cte import cte


def euro(c: str) -> str:
    return f"(replace(format('{{:,}}', ({c}) // 100), ',', chr(160)) || ',' || lpad(CAST(({c}) % 100 AS VARCHAR), 2, '0'))"


def ts(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


def hours(n: str) -> str:
    return f"to_hours(CAST({n} AS BIGINT))"


cte(
    "raw_activity",
    """
SELECT l_orderkey AS o_orderkey,
       count(*) FILTER (WHERE l_returnflag = 'A') AS n_a,
       count(*) FILTER (WHERE l_returnflag = 'N') AS n_n,
       count(*) FILTER (WHERE l_returnflag = 'R') AS n_r
FROM lineitem GROUP BY l_orderkey
""",
)

cte(
    "raw_lead_base",
    """
SELECT o.o_orderkey AS k, o.o_totalprice, o.o_orderpriority, a.n_a, a.n_n, a.n_r,
       DATE '2024-01-01' + CAST((o.o_orderkey * 37) % 182 AS INTEGER) AS base_day,
       CASE WHEN o.o_orderkey % 5 < 2 AND o.o_orderkey % 95 = 0 THEN DATE '2024-02-01'
            ELSE DATE '2024-01-01' + CAST((o.o_orderkey * 37) % 182 AS INTEGER) END AS entry_day,
       CAST(round(o.o_totalprice * 100) AS BIGINT) AS cents
FROM orders o LEFT JOIN raw_activity a ON a.o_orderkey = o.o_orderkey
""",
)

cte(
    "raw_lead_calls",
    f"""
SELECT *,
       CASE WHEN k % 101 = 0 THEN CAST(entry_day AS TIMESTAMP) - {hours('1 + k % 30')}
            ELSE CAST(entry_day AS TIMESTAMP) + {hours('k % 400')} END AS first_call
FROM raw_lead_base
""",
)

cte(
    "raw_leads",
    f"""
SELECT
  'L' || CAST(k AS VARCHAR) AS lead_id,
  CASE WHEN NOT (k % 5 < 2) THEN (CASE WHEN k % 2 = 1 THEN '' END)
       WHEN k % 95 = 0 THEN CAST(DATE '2020-01-01' + CAST(k % 365 AS INTEGER) AS VARCHAR)
       WHEN k % 97 = 0 THEN '0001-01-01'
       WHEN k % 3 = 0 THEN CAST(base_day AS VARCHAR)
       ELSE '00' || substr(CAST(base_day AS VARCHAR), 3) END AS form_submission_date,
  CASE WHEN n_a > 0 THEN CAST(n_a AS VARCHAR) END AS sales_call_count,
  CASE WHEN n_n > 0 THEN CAST(n_n AS VARCHAR) END AS sales_text_count,
  CASE WHEN n_r > 0 THEN CAST(n_r AS VARCHAR) END AS sales_email_count,
  CASE WHEN k % 11 = 0 THEN (CASE WHEN k % 2 = 1 THEN '  ' END) ELSE {ts('first_call')} END
    AS first_sales_call_date,
  CASE WHEN k % 4 <> 0 THEN {ts('first_call + ' + hours('k % 48'))} END AS first_text_sent_date,
  CASE WHEN k % 6 = 0 THEN {ts('first_call + ' + hours('48'))} ELSE '' END AS first_meeting_booked_date,
  CASE WHEN k % 13 = 0 THEN '' ELSE {ts('first_call + ' + hours('(k % 30) * 24'))} END AS last_sales_call_date,
  CASE WHEN k % 7 = 0 OR k % 11 = 0 THEN NULL ELSE {ts('first_call + ' + hours('(k % 60) * 24'))} END
    AS last_sales_activity_date,
  CASE WHEN k % 8 <> 0 THEN {ts('first_call + ' + hours('(k % 60) * 24 - k % 5'))} END AS last_sales_email_date,
  CASE WHEN k % 25 = 0 THEN NULL
       WHEN k % 12 = 0 THEN ' '
       WHEN k % 4 = 1 THEN 'US$' || chr(9) || {euro('cents')}
       ELSE {euro('cents')} END AS predicted_sales,
  CASE o_orderpriority WHEN '1-URGENT' THEN '[''Uber Eats'', ''DoorDash'', ''Grubhub'']'
       WHEN '2-HIGH' THEN '[''DoorDash'']' WHEN '3-MEDIUM' THEN '[]'
       WHEN '4-NOT SPECIFIED' THEN '['''']' END AS marketplaces_used,
  CASE o_orderpriority WHEN '1-URGENT' THEN '[''Toast'']' WHEN '2-HIGH' THEN '[]'
       WHEN '3-MEDIUM' THEN ' [''Square'', ''Olo''] ' WHEN '5-LOW' THEN '['''']' END AS online_ordering_used,
  CASE k % 4 WHEN 0 THEN '[''Pizza'', ''Italian'']' WHEN 1 THEN '[''Mexican'']' WHEN 2 THEN '[]' END
    AS cuisine_types,
  CASE WHEN k % 10 <> 3 THEN CAST(1 + k % 5 AS VARCHAR) END AS location_count,
  CASE WHEN k % 29 = 0 THEN NULL WHEN k % 3 = 0 THEN 'true' ELSE 'false' END AS connected_with_decision_maker,
  CASE WHEN k % 9 = 0 THEN 'Converted' ELSE
    CASE k % 17 WHEN 0 THEN 'New' WHEN 1 THEN 'Working' WHEN 2 THEN 'Demo Set' WHEN 3 THEN 'Sales Nurture'
      WHEN 4 THEN 'Marketing Nurture' WHEN 5 THEN 'Disqualified' WHEN 6 THEN 'Not Interested'
      WHEN 7 THEN 'Incorrect Contact Data' WHEN 8 THEN 'Incorrect_Contact_Data'
      WHEN 9 THEN 'No Longer With Company' WHEN 10 THEN 'No Show' WHEN 11 THEN 'Postpone'
      WHEN 12 THEN 'Restaurant Confirmed' WHEN 13 THEN 'Nurturing' END END AS status,
  CASE WHEN k % 9 = 0 THEN
    CASE WHEN k % 909 = 0 THEN '' WHEN k % 27 = 0 THEN ' O' || CAST(k AS VARCHAR) || ' '
         ELSE 'O' || CAST(k AS VARCHAR) END END AS converted_opportunity_id
FROM raw_lead_calls
""",
)

cte(
    "raw_opp_base",
    f"""
SELECT o_orderkey AS k, o_orderkey // 9 AS j, o_custkey,
       CAST(DATE '2024-01-01' + CAST(o_orderkey % 182 AS INTEGER) AS TIMESTAMP) + {hours('o_orderkey % 24')}
         AS created,
       CASE WHEN (o_orderkey // 9) % 53 = 7 THEN NULL ELSE
         CASE (o_orderkey // 9) % 7 WHEN 0 THEN 'Interest' WHEN 1 THEN 'Demo Set' WHEN 2 THEN 'In Progress'
           WHEN 3 THEN 'Verbal Commitment' WHEN 4 THEN 'On Hold' WHEN 5 THEN 'Closed Won'
           WHEN 6 THEN 'Closed Lost' END END AS stage
FROM orders WHERE o_orderkey % 9 = 0
""",
)

cte(
    "raw_opportunities",
    f"""
SELECT
  'O' || CAST(k AS VARCHAR) AS opportunity_id,
  stage AS stage_name,
  CASE WHEN stage = 'Closed Lost' THEN (CASE j % 3 WHEN 0 THEN 'Price' WHEN 1 THEN 'Timing' ELSE ' ' END)
       END AS lost_reason_c,
  CASE WHEN stage = 'Closed Lost' THEN 'notes ' || CAST(j AS VARCHAR) ELSE '' END AS closed_lost_notes_c,
  CASE j % 4 WHEN 0 THEN 'Marketing' WHEN 1 THEN 'Operations ' WHEN 2 THEN '  ' END AS business_issue_c,
  CASE WHEN j % 4 = 0 THEN 'Google' WHEN j % 8 = 1 THEN ' Referral ' WHEN j % 8 = 5 THEN '' END
    AS how_did_you_hear_about_us_c,
  'A' || CAST(o_custkey AS VARCHAR) AS account_id,
  {ts('created')} AS created_date,
  CASE WHEN j % 3 > 0 THEN {ts('created + ' + hours('72'))} END AS demo_time,
  {ts('created + ' + hours('(j % 20) * 24'))} AS last_sales_call_date_time,
  CASE WHEN j % 3 > 0 THEN 'true' ELSE 'false' END AS demo_held,
  CASE WHEN j % 4 = 0 THEN NULL
       WHEN j % 2 = 0 THEN '00' || substr(CAST(CAST(created AS DATE) + 2 AS VARCHAR), 3)
       ELSE CAST(CAST(created AS DATE) + 2 AS VARCHAR) END AS demo_set_date,
  CASE WHEN stage IS NULL OR stage NOT IN ('Closed Won', 'Closed Lost') THEN ''
       WHEN j % 3 = 0 THEN '00' || substr(CAST(CAST(created AS DATE) + 30 AS VARCHAR), 3)
       WHEN j % 10 = 4 THEN '0001-01-01'
       ELSE CAST(CAST(created AS DATE) + 30 AS VARCHAR) END AS close_date
FROM raw_opp_base, (SELECT unnest([0, 1]) AS copy_no) c
WHERE c.copy_no = 0 OR k % 450 = 0
""",
)

cte(
    "raw_monthly",
    """
SELECT month(l_shipdate) % 6 AS m,
       coalesce(sum(CAST(l_quantity AS BIGINT)) FILTER (WHERE l_returnflag = 'N'), 0) AS q_n,
       coalesce(sum(CAST(l_quantity AS BIGINT)) FILTER (WHERE l_returnflag = 'R'), 0) AS q_r,
       coalesce(sum(CAST(l_quantity AS BIGINT)) FILTER (WHERE l_returnflag = 'A'), 0) AS q_a
FROM lineitem GROUP BY 1
""",
)


def _label(m: str) -> str:
    return (
        f"CASE {m} WHEN 0 THEN 'Jan-24' WHEN 1 THEN 'Feb-24' WHEN 2 THEN 'Mar-24' WHEN 3 THEN 'Apr-24' "
        f"WHEN 4 THEN 'May-24' WHEN 5 THEN 'Jun-24' END"
    )


def _amount(c: str) -> str:
    return "'US$' || chr(9) || " + euro(f"({c})")


cte(
    "raw_expenses_advertising",
    f"SELECT {_label('m')} AS month, {_amount('q_n * 100')} AS advertising FROM raw_monthly",
)
cte(
    "raw_expenses_salary",
    f"""SELECT {_label('m')} AS month, {_amount('q_r * 75')} AS outbound_sales_team,
       {_amount('q_a * 75')} AS inbound_sales_team FROM raw_monthly""",
)
