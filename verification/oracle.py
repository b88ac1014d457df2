"""Independent SQL for every registered query, written for DuckDB over the same tables.

``_CTE`` holds the shared steps; ``_sql`` puts the ones a query mentions in front of it. Money and scores are kept as
integer hundredths and rounded with integer arithmetic, because the engine divides decimals as doubles.
"""

from __future__ import annotations

import re

AS_OF = "DATE '2001-08-01'"
CUTOFF = "DATE '1998-06-30'"
LEVELS = ("junior", "mid", "senior", "lead", "manager", "director")


def rdiv(num: str, den: str, k: int) -> str:
    """num / den rounded half up to k decimals, from integers; NULL when den is 0."""
    n, d, p = f"({num})::HUGEINT", f"NULLIF(({den})::HUGEINT, 0)", 10**k
    return (
        f"(CASE WHEN {n} < 0 THEN -1 ELSE 1 END * ((2 * abs({n}) * {p} + {d}) // (2 * {d})))::DOUBLE / {p}"
    )


def pct(num: str, den: str, k: int) -> str:
    return rdiv(f"({num}) * 100", den, k)


def emp(key: str) -> str:
    return f"printf('EMP-%06d', {key})"


def quarter(date: str) -> str:
    return f"(year({date})::VARCHAR || '-Q' || quarter({date})::VARCHAR)"


def month_quarter(month: str) -> str:
    return f"({month}[1:4] || '-Q' || ((CAST({month}[6:7] AS INT) + 2) // 3)::VARCHAR)"


def cents(c: str) -> str:
    return f"({c})::DOUBLE / 100"


def status(kind: str, v: str) -> str:
    limits = {"attrition": (6, 10, "<="), "perf": (3.5, 3, ">="), "hire": (5, 3, ">="), "tth": (30, 35, "<="),
              "spread": (60, 80, "<="), "female": (35, 25, ">=")}
    good, warn, op = limits[kind]
    return f"CASE WHEN {v} IS NULL THEN 'neutral' WHEN {v} {op} {good} THEN 'ok' WHEN {v} {op} {warn} THEN 'warn' ELSE 'bad' END"


def case(column: str, pairs: dict, default: str = "NULL") -> str:
    whens = " ".join(f"WHEN {k!r} THEN {v!r}" for k, v in pairs.items())
    return f"CASE {column} {whens} ELSE {default} END"


def delta(cur: str, prev: str, invert: bool = False) -> str:
    good = "<" if invert else ">"
    known = f"{cur} IS NOT NULL AND {prev} IS NOT NULL"
    return f"""
        {cur} - {prev} AS diff,
        CASE WHEN {known} THEN coalesce({pct(f'{cur} - {prev}', f'abs({prev})', 4)},
             CASE WHEN {cur} <> {prev} THEN 100.0 ELSE 0.0 END) END AS pct,
        CASE WHEN {known} THEN CASE WHEN {cur} > {prev} THEN 'up' WHEN {cur} < {prev} THEN 'down' ELSE 'flat' END END AS direction,
        CASE WHEN {known} AND {cur} <> {prev} THEN ({cur} - {prev} {good} 0)::INT END AS good"""


_CTE: dict[str, str] = {
    "people": f"""
        SELECT k, c_name, c_mktsegment, hire_date, department_id, level_id,
               CASE WHEN c_acctbal < 5000 AND planned <= {AS_OF} THEN planned END AS exit_date
        FROM (SELECT c_custkey AS k, c_name, c_mktsegment, c_acctbal, h.hire_date, (n_regionkey + 1)::BIGINT AS department_id,
                     c_custkey % 6 + 1 AS level_id,
                     h.hire_date + (90 + c_custkey * 97 % 1400)::INT AS planned
              FROM customer JOIN nation ON c_nationkey = n_nationkey
              JOIN (SELECT o_custkey, min(o_orderdate::DATE) AS hire_date FROM orders GROUP BY 1) h
                ON h.o_custkey = c_custkey)""",
    "raw_employees": f"""
        SELECT {emp('k')} AS employee_id, c_name AS full_name, upper(c_name) || '@X.COM ' AS email,
               CASE k % 3 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' END AS gender,
               DATE '1955-01-01' + (k * 37 % 7300)::INT AS birth_date, hire_date, department_id,
               ' ' || c_mktsegment AS job_title, level_id, CASE WHEN k >= 10 THEN {emp('k // 10')} END AS manager_id,
               CASE k % 10 WHEN 8 THEN 'PART_TIME' WHEN 9 THEN 'CONTRACT' ELSE 'FULL_TIME' END AS employment_type,
               CASE WHEN exit_date IS NOT NULL THEN 'TERMINATED' WHEN k % 50 = 0 THEN 'ON_LEAVE' ELSE 'ACTIVE' END AS status
        FROM people""",
    "salary_all": f"""
        SELECT o_orderkey + 1 AS salary_id, {emp('o_custkey')} AS employee_id, o_orderdate::DATE AS effective_date,
               (o_totalprice::DECIMAL(12,2) * 100)::BIGINT AS amount,
               CASE WHEN o_orderkey % 7 <> 0 THEN 'usd' END AS currency,
               {case('o_orderpriority', {'1-URGENT': 'Promotion', '2-HIGH': 'Merit', '3-MEDIUM': 'Market_Adj', '5-LOW': 'Correction'})} AS change_reason,
               o_custkey AS k
        FROM orders""",
    "raw_salary": """
        SELECT s.* FROM salary_all s JOIN people USING (k) WHERE exit_date IS NULL OR effective_date <= exit_date""",
    "order_lines": """
        SELECT l.*, o_custkey, o_orderpriority
        FROM (SELECT l_orderkey, l_linenumber, min(l_shipdate)::DATE AS ship_date, min(l_quantity)::INT AS quantity,
                     min(l_suppkey) AS suppkey
              FROM lineitem GROUP BY 1, 2) l
        JOIN orders ON o_orderkey = l_orderkey""",
    "reviews_all": f"""
        SELECT l_orderkey * 10 + l_linenumber AS review_id, {emp('o_custkey')} AS employee_id, ship_date AS review_date,
               {quarter('ship_date')} AS review_period, 100 + 8 * quantity AS score, {emp('suppkey')} AS manager_id,
               o_custkey AS k
        FROM order_lines""",
    "raw_reviews": """
        SELECT r.* FROM reviews_all r JOIN people USING (k) WHERE exit_date IS NULL OR review_date <= exit_date""",
    "changes_all": f"""
        SELECT k * 2 + 1 AS change_id, {emp('k')} AS employee_id, exit_date AS change_date, 'Termination' AS change_type,
               department_id AS from_dept_id, level_id AS from_level_id, NULL::BIGINT AS to_level_id,
               CASE WHEN k >= 10 THEN {emp('k // 10')} END AS from_manager_id,
               CASE WHEN k % 20 < 13 THEN 'Voluntary' WHEN k % 20 < 18 THEN 'Involuntary' ELSE 'Retirement' END AS exit_type,
               exit_date
        FROM people WHERE exit_date IS NOT NULL
        UNION ALL
        SELECT k * 2 + 2, {emp('k')}, hire_date + (365 + k * 53 % 1000)::INT, 'Promotion', department_id, level_id,
               least(level_id + 1, 6), CASE WHEN k >= 10 THEN {emp('k // 10')} END, NULL, exit_date
        FROM people WHERE k % 7 = 0 AND hire_date + (365 + k * 53 % 1000)::INT <= {AS_OF}""",
    "raw_changes": """
        SELECT * FROM changes_all WHERE change_type = 'Termination' OR exit_date IS NULL OR change_date <= exit_date""",
    "raw_events": f"""
        SELECT l_orderkey * 10 + l_linenumber AS event_id, 'REQ-' || l_orderkey AS requisition_id,
               'CAND-' || suppkey AS candidate_id, CASE WHEN l_linenumber = 5 THEN {emp('o_custkey')} END AS employee_id,
               c_mktsegment AS job_title, department_id,
               CASE l_linenumber WHEN 2 THEN 'Screening' WHEN 3 THEN 'Interview' WHEN 4 THEN 'Offer' WHEN 5 THEN 'Hired'
                    WHEN 6 THEN 'Rejected' ELSE 'Applied' END AS stage,
               ship_date AS stage_date,
               {case('o_orderpriority', {'1-URGENT': 'LinkedIn', '2-HIGH': 'Referral', '3-MEDIUM': 'Job_Board', '5-LOW': 'Direct'})} AS source
        FROM order_lines JOIN people ON k = o_custkey""",
    # staging
    "stg_employees": """
        SELECT employee_id, full_name, lower(trim(email)) AS email, lower(coalesce(gender, 'unknown')) AS gender,
               birth_date, hire_date, department_id, trim(job_title) AS job_title, level_id, manager_id,
               lower(employment_type) AS employment_type, lower(status) AS status
        FROM raw_employees WHERE hire_date IS NOT NULL""",
    "stg_departments": "SELECT (r_regionkey + 1)::BIGINT AS department_id, r_name AS department_name, NULL::BIGINT AS parent_id FROM region",
    "stg_job_levels": f"""
        SELECT DISTINCT c_custkey % 6 + 1 AS level_id,
               {case('c_custkey % 6', {i: n.capitalize() for i, n in enumerate(LEVELS)})} AS level_name,
               c_custkey % 6 + 1 AS level_rank
        FROM customer""",
    "stg_salary": """
        SELECT salary_id, employee_id, effective_date, amount, upper(coalesce(currency, 'USD')) AS currency,
               lower(coalesce(change_reason, 'unknown')) AS change_reason
        FROM raw_salary WHERE amount > 0""",
    "stg_reviews": """
        SELECT review_id, employee_id, review_date, review_period, left(review_period, 4)::BIGINT AS review_year,
               right(review_period, 1)::BIGINT AS review_quarter, score, manager_id
        FROM raw_reviews WHERE score BETWEEN 100 AND 500""",
    "stg_changes": """
        SELECT change_id, employee_id, change_date, lower(change_type) AS change_type, from_dept_id, from_level_id,
               to_level_id, from_manager_id, lower(exit_type) AS exit_type
        FROM raw_changes""",
    "stg_events": """
        SELECT event_id, requisition_id, candidate_id, employee_id, trim(job_title) AS job_title, department_id,
               lower(stage) AS stage, stage_date, lower(coalesce(source, 'unknown')) AS source,
               (stage = 'Hired')::INT AS is_hired, (stage = 'Rejected')::INT AS is_rejected
        FROM raw_events""",
    # dimensions
    "dim_date": f"""
        SELECT d AS date_day, year(d)::INT AS year, month(d)::INT AS month, day(d)::INT AS day, quarter(d)::INT AS quarter,
               weekofyear(d)::INT AS week_of_year, (dayofweek(d) + 1)::INT AS day_of_week, dayname(d) AS day_name,
               monthname(d) AS month_name, {quarter('d')} AS year_quarter, strftime(d, '%Y-%m') AS year_month_key,
               (dayofweek(d) IN (0, 6))::INT AS is_weekend, last_day(d) AS last_day_of_month
        FROM (SELECT unnest(generate_series(date_trunc('year', low), date_trunc('year', high) + INTERVAL 1 YEAR - INTERVAL 1 DAY,
                                            INTERVAL 1 DAY))::DATE AS d
              FROM (SELECT least((SELECT min(o_orderdate) FROM orders), (SELECT min(l_shipdate) FROM lineitem)) AS low,
                           greatest((SELECT max(o_orderdate) FROM orders), (SELECT max(l_shipdate) FROM lineitem)) AS high))""",
    "dim_department": f"""
        SELECT *, {case('department_id', {1: 'Engineering', 2: 'Product', 3: 'Sales', 4: 'Operations', 5: 'Human Resources'}, "'Other'")} AS department_group
        FROM stg_departments""",
    "dim_job_level": """
        SELECT *, CASE WHEN level_rank <= 2 THEN 'Individual Contributor' WHEN level_rank <= 4 THEN 'Senior / Lead'
                       ELSE 'Management' END AS level_group
        FROM stg_job_levels""",
    "dim_employee": f"""
        WITH versions AS (
            SELECT e.*, hire_date AS valid_from, 0 AS is_change, 0 AS change_id FROM stg_employees e
            UNION ALL
            SELECT e.* REPLACE (coalesce(c.to_level_id, e.level_id) AS level_id), c.change_date, 1, c.change_id
            FROM stg_changes c JOIN stg_employees e USING (employee_id) WHERE c.change_type = 'promotion'),
        numbered AS (
            SELECT *, row_number() OVER w AS n, lead(valid_from) OVER w AS next_from FROM versions
            WINDOW w AS (PARTITION BY employee_id ORDER BY valid_from, is_change, change_id)),
        gone AS (SELECT employee_id, change_date AS exit_date, exit_type FROM stg_changes WHERE change_type = 'termination')
        SELECT employee_id || '-V' || printf('%03d', n) AS employee_sk, employee_id, full_name, email, gender, birth_date,
               hire_date, department_id, job_title, level_id, manager_id, employment_type, status, valid_from,
               CASE WHEN next_from IS NOT NULL THEN greatest(next_from - 1, valid_from)
                    WHEN status = 'terminated' AND exit_date IS NOT NULL THEN greatest(exit_date, valid_from) END AS valid_to,
               (next_from IS NULL)::INT AS is_current,
               (coalesce(exit_date, {AS_OF}) - hire_date)::INT AS tenure_days, exit_date, exit_type
        FROM numbered LEFT JOIN gone USING (employee_id)""",
    # facts
    "fct_performance": f"""
        SELECT review_id, employee_id, review_date, {quarter('review_date')} AS year_quarter, review_year, review_quarter,
               score, {rdiv('sum(score) OVER four', '100 * count(*) OVER four', 6)} AS score_4q_avg, lag(score) OVER w AS prev_score,
               score - coalesce(lag(score) OVER w, score) AS score_delta, row_number() OVER w AS review_seq, manager_id
        FROM stg_reviews
        WINDOW w AS (PARTITION BY employee_id ORDER BY review_date, review_id),
               four AS (PARTITION BY employee_id ORDER BY review_date, review_id ROWS 3 PRECEDING)""",
    "salary_steps": """
        SELECT *, lag(amount) OVER w AS prev, row_number() OVER w AS salary_seq FROM stg_salary
        WINDOW w AS (PARTITION BY employee_id ORDER BY effective_date, salary_id)""",
    "fct_salary": f"""
        SELECT *, amount - coalesce(prev, amount) AS change, {pct('amount - prev', 'prev', 2)} AS change_pct,
               {quarter('effective_date')} AS year_quarter
        FROM salary_steps""",
    "last_salary": """
        SELECT employee_id, amount AS last_salary FROM stg_salary
        QUALIFY row_number() OVER (PARTITION BY employee_id ORDER BY effective_date DESC, salary_id DESC) = 1""",
    "last_review": """
        SELECT employee_id, score AS last_score, score_4q_avg AS last_4q FROM fct_performance
        QUALIFY row_number() OVER (PARTITION BY employee_id ORDER BY review_seq DESC) = 1""",
    "exit_days": """
        SELECT x.*, e.department_id, e.level_id, e.hire_date, (change_date - e.hire_date)::INT AS tenure_days
        FROM stg_changes x JOIN stg_employees e USING (employee_id) WHERE change_type = 'termination'""",
    "fct_attrition": f"""
        SELECT x.*, {rdiv('400 * x.tenure_days', '1461', 0)}::BIGINT AS tenure_h, last_salary, last_score, last_4q
        FROM exit_days x LEFT JOIN last_salary USING (employee_id) LEFT JOIN last_review USING (employee_id)""",
    # marts
    # Headcount by moves: whoever joins adds one from the first month end on, whoever leaves takes it back.
    "headcount_months": f"""
        SELECT last_day_of_month AS month_end, min(year_month_key) AS month_key FROM dim_date
        WHERE date_day BETWEEN DATE '1995-01-01' AND {AS_OF} AND date_day = date_trunc('month', date_day) GROUP BY 1""",
    "headcount_moves": """
        SELECT unnest([hire_date, if(exit_date IS NULL, NULL, greatest(exit_date, hire_date))]) AS on_day, unnest([1, -1]) AS step,
               department_id, level_id, gender, employment_type, tenure_days
        FROM dim_employee WHERE is_current = 1""",
    "headcount_steps": """
        SELECT greatest(last_day(on_day), (SELECT min(month_end) FROM headcount_months)) AS month_end, department_id, level_id,
               sum(step) AS heads, sum(step * (gender = 'female')::INT) AS women, sum(step * (gender = 'male')::INT) AS men,
               sum(step * (employment_type = 'full_time')::INT) AS fulls, sum(step * tenure_days) AS days
        FROM headcount_moves WHERE on_day IS NOT NULL GROUP BY 1, 2, 3""",
    "headcount_base": """
        SELECT month_key AS year_month_key, month_end AS snapshot_date, department_id, level_id, heads AS headcount,
               women AS headcount_female, men AS headcount_male, fulls AS headcount_ft, days AS tenure, heads AS n
        FROM (SELECT month_key, g.month_end, g.department_id, g.level_id,
                           sum(s.heads) OVER upto::BIGINT AS heads, coalesce(sum(s.women) OVER upto, 0)::BIGINT AS women,
                           coalesce(sum(s.men) OVER upto, 0)::BIGINT AS men, coalesce(sum(s.fulls) OVER upto, 0)::BIGINT AS fulls,
                           sum(s.days) OVER upto::BIGINT AS days
                    FROM (SELECT * FROM headcount_months, (SELECT DISTINCT department_id, level_id FROM headcount_steps)) g
                    LEFT JOIN headcount_steps s USING (month_end, department_id, level_id)
                    WINDOW upto AS (PARTITION BY g.department_id, g.level_id ORDER BY g.month_end))
        WHERE heads > 0""",
    "mart_headcount": f"""
        SELECT year_month_key, snapshot_date, department_id, department_name, level_id, level_name, level_group, headcount,
               headcount_female, headcount_male, headcount_ft,
               {rdiv('4 * tenure', '1461 * n', 2)} AS avg_tenure_years, {pct('headcount_female', 'headcount', 1)} AS pct_female
        FROM headcount_base JOIN dim_department USING (department_id) JOIN dim_job_level USING (level_id)""",
    "quarter_hc": f"""
        SELECT {month_quarter('year_month_key')} AS exit_year_quarter, department_id, sum(headcount)::BIGINT AS month_sum,
               count(DISTINCT year_month_key) AS months
        FROM headcount_base GROUP BY 1, 2""",
    "exit_sums": f"""
        SELECT {quarter('change_date')} AS exit_year_quarter, year(change_date)::INT AS exit_year,
               quarter(change_date)::INT AS exit_quarter, department_id, count(*) AS exits_total, count(*) FILTER (exit_type = 'voluntary') AS exits_voluntary,
               count(*) FILTER (exit_type = 'involuntary') AS exits_involuntary,
               count(*) FILTER (exit_type = 'retirement') AS exits_retirement,
               sum(tenure_h) AS tenure, sum(last_score) AS scores, count(last_score) AS n_scores,
               sum(last_salary) AS salaries, count(last_salary) AS n_salaries
        FROM fct_attrition GROUP BY ALL""",
    "mart_attrition": f"""
        SELECT exit_year_quarter, exit_year, exit_quarter, department_id, department_name, exits_total, exits_voluntary,
               exits_involuntary, exits_retirement, {rdiv('month_sum', 'months', 0)} AS avg_headcount,
               {pct('exits_total * months', 'month_sum', 2)} AS attrition_rate_pct,
               {pct('exits_voluntary', 'exits_total', 1)} AS voluntary_pct,
               {rdiv('tenure', '100 * exits_total', 2)} AS avg_tenure_at_exit,
               {rdiv('scores', '100 * n_scores', 2)} AS avg_last_perf_score,
               {rdiv('salaries', '100 * n_salaries', 0)} AS avg_last_salary
        FROM exit_sums LEFT JOIN quarter_hc USING (exit_year_quarter, department_id)
        JOIN dim_department USING (department_id)""",
    # Percentiles from the ordered list of a group's salaries.
    "salary_lists": """
        WITH latest AS (SELECT employee_id, arg_max(amount, salary_seq) AS amount FROM fct_salary GROUP BY 1)
        SELECT department_id, level_id, list_sort(list(amount)) AS pay FROM latest JOIN dim_employee d USING (employee_id)
        WHERE d.status = 'active' AND d.is_current = 1 GROUP BY 1, 2""",
    "mart_compensation": f"""
        SELECT department_id, department_name, level_id, level_name, level_group, len(pay) AS employee_count,
               {rdiv('pay[1]', '100', 0)} AS salary_min, {rdiv('pay[-1]', '100', 0)} AS salary_max,
               {rdiv('list_sum(pay)', '100 * len(pay)', 0)} AS salary_avg,
               {rdiv('pay[len(pay) // 4 + 1]', '100', 0)} AS salary_p25,
               {rdiv('pay[len(pay) // 2 + 1]', '100', 0)} AS salary_median,
               {rdiv('pay[len(pay) * 3 // 4 + 1]', '100', 0)} AS salary_p75,
               {pct('(pay[-1] - pay[1]) * len(pay)', 'list_sum(pay)', 1)} AS salary_spread_pct
        FROM salary_lists JOIN dim_department USING (department_id) JOIN dim_job_level USING (level_id)""",
    # The funnel from the list of who reached which stage of which requisition.
    "funnel_entries": """
        SELECT department_id AS dep, requisition_id AS req, stage, candidate_id AS who, max(stage_date) AS late, min(stage_date) AS early
        FROM stg_events GROUP BY ALL""",
    "funnel_openings": f"""
        SELECT dep, req, min(early) AS opened, {quarter('min(early)')} AS year_quarter FROM funnel_entries GROUP BY ALL""",
    "funnel_stages": """
        SELECT o.year_quarter, dep, sum((stage = 'applied')::INT) AS a, sum((stage = 'screening')::INT) AS s,
               sum((stage = 'interview')::INT) AS i, sum((stage = 'offer')::INT) AS o
        FROM funnel_entries JOIN funnel_openings o USING (dep, req) WHERE who IS NOT NULL GROUP BY 1, 2""",
    "funnel_ends": """
        SELECT dep, req, stage, max(late) AS ended FROM funnel_entries WHERE stage IN ('hired', 'offer') GROUP BY ALL""",
    "hiring_sums": """
        WITH reqs AS (
            SELECT year_quarter, min(opened) AS any_day, dep, count(*) AS n, count(h.ended) AS hired,
                   sum(date_diff('day', opened, h.ended)) AS wait, sum(date_diff('day', opened, f.ended)) FILTER (h.req IS NOT NULL) AS wait_offer,
                   count(f.ended) FILTER (h.req IS NOT NULL) AS offers
            FROM funnel_openings
            LEFT JOIN (SELECT * FROM funnel_ends WHERE stage = 'hired') h USING (dep, req)
            LEFT JOIN (SELECT * FROM funnel_ends WHERE stage = 'offer') f USING (dep, req) GROUP BY ALL)
        SELECT r.year_quarter, year(any_day)::INT AS year, quarter(any_day)::INT AS quarter, r.dep AS department_id,
               r.n AS total_requisitions, coalesce(a, 0)::BIGINT AS cnt_applied, coalesce(s, 0)::BIGINT AS cnt_screening,
               coalesce(i, 0)::BIGINT AS cnt_interview, coalesce(o, 0)::BIGINT AS cnt_offer, hired::BIGINT AS cnt_hired,
               wait AS days_hire, hired AS n_hire, wait_offer AS days_offer, offers AS n_offer
        FROM reqs r LEFT JOIN funnel_stages USING (year_quarter, dep)""",
    "mart_hiring": f"""
        SELECT year_quarter, year, quarter, department_id, department_name, total_requisitions, cnt_applied, cnt_screening,
               cnt_interview, cnt_offer, cnt_hired, {pct('cnt_screening', 'cnt_applied', 1)} AS screening_rate_pct,
               {pct('cnt_interview', 'cnt_screening', 1)} AS interview_rate_pct, {pct('cnt_offer', 'cnt_interview', 1)} AS offer_rate_pct,
               {pct('cnt_hired', 'cnt_offer', 1)} AS offer_accept_rate_pct, {pct('cnt_hired', 'cnt_applied', 1)} AS overall_hire_rate_pct,
               {rdiv('days_hire', 'n_hire', 1)} AS avg_days_to_hire, {rdiv('days_offer', 'n_offer', 1)} AS avg_days_to_offer
        FROM hiring_sums JOIN dim_department USING (department_id)""",
    # reviews by department
    "perf_dist": """
        SELECT year_quarter, department_id, (score * 2 // 100)::DOUBLE / 2 AS score_bucket, count(*) AS cnt
        FROM fct_performance JOIN (SELECT * FROM dim_employee WHERE is_current = 1) USING (employee_id) GROUP BY ALL""",
    "perf_by_dept": """
        SELECT year_quarter, department_id, department_name, sum(score)::BIGINT AS sum_h, count(*) AS n_reviews
        FROM fct_performance JOIN (SELECT * FROM dim_employee WHERE is_current = 1) USING (employee_id)
        JOIN dim_department USING (department_id) GROUP BY ALL""",
}


def _features(name: str, cutoff: str) -> None:
    """Feature frame at a cutoff, and the fixed linear score on it (contributions in millionths)."""
    _CTE[f"perf_{name}"] = f"""
        SELECT employee_id, count(*) AS num_reviews, count(DISTINCT manager_id) AS num_managers,
               sum(score)::DOUBLE / (100 * count(*))::DOUBLE AS avg_score,
               arg_max(score, review_seq) AS last_score, arg_max(score_4q_avg, review_seq) AS last_4q_avg,
               arg_max(score_delta, review_seq) AS last_score_delta
        FROM fct_performance WHERE review_date <= {cutoff} GROUP BY 1"""
    _CTE[f"sal_{name}"] = f"""
        SELECT employee_id, count(*) OVER (PARTITION BY employee_id) AS num_salary_changes, amount AS current_salary,
               change_pct AS last_salary_delta_pct, ({cutoff} - effective_date)::INT AS days_since_last_raise
        FROM fct_salary WHERE effective_date <= {cutoff}
        QUALIFY row_number() OVER (PARTITION BY employee_id ORDER BY salary_seq DESC) = 1"""
    _CTE[f"rate_{name}"] = f"""
        SELECT department_id, (count(*) FILTER (exit_date <= {cutoff}))::DOUBLE / count(*)::DOUBLE AS dept_attrition_rate
        FROM dim_employee WHERE is_current = 1 AND hire_date <= {cutoff} GROUP BY 1"""
    _CTE[f"pop_{name}"] = f"""
        SELECT employee_id, gender, birth_date, hire_date, department_id, level_id, employment_type, exit_date
        FROM dim_employee
        WHERE is_current = 1 AND hire_date <= {cutoff} AND (exit_date IS NULL OR exit_date > {cutoff})"""
    _CTE[f"feat_{name}"] = f"""
        SELECT employee_id, gender, department_id, level_id, employment_type, coalesce(num_reviews, 0) AS num_reviews,
               coalesce(num_managers, 0) AS num_managers, coalesce(avg_score, 0) AS avg_score,
               coalesce(last_score, 0) AS last_score, coalesce(last_4q_avg, 0) AS last_4q_avg,
               coalesce(last_score_delta, 0) AS last_score_delta, coalesce(num_salary_changes, 0) AS num_salary_changes,
               coalesce(current_salary, 0) AS current_salary, coalesce(last_salary_delta_pct, 0) AS last_salary_delta_pct,
               coalesce(days_since_last_raise, 9999) AS days_since_last_raise,
               coalesce({rdiv(f"4 * ({cutoff} - birth_date)", '1461', 1)}, 0) AS age,
               ({cutoff} - hire_date)::INT AS tenure_days_at_cutoff, coalesce(dept_attrition_rate, 0) AS dept_attrition_rate,
               (exit_date IS NOT NULL AND exit_date > {cutoff} AND exit_date <= {cutoff} + 180)::INT AS left_180d
        FROM pop_{name} LEFT JOIN perf_{name} USING (employee_id) LEFT JOIN sal_{name} USING (employee_id)
        LEFT JOIN rate_{name} USING (department_id)"""
    _CTE[f"parts_{name}"] = f"""
        SELECT employee_id, unnest([
            {{'feature': 'last_score', 'micro': (last_score - 300) * -1200}},
            {{'feature': 'days_since_last_raise', 'micro': (days_since_last_raise - 400) * 300}},
            {{'feature': 'tenure_days_at_cutoff', 'micro': (tenure_days_at_cutoff - 900) * -100}},
            {{'feature': 'num_reviews', 'micro': (num_reviews - 10) * -5000}}], recursive := true)
        FROM feat_{name}"""
    _CTE[f"ranked_{name}"] = f"""
        SELECT *, row_number() OVER (PARTITION BY employee_id ORDER BY micro DESC, feature) AS place
        FROM parts_{name} WHERE micro > 0"""
    micro = "least(greatest(350000 + total, 0), 1000000)"
    drivers = ", ".join(
        f"max(feature) FILTER (place = {i}) AS driver_{i}, max(micro) FILTER (place = {i}) AS micro_{i}" for i in (1, 2, 3)
    )
    impacts = ", ".join(f"driver_{i}, {rdiv(f'micro_{i}', '1000000', 4)} AS driver_{i}_impact" for i in (1, 2, 3))
    _CTE[f"score_{name}"] = f"""
        SELECT employee_id, {cutoff} AS scored_at, {rdiv(micro, '1000000', 4)} AS risk_score,
               {rdiv(micro, '1000000', 4)} * 10000 AS points_raw,
               CASE WHEN {micro} >= 600000 THEN 'high' WHEN {micro} >= 300000 THEN 'medium' ELSE 'low' END AS risk_band,
               {impacts}
        FROM (SELECT employee_id, sum(micro)::BIGINT AS total FROM parts_{name} GROUP BY 1)
        LEFT JOIN (SELECT employee_id, {drivers} FROM ranked_{name} GROUP BY 1) USING (employee_id)"""


_features("train", CUTOFF)
_features("now", AS_OF)
_features("early", "DATE '1997-06-30'")

_CTE["scores"] = "SELECT * FROM score_train UNION ALL SELECT * FROM score_now"
_CTE["scored_now"] = """
    SELECT s.*, department_id, department_name, level_id, level_name, tenure_days
    FROM scores s JOIN (SELECT * FROM dim_employee WHERE is_current = 1) USING (employee_id)
    JOIN dim_department USING (department_id) JOIN dim_job_level USING (level_id)
    WHERE scored_at = (SELECT max(scored_at) FROM scores)"""
_LABELS = {
    "last_score": "Low latest review score",
    "days_since_last_raise": "Long time since the last raise",
    "tenure_days_at_cutoff": "Short tenure",
    "num_reviews": "Number of reviews",
}


def _label(column: str) -> str:
    return f"coalesce({case(column, _LABELS, column)}, '')"


_CTE["risk_detail"] = f"""
    SELECT employee_id, risk_score, risk_band, {', '.join(f"{_label(f'driver_{i}')} AS driver_{i}" for i in (1, 2, 3))},
           department_id, department_name, level_id, level_name, tenure_days, last_review_quarter, scored_at
    FROM scored_now LEFT JOIN (SELECT employee_id, max(year_quarter) AS last_review_quarter FROM fct_performance GROUP BY 1)
      USING (employee_id)"""
_CTE["labelled"] = "SELECT s.*, f.left_180d AS y, round(points_raw)::BIGINT AS points FROM score_train s JOIN feat_train f USING (employee_id)"


def _sql(body: str) -> str:
    """Prefix the shared steps that ``body`` needs, in dependency order."""
    needed: list[str] = []

    def visit(text: str, own: str = "") -> None:
        for name in _CTE:
            if name != own and name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                visit(_CTE[name], name)
                needed.append(name)

    visit(body)
    prelude = ",\n".join(f"{name} AS ({_CTE[name]})" for name in needed)
    if not prelude:
        return body
    own_steps = body.lstrip().startswith("WITH ")
    return f"WITH {prelude},\n{body.lstrip()[5:]}" if own_steps else f"WITH {prelude}\n{body}"


ORACLE: dict[str, str] = {}


def _add(name: str, body: str) -> None:
    ORACLE[name] = _sql(body)


# ---------------------------------------------------------------- sources and loads

_add("src_files", "SELECT * FROM customer")
_add("load_full", "SELECT event_id, event_type, value FROM events")
_KEYS = {
    "raw_departments": ("stg_departments", "department_id"), "raw_job_levels": ("stg_job_levels", "level_id"),
    "raw_employees": ("raw_employees", "employee_id"), "raw_salary_history": ("raw_salary", "salary_id"),
    "raw_performance_reviews": ("raw_reviews", "review_id"), "raw_job_changes": ("raw_changes", "change_id"),
    "raw_recruitment_events": ("raw_events", "event_id"),
}
_add(
    "run_load",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(DISTINCT {k}) AS n_rows, count(DISTINCT {k}) AS n_keys FROM {step}" for t, (step, k) in _KEYS.items()
    ),
)
_MARK = "(SELECT coalesce(max(event_id), 0) FROM events WHERE ts < TIMESTAMP '2024-01-15')"
_add(
    "load_incremental_pk",
    f"""SELECT event_id, user_id, event_type, value, 0 AS is_new FROM events WHERE ts < TIMESTAMP '2024-01-15'
        UNION ALL
        SELECT event_id, user_id, event_type, value, 1 FROM events
        WHERE event_id > {_MARK} AND event_id NOT IN (SELECT event_id FROM events WHERE ts < TIMESTAMP '2024-01-15')""",
)
_add(
    "watermark_update",
    f"""SELECT 'events' AS table_name, greatest({_MARK}, max(event_id)) AS last_loaded_id,
               count(*) FILTER (ts < TIMESTAMP '2024-01-15') + count(*) FILTER (event_id > {_MARK}) AS rows_loaded
        FROM events""",
)
_add(
    "load_replace",
    "SELECT employee_id, department_id, CASE WHEN status = 'TERMINATED' THEN status ELSE 'HIRED' END AS status FROM raw_employees",
)
_add(
    "load_replace_files",
    """SELECT employee_id, department_id, CASE WHEN employee_id BETWEEN 'EMP-000100' AND 'EMP-000115' THEN 'MOVED'
                                               WHEN status = 'TERMINATED' THEN status ELSE 'HIRED' END AS status
       FROM raw_employees""",
)
_add(
    "insert_ignore",
    """SELECT l_orderkey * 10 + l_linenumber AS line_id, l_partkey, l_suppkey, l_shipdate::DATE AS ship_date, l_quantity,
              l_extendedprice
       FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey * 10 + 1 = l_orderkey * 10 + l_linenumber)
       QUALIFY row_number() OVER (PARTITION BY l_orderkey * 10 + l_linenumber
                                  ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice) = 1""",
)
_add("add_lineage", "SELECT employee_id, '2001-08-01 00:00:00' AS _loaded_at, 'star.employees' AS _source FROM raw_employees")
_add("stream_incremental_load", "SELECT event_id, user_id, event_type, value FROM events")
_NUM = "CASE WHEN {0} IS NULL THEN 'null' WHEN {0} = floor({0}) THEN {0}::BIGINT::VARCHAR ELSE {0}::VARCHAR END"


# ---------------------------------------------------------------- staging

_add("stg_departments", "SELECT * FROM stg_departments")
_add("stg_job_levels", "SELECT * FROM stg_job_levels")
_add("stg_employees", "SELECT *, '2001-08-01 00:00:00' AS _loaded_at FROM stg_employees")
_add("stg_salary_history", f"SELECT * EXCLUDE (amount), {cents('amount')} AS salary_amount FROM stg_salary")
_add("stg_performance_reviews", f"SELECT * REPLACE ({cents('score')} AS score) FROM stg_reviews")
_add(
    "stg_job_changes",
    """SELECT *, NULL::BIGINT AS to_dept_id, NULL::VARCHAR AS to_manager_id, NULL::DOUBLE AS from_salary,
              NULL::DOUBLE AS to_salary FROM stg_changes""",
)
_add("stg_recruitment_events", "SELECT * FROM stg_events")
_add(
    "clamp_events_to_exit",
    f"SELECT salary_id, employee_id, effective_date, {cents('amount')} AS salary_amount FROM raw_salary",
)
_add(
    "clamp_report",
    """SELECT 'salary' AS events, (SELECT count(*) FROM raw_salary) AS kept,
              (SELECT count(*) FROM salary_all) - (SELECT count(*) FROM raw_salary) AS dropped
       UNION ALL SELECT 'review', (SELECT count(*) FROM raw_reviews),
              (SELECT count(*) FROM reviews_all) - (SELECT count(*) FROM raw_reviews)
       UNION ALL SELECT 'job_change', (SELECT count(*) FROM raw_changes),
              (SELECT count(*) FROM changes_all) - (SELECT count(*) FROM raw_changes)""",
)
_add(
    "quarters_between",
    f"""SELECT employee_id, q::DATE AS quarter_start, year(q)::INT AS year, quarter(q)::INT AS quarter
        FROM (SELECT employee_id, unnest(generate_series(date_trunc('quarter', hire_date), coalesce(exit_date, {AS_OF}),
                                                         INTERVAL 3 MONTH)) AS q
              FROM dim_employee WHERE is_current = 1)""",
)

# ---------------------------------------------------------------- models

for _name in ("dim_date", "dim_department", "dim_job_level", "dim_employee", "mart_headcount", "mart_attrition",
              "mart_compensation", "mart_hiring"):
    _add(_name, f"SELECT * FROM {_name}")
_add(
    "fct_performance",
    f"""SELECT * REPLACE ({cents('score')} AS score, {cents('prev_score')} AS prev_score, {cents('score_delta')} AS score_delta)
        FROM fct_performance""",
)
_add(
    "fct_salary",
    f"""SELECT salary_id, employee_id, effective_date, {cents('amount')} AS salary_amount, currency, change_reason,
               {cents('prev')} AS prev_salary, salary_seq, {cents('change')} AS salary_delta,
               change_pct AS salary_delta_pct, year_quarter
        FROM fct_salary""",
)
_add(
    "fct_attrition",
    f"""SELECT change_id AS attrition_id, employee_id, change_date AS exit_date, exit_type, department_id, level_id,
               hire_date, tenure_days, tenure_h::DOUBLE / 100 AS tenure_years, {cents('last_salary')} AS last_salary,
               {cents('last_score')} AS last_perf_score, last_4q AS last_4q_avg_score,
               {quarter('change_date')} AS exit_year_quarter, year(change_date)::INT AS exit_year,
               quarter(change_date)::INT AS exit_quarter
        FROM fct_attrition""",
)
_add(
    "scd2_build",
    """SELECT o_custkey, valid_from, o_orderkey, o_orderpriority, row_number() OVER w AS version_num,
              lead(valid_from) OVER w AS next_valid_from,
              CASE WHEN lead(valid_from) OVER w IS NOT NULL THEN greatest(lead(valid_from) OVER w - 1, valid_from) END AS valid_to,
              (lead(valid_from) OVER w IS NULL)::INT AS is_current
       FROM (SELECT o_custkey, o_orderdate::DATE AS valid_from, o_orderkey, o_orderpriority FROM orders)
       WINDOW w AS (PARTITION BY o_custkey ORDER BY valid_from, o_orderkey)""",
)
_add(
    "scd2_as_of",
    f"""SELECT employee_sk, employee_id, level_id, valid_from, valid_to FROM dim_employee
        WHERE valid_from <= {CUTOFF} AND (valid_to IS NULL OR valid_to >= {CUTOFF})""",
)
_add("dim_employee_incremental", "SELECT * FROM dim_employee")
_add("mart_headcount_incremental", "SELECT * FROM mart_headcount")
_add("mart_compensation_sketched", "SELECT * FROM mart_compensation")
_add(
    "sketched_percentiles",
    f"""SELECT department_id, level_id, count(*) AS n, {cents('min(amount)')} AS low, {cents('max(amount)')} AS high,
               1 AS p25_near, 1 AS p50_near, 1 AS p75_near
        FROM fct_salary JOIN (SELECT employee_id, department_id, level_id FROM dim_employee WHERE is_current = 1) USING (employee_id)
        GROUP BY GROUPING SETS ((department_id, level_id), (department_id))""",
)
_add(
    "headcount_distinct",
    f"""SELECT year_quarter, department_id, count(DISTINCT employee_id) AS employees, 1 AS employees_near
        FROM dim_employee JOIN (SELECT * FROM dim_date WHERE day = 1 AND date_day BETWEEN DATE '1995-01-01' AND {AS_OF})
          ON hire_date <= last_day_of_month AND (exit_date IS NULL OR exit_date > last_day_of_month)
        WHERE is_current = 1 GROUP BY ALL""",
)
_add(
    "hiring_distinct",
    f"""SELECT {quarter('stage_date')} AS year_quarter, department_id,
               {', '.join(f"count(DISTINCT candidate_id) FILTER (stage = '{s}') AS {s}, 1 AS {s}_near" for s in ('applied', 'screening', 'offer'))}
        FROM stg_events GROUP BY ALL""",
)
_HELD = "valid_from IS NOT NULL AND (valid_to IS NULL OR valid_to >= effective_date)"
_add(
    "scd2_as_of_join",
    f"""SELECT salary_id, s.employee_id, effective_date, {cents('amount')} AS salary_amount,
               {', '.join(f'CASE WHEN {_HELD} THEN {c} END AS {c}' for c in ('employee_sk', 'level_id', 'department_id', 'manager_id'))}
        FROM fct_salary s ASOF LEFT JOIN (
            SELECT employee_id, valid_from, valid_to, employee_sk, level_id, department_id, manager_id FROM dim_employee
            QUALIFY row_number() OVER (PARTITION BY employee_id, valid_from ORDER BY employee_sk DESC) = 1
        ) v ON s.employee_id = v.employee_id AND s.effective_date >= v.valid_from""",
)
_add(
    "last_by_key",
    f"""SELECT * EXCLUDE (amount), {cents('amount')} AS salary_amount FROM stg_salary
        QUALIFY row_number() OVER (PARTITION BY employee_id ORDER BY effective_date DESC, salary_id DESC) = 1""",
)
_ORDERS = """(SELECT o_orderkey, o_custkey, o_orderdate::DATE AS order_date, (o_totalprice::DECIMAL(12,2) * 100)::BIGINT AS c
              FROM orders)"""
_BY_CUSTOMER = "(PARTITION BY o_custkey ORDER BY order_date, o_orderkey)"
_add(
    "rolling_mean",
    f"""SELECT o_orderkey, o_custkey, order_date, {cents('c')} AS price,
               {rdiv('sum(c) OVER w', '100 * count(*) OVER w', 4)} AS mean_3
        FROM {_ORDERS} WINDOW w AS (PARTITION BY o_custkey ORDER BY order_date, o_orderkey ROWS 2 PRECEDING)""",
)
_add(
    "lag_delta",
    f"""SELECT o_orderkey, o_custkey, order_date, {cents('c')} AS price,
               {cents(f'c - coalesce(lag(c) OVER {_BY_CUSTOMER}, c)')} AS price_delta FROM {_ORDERS}""",
)
_add(
    "pct_change",
    f"""SELECT o_orderkey, o_custkey, order_date, {cents('c')} AS price, {pct('c - p', 'p', 2)} AS price_change_pct
        FROM (SELECT *, lag(c) OVER {_BY_CUSTOMER} AS p FROM {_ORDERS})""",
)
_add(
    "snapshot_counts",
    f"""SELECT year_month_key, last_day_of_month AS snapshot_date, o_orderpriority, count(*) AS open_orders,
               sum(o_orderkey)::BIGINT AS key_sum
        FROM (SELECT DISTINCT year_month_key, last_day_of_month FROM dim_date
              WHERE day = 1 AND date_day BETWEEN DATE '1995-01-01' AND {AS_OF})
        JOIN (SELECT o_orderkey, o_orderpriority, o_orderdate::DATE AS ordered,
                     (SELECT max(l_shipdate)::DATE FROM lineitem WHERE l_orderkey = o_orderkey) AS shipped FROM orders)
          ON ordered <= last_day_of_month AND (shipped IS NULL OR shipped > last_day_of_month)
        GROUP BY ALL""",
)
_add(
    "discrete_percentile",
    f"""SELECT l_returnflag, l_linestatus, {cents('max(c) FILTER (rn = n // 4 + 1)')} AS p25,
               {cents('max(c) FILTER (rn = n // 2 + 1)')} AS p50, {cents('max(c) FILTER (rn = n * 3 // 4 + 1)')} AS p75,
               {cents('max(c) FILTER (rn = n * 9 // 10 + 1)')} AS p90
        FROM (SELECT *, row_number() OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY c) AS rn,
                     count(*) OVER (PARTITION BY l_returnflag, l_linestatus) AS n
              FROM (SELECT l_returnflag, l_linestatus, (l_extendedprice::DECIMAL(12,2) * 100)::BIGINT AS c FROM lineitem))
        GROUP BY ALL""",
)
_STAGES = ("applied", "screening", "interview", "offer", "hired")
_add(
    "funnel_conversion",
    f"""SELECT *, {', '.join(f"{pct(f'cnt_{b}', f'cnt_{a}', 1)} AS {a}_to_{b}_pct" for a, b in zip(_STAGES, _STAGES[1:]))}
        FROM (SELECT department_id, {', '.join(f"count(DISTINCT candidate_id) FILTER (stage = '{s}') AS cnt_{s}" for s in _STAGES)}
              FROM stg_events GROUP BY 1)""",
)
_add(
    "safe_rate",
    f"""SELECT *, {pct('returned', 'lines', 2)} AS returned_pct, {pct('returned', 'huge', 2)} AS returned_of_huge_pct
        FROM (SELECT l_linenumber, count(*) AS lines, count(*) FILTER (l_returnflag = 'R') AS returned,
                     count(*) FILTER (l_quantity > 1000) AS huge FROM lineitem GROUP BY 1)""",
)

# ---------------------------------------------------------------- exports

_EXPORTS = {
    "exp_departments": ("dim_department", "department_id, department_name"),
    "exp_levels": ("dim_job_level", "level_id, level_name, level_group"),
    "exp_headcount": ("mart_headcount", "* EXCLUDE (snapshot_date, level_group, headcount_ft)"),
    "exp_attrition": ("mart_attrition", "* EXCLUDE (exit_year, exit_quarter)"),
    "exp_compensation": ("mart_compensation", "*"),
    "exp_hiring": ("mart_hiring", "* EXCLUDE (year, quarter, avg_days_to_offer)"),
}
for _name, (_table, _columns) in _EXPORTS.items():
    _add(_name, f"SELECT {_columns} FROM {_table}")
_add("perf_dist", "SELECT * FROM perf_dist")
_add("perf_by_dept", f"SELECT * EXCLUDE (sum_h), {cents('sum_h')} AS sum_score FROM perf_by_dept")
_add("latest_scores", "SELECT * EXCLUDE (points_raw) FROM scores WHERE scored_at = (SELECT max(scored_at) FROM scores)")
_MEAN = rdiv("sum(round(risk_score * 10000)::BIGINT)", "10000 * count(*)", 3)
_add("risk_bands", f"SELECT risk_band, count(*) AS cnt, {_MEAN} AS avg_score FROM scored_now GROUP BY ALL")
_add(
    "risk_bands_by_dept",
    f"SELECT department_id, department_name, risk_band, count(*) AS cnt, {_MEAN} AS avg_score FROM scored_now GROUP BY ALL",
)
_add("risk_bands_by_level", "SELECT level_id, level_name, risk_band, count(*) AS cnt FROM scored_now GROUP BY ALL")
_add(
    "risk_bands_by_dept_level",
    "SELECT department_id, department_name, level_id, level_name, risk_band, count(*) AS cnt FROM scored_now GROUP BY ALL",
)
_add(
    "risk_by_dept",
    "SELECT department_name, count(*) AS high_cnt FROM scored_now WHERE risk_band = 'high' GROUP BY ALL",
)
_add("risk_detail", "SELECT * FROM risk_detail")
_add(
    "driver_labels",
    f"SELECT employee_id, scored_at, {', '.join(f'{_label(f'driver_{i}')} AS driver_{i}' for i in (1, 2, 3))} FROM scores",
)

# ---------------------------------------------------------------- report

_MONTHS = "year_month_key BETWEEN '1997-02' AND '1999-08'"
_IN_QUARTERS = f"IN (SELECT {month_quarter('year_month_key')} FROM mart_headcount WHERE {_MONTHS})"
_SOME = "department_id = 2 AND level_id = 3"
_LATEST = f"(SELECT max(year_month_key) FROM mart_headcount WHERE {_MONTHS})"


def _hc_kpis(scope: str) -> str:
    return f"""
        WITH months AS (SELECT DISTINCT year_month_key FROM mart_headcount WHERE {_MONTHS}),
        sums AS (SELECT m.year_month_key, coalesce(sum(headcount), 0)::BIGINT AS hc, coalesce(sum(headcount_female), 0)::BIGINT AS fem,
                        coalesce(sum(headcount_male), 0)::BIGINT AS mal,
                        coalesce(sum(round(avg_tenure_years * 100)::BIGINT * headcount), 0)::BIGINT AS ten
                 FROM months m LEFT JOIN (SELECT * FROM mart_headcount WHERE {scope}) h USING (year_month_key) GROUP BY 1),
        two AS (SELECT *, coalesce(lag(hc) OVER (ORDER BY year_month_key), 0) AS prev FROM sums)
        SELECT year_month_key AS latest_month, hc AS headcount, prev AS prev_headcount, hc - prev AS change,
               coalesce({pct('hc - prev', 'prev', 4)}, 0) AS change_pct, fem AS headcount_female, mal AS headcount_male,
               coalesce({pct('fem', 'hc', 4)}, 0) AS pct_female, coalesce({rdiv('ten', '100 * hc', 4)}, 0) AS avg_tenure_years
        FROM two QUALIFY row_number() OVER (ORDER BY year_month_key DESC) = 1"""


def _hc_change(scope: str, column: str, period: str) -> str:
    return f"""
        WITH months AS (SELECT DISTINCT year_month_key FROM mart_headcount WHERE {_MONTHS}),
        sums AS (SELECT m.year_month_key, coalesce(sum({column}), 0)::BIGINT AS hc
                 FROM months m LEFT JOIN (SELECT * FROM mart_headcount WHERE {scope}) h USING (year_month_key) GROUP BY 1),
        ends AS (SELECT min(year_month_key) AS start_month, max(year_month_key) AS end_month,
                        arg_min(hc, year_month_key) AS start_headcount, arg_max(hc, year_month_key) AS end_headcount,
                        greatest(count(DISTINCT {period}) - 1, 1) AS periods FROM sums),
        diff AS (SELECT *, end_headcount - start_headcount AS change FROM ends)
        SELECT *, coalesce({pct('change', 'start_headcount', 4)}, 0) AS change_pct, {rdiv('change', 'periods', 4)} AS avg_per_period,
               CASE WHEN change > 0 THEN 'up' WHEN change < 0 THEN 'down' ELSE 'flat' END AS direction
        FROM diff"""


def _hc_yoy(scope: str) -> str:
    return f"""
        SELECT a.year_month_key, a.department_id, a.department_name, a.level_id, a.level_name, a.headcount, a.headcount_female,
               a.pct_female, a.avg_tenure_years, b.headcount AS prev, {delta('a.headcount', 'b.headcount')},
               {status('female', 'a.pct_female')} AS female_status
        FROM (SELECT * FROM mart_headcount WHERE {_MONTHS} AND {scope}) a
        LEFT JOIN mart_headcount b ON b.department_id = a.department_id AND b.level_id = a.level_id
         AND b.year_month_key = (a.year_month_key[1:4]::INT - 1)::VARCHAR || a.year_month_key[5:]"""


_add("filter_dept", "SELECT * EXCLUDE (exit_year, exit_quarter) FROM mart_attrition WHERE department_id = 2")
_add(
    "filter_dept_level",
    f"SELECT * EXCLUDE (snapshot_date, level_group, headcount_ft) FROM mart_headcount WHERE {_SOME}",
)
_add("months_in_range", f"SELECT DISTINCT year_month_key FROM mart_headcount WHERE {_MONTHS}")
_add(
    "quarters_in_range",
    f"SELECT DISTINCT {month_quarter('year_month_key')} AS year_quarter FROM mart_headcount WHERE {_MONTHS}",
)
_add("last_n_months", "SELECT DISTINCT year_month_key FROM mart_headcount ORDER BY 1 DESC LIMIT 24")
_add("filter_headcount", f"SELECT * FROM mart_headcount WHERE {_MONTHS} AND {_SOME}")
_add("filter_attrition", f"SELECT * FROM mart_attrition WHERE department_id = 2 AND exit_year_quarter {_IN_QUARTERS}")
_add("filter_hiring", f"SELECT * FROM mart_hiring WHERE department_id = 2 AND year_quarter {_IN_QUARTERS}")
_add("filter_perf_dist", f"SELECT * FROM perf_dist WHERE department_id = 2 AND year_quarter {_IN_QUARTERS}")
_add(
    "filter_perf_by_dept",
    f"""SELECT * EXCLUDE (sum_h), {cents('sum_h')} AS sum_score FROM perf_by_dept
        WHERE department_id = 2 AND year_quarter {_IN_QUARTERS}""",
)
_add("hc_kpis", _hc_kpis(_SOME))
_add("hc_kpis_range", _hc_kpis("true"))
_add("hc_change", _hc_change(_SOME, "headcount", month_quarter("year_month_key")))
_add("hc_change_range", _hc_change("true", "headcount_female", "year_month_key"))
_add("hc_yoy", _hc_yoy(_SOME))
_add("hc_yoy_range", _hc_yoy("true"))
_add(
    "hc_trend",
    f"""SELECT q.period, d.department_id, d.department_name, coalesce(sum(h.headcount), 0)::BIGINT AS headcount
        FROM (SELECT {month_quarter('year_month_key')} AS period, max(year_month_key) AS m FROM mart_headcount
              WHERE {_MONTHS} GROUP BY 1) q
        CROSS JOIN (SELECT * FROM dim_department WHERE department_id = 2) d
        LEFT JOIN (SELECT * FROM mart_headcount WHERE {_SOME}) h ON h.year_month_key = q.m AND h.department_id = d.department_id
        GROUP BY ALL""",
)
_add(
    "hc_trend_range",
    f"""SELECT m.year_month_key AS period, d.department_id, d.department_name, coalesce(sum(h.headcount), 0)::BIGINT AS headcount
        FROM (SELECT DISTINCT year_month_key FROM mart_headcount WHERE {_MONTHS}) m CROSS JOIN dim_department d
        LEFT JOIN mart_headcount h ON h.year_month_key = m.year_month_key AND h.department_id = d.department_id
        GROUP BY ALL""",
)
_add(
    "hc_breakdown",
    f"""SELECT level_name AS name, sum(headcount)::BIGINT AS headcount FROM mart_headcount
        WHERE {_SOME} AND year_month_key = {_LATEST} GROUP BY 1""",
)
_add(
    "hc_breakdown_range",
    f"""SELECT department_name AS name, sum(headcount_female)::BIGINT AS headcount FROM mart_headcount
        WHERE year_month_key = {_LATEST} GROUP BY 1""",
)
_add(
    "hc_breakdown_all",
    """SELECT department_name AS name, sum(headcount_female)::BIGINT AS female, sum(headcount_male)::BIGINT AS male
       FROM mart_headcount WHERE year_month_key = (SELECT max(year_month_key) FROM mart_headcount) GROUP BY 1""",
)
_RATE = "round(attrition_rate_pct * 100)::BIGINT"
_MEAN_RATE = rdiv(f"sum({_RATE})", "100 * count(attrition_rate_pct)", 4)
_add(
    "attrition_kpis",
    f"""WITH picked AS (SELECT * FROM mart_attrition WHERE exit_year_quarter {_IN_QUARTERS}),
        quarters AS (SELECT exit_year_quarter, {_MEAN_RATE} AS r FROM picked GROUP BY 1 HAVING count(attrition_rate_pct) > 0),
        ends AS (SELECT min(exit_year_quarter) AS first_quarter, max(exit_year_quarter) AS latest_quarter,
                        arg_min(r, exit_year_quarter) AS first_rate, arg_max(r, exit_year_quarter) AS latest_rate FROM quarters)
        SELECT sum(exits_total)::BIGINT AS exits_total, sum(exits_voluntary)::BIGINT AS exits_voluntary,
               {pct('sum(exits_voluntary)', 'sum(exits_total)', 4)} AS voluntary_pct, {_MEAN_RATE} AS avg_rate,
               any_value(first_quarter) AS first_quarter, any_value(latest_quarter) AS latest_quarter,
               any_value(first_rate) AS first_rate, any_value(latest_rate) AS latest_rate,
               any_value((round(latest_rate * 10000) - round(first_rate * 10000)) / 10000) AS rate_change
        FROM picked, ends""",
)
_add(
    "completed_quarters",
    f"""SELECT exit_year_quarter, {_MEAN_RATE} AS mean_rate FROM mart_attrition WHERE attrition_rate_pct IS NOT NULL GROUP BY 1""",
)
_add(
    "latest_completed_rate",
    f"""SELECT exit_year_quarter AS latest_quarter, {_MEAN_RATE} AS latest_rate FROM mart_attrition
        WHERE attrition_rate_pct IS NOT NULL GROUP BY 1 ORDER BY 1 DESC LIMIT 1""",
)
_add(
    "attrition_by_quarter",
    f"""SELECT exit_year_quarter, sum(exits_voluntary)::BIGINT AS voluntary, sum(exits_involuntary)::BIGINT AS involuntary,
               sum(exits_retirement)::BIGINT AS retirement
        FROM mart_attrition WHERE exit_year_quarter IN (SELECT {month_quarter('year_month_key')} FROM mart_headcount)
        GROUP BY 1""",
)
_add(
    "attrition_rank",
    f"""SELECT *, {status('attrition', 'mean_rate')} AS status, (dense_rank() OVER (ORDER BY mean_rate DESC))::INT AS rank
        FROM (SELECT department_name, {_MEAN_RATE} AS mean_rate FROM mart_attrition
              WHERE exit_year_quarter {_IN_QUARTERS} AND attrition_rate_pct IS NOT NULL GROUP BY 1)""",
)
_QUARTER_BEFORE = "(a.{0}[1:4]::INT - 1)::VARCHAR || a.{0}[5:]"
_add(
    "attrition_yoy",
    f"""SELECT a.exit_year_quarter, a.department_id, a.department_name, a.exits_total, a.exits_voluntary, a.exits_involuntary,
               a.attrition_rate_pct, b.exits_total AS prev, {delta('a.exits_total', 'b.exits_total', True)},
               coalesce({pct('a.exits_voluntary', 'a.exits_total', 4)}, 0) AS voluntary_pct,
               {status('attrition', 'a.attrition_rate_pct')} AS rate_status
        FROM (SELECT * FROM mart_attrition WHERE exit_year_quarter {_IN_QUARTERS}) a
        LEFT JOIN mart_attrition b ON b.department_id = a.department_id
         AND b.exit_year_quarter = {_QUARTER_BEFORE.format('exit_year_quarter')}""",
)
_add(
    "perf_buckets",
    f"""SELECT score_bucket, sum(cnt)::BIGINT AS cnt FROM perf_dist
        WHERE department_id = 2 AND year_quarter {_IN_QUARTERS} GROUP BY 1""",
)
_PERF_SUMS = """sum(cnt)::BIGINT AS total_reviews, coalesce(sum(cnt) FILTER (score_bucket < 3), 0)::BIGINT AS cnt_low,
                coalesce(sum(cnt) FILTER (score_bucket >= 4), 0)::BIGINT AS cnt_high,
                sum((score_bucket * 2)::BIGINT * cnt)::BIGINT AS halves"""
_add(
    "perf_summary",
    f"""SELECT total_reviews, {rdiv('halves', '2 * total_reviews', 4)} AS bucket_weighted_mean, cnt_low, cnt_high,
               {pct('cnt_low', 'total_reviews', 4)} AS low_pct, {pct('cnt_high', 'total_reviews', 4)} AS high_pct
        FROM (SELECT {_PERF_SUMS} FROM perf_dist WHERE year_quarter {_IN_QUARTERS})""",
)
_add(
    "perf_by_dept_summary",
    f"""SELECT * FROM (
            SELECT department_id, department_name, {rdiv('sum(sum_h)', '100 * sum(n_reviews)', 2)} AS avg_score,
                   sum(n_reviews)::BIGINT AS n_reviews
            FROM perf_by_dept WHERE year_quarter {_IN_QUARTERS} GROUP BY 1, 2)
        LEFT JOIN (SELECT department_id, coalesce(sum(cnt) FILTER (score_bucket < 3), 0)::BIGINT AS cnt_low,
                          coalesce(sum(cnt) FILTER (score_bucket >= 4), 0)::BIGINT AS cnt_high
                   FROM perf_dist WHERE year_quarter {_IN_QUARTERS} GROUP BY 1) USING (department_id)""",
)
_MEDIAN = rdiv("sum(salary_median::BIGINT * employee_count)", "sum(employee_count)", 4)
_add(
    "comp_summary",
    f"""SELECT sum(employee_count)::BIGINT AS employees, {_MEDIAN} AS weighted_median, count(*) AS bands,
               max(salary_spread_pct) AS max_spread_pct,
               first(department_name ORDER BY salary_spread_pct DESC, department_id, level_id) AS spread_department,
               first(level_name ORDER BY salary_spread_pct DESC, department_id, level_id) AS spread_level
        FROM mart_compensation WHERE department_id = 2""",
)
_add("comp_by_level", f"SELECT level_id, level_name, {_MEDIAN} AS weighted_median FROM mart_compensation GROUP BY 1, 2")
_add("comp_rank_dept", f"SELECT department_name, {_MEDIAN} AS weighted_median FROM mart_compensation GROUP BY 1")
_DAYS = rdiv(
    "sum(round(avg_days_to_hire * 10)::BIGINT * cnt_hired) FILTER (cnt_hired > 0)",
    "10 * sum(cnt_hired) FILTER (cnt_hired > 0)",
    4,
)
_HIRING_SUMS = "sum(total_requisitions)::BIGINT AS total_requisitions, " + ", ".join(
    f"sum(cnt_{s})::BIGINT AS cnt_{s}" for s in _STAGES
)
_add(
    "hiring_summary",
    f"""SELECT *, {pct('cnt_hired', 'cnt_applied', 4)} AS hire_rate_pct
        FROM (SELECT {_HIRING_SUMS}, {_DAYS} AS avg_days_to_hire FROM mart_hiring WHERE year_quarter {_IN_QUARTERS})""",
)
_add(
    "hiring_trend",
    f"""SELECT year_quarter, sum(cnt_hired)::BIGINT AS cnt_hired FROM mart_hiring
        WHERE department_id = 2 AND year_quarter {_IN_QUARTERS} GROUP BY 1""",
)
_add(
    "hiring_yoy",
    f"""SELECT a.year_quarter, a.department_id, a.department_name, a.cnt_applied, a.cnt_offer, a.cnt_hired,
               a.overall_hire_rate_pct, a.avg_days_to_hire, b.cnt_hired AS prev, {delta('a.cnt_hired', 'b.cnt_hired')},
               CASE WHEN a.overall_hire_rate_pct >= 5 THEN 'ok' ELSE 'warn' END AS rate_status,
               CASE WHEN a.avg_days_to_hire > 35 THEN 'bad' WHEN a.avg_days_to_hire > 25 THEN 'warn' ELSE 'ok' END AS days_status
        FROM (SELECT * FROM mart_hiring WHERE year_quarter {_IN_QUARTERS}) a
        LEFT JOIN mart_hiring b ON b.department_id = a.department_id
         AND b.year_quarter = {_QUARTER_BEFORE.format('year_quarter')}""",
)
_BANDS = ", ".join(f"count(*) FILTER (risk_band = '{b}') AS {b}" for b in ("high", "medium", "low"))
_add(
    "band_counts",
    f"""SELECT *, {', '.join(f"{pct(b, 'total', 4)} AS {b}_pct" for b in ('high', 'medium', 'low'))}
        FROM (SELECT {_BANDS}, count(*) AS total FROM risk_detail WHERE department_id = 2)""",
)
_LONG = "department_id = 3 AND coalesce(tenure_days, 0) >= 1825"
_RISKY = "department_id = 3 AND risk_band = 'high' AND coalesce(tenure_days, 0) >= 1825"
_add(
    "risk_filtered",
    f"SELECT * FROM risk_detail WHERE {_RISKY} ORDER BY risk_score DESC, employee_id",
)
_add("risk_filtered_some", f"SELECT * FROM risk_detail WHERE {_LONG} ORDER BY risk_score DESC, employee_id")
_add("risk_filtered_top", f"SELECT * FROM risk_detail WHERE {_LONG} ORDER BY risk_score DESC, employee_id LIMIT 5")
_add(
    "risk_heatmap",
    """SELECT *, greatest(max(high_risk) OVER (), 1) AS max_cell
       FROM (SELECT d.department_id, d.department_name, l.level_name, count(r.employee_id) AS high_risk
             FROM dim_department d CROSS JOIN (SELECT DISTINCT level_name FROM dim_job_level) l
             LEFT JOIN (SELECT * FROM risk_detail WHERE risk_band = 'high') r
               ON r.department_id = d.department_id AND r.level_name = l.level_name
             GROUP BY ALL)""",
)
_add(
    "risk_hotspot",
    """SELECT department_id, department_name, level_id, level_name, count(*) AS cnt FROM risk_detail
       WHERE risk_band = 'high' GROUP BY ALL ORDER BY cnt DESC, department_id, level_id LIMIT 1""",
)
_add(
    "most_common_driver",
    """SELECT driver_1, count(*) AS cnt
       FROM (SELECT *, row_number() OVER (ORDER BY risk_score DESC, employee_id) AS pos FROM risk_detail)
       WHERE driver_1 <> '' GROUP BY 1 ORDER BY count(*) DESC, min(pos) LIMIT 1""",
)
_add(
    "export_headcount_csv",
    f"""SELECT year_month_key AS year_month, department_name AS dept, level_name AS level, headcount,
               headcount_female AS female, headcount_male AS male, pct_female, avg_tenure_years
        FROM mart_headcount WHERE {_SOME} AND year_month_key = {_LATEST}""",
)
_add(
    "export_attrition_csv",
    f"""SELECT exit_year_quarter AS quarter, department_name AS dept, exits_total, exits_voluntary, exits_involuntary,
               attrition_rate_pct
        FROM mart_attrition WHERE department_id = 2 AND exit_year_quarter {_IN_QUARTERS}""",
)
_add(
    "export_comp_csv",
    """SELECT department_name AS dept, level_name AS level, employee_count, salary_p25 AS p25, salary_median AS median,
              salary_p75 AS p75, salary_spread_pct AS spread_pct FROM mart_compensation WHERE department_id = 2""",
)
_add(
    "export_hiring_csv",
    f"""SELECT year_quarter AS quarter, department_name AS dept, cnt_applied AS applied, cnt_offer AS offer,
               cnt_hired AS hired, overall_hire_rate_pct AS hire_rate_pct, avg_days_to_hire AS time_to_hire_days
        FROM mart_hiring WHERE department_id = 2 AND year_quarter {_IN_QUARTERS}""",
)
_add(
    "export_risk_csv",
    f"""SELECT employee_id, department_name AS dept, level_name AS level, risk_score, risk_band, tenure_days,
               {rdiv('4 * tenure_days', '1461', 1)} AS tenure_years, coalesce(last_review_quarter, '') AS last_review_quarter,
               scored_at, driver_1, driver_2, driver_3
        FROM risk_detail WHERE {_RISKY}""",
)
_add(
    "export_risk_csv_some",
    f"""SELECT employee_id, department_name AS dept, level_name AS level, risk_score, risk_band, tenure_days,
               {rdiv('4 * tenure_days', '1461', 1)} AS tenure_years, coalesce(last_review_quarter, '') AS last_review_quarter,
               scored_at, driver_1, driver_2, driver_3
        FROM risk_detail WHERE {_LONG}""",
)
_add(
    "delta",
    f"""SELECT from_dept_id, cur, prev, {delta('cur', 'prev')}, CASE WHEN cur <> prev THEN (cur < prev)::INT END AS good_if_lower
        FROM (SELECT from_dept_id, count(*) FILTER (year(change_date) = 1998) AS cur,
                     count(*) FILTER (year(change_date) = 1997) AS prev
              FROM stg_changes WHERE change_type = 'promotion' GROUP BY 1)""",
)
_add(
    "status_of",
    f"""SELECT *, {case('status', {'ok': 'On-track', 'warn': 'At-Risk', 'bad': 'Off-track'}, "'-'")} AS status_label
        FROM (SELECT 'attrition' AS kind, exit_year_quarter || '|' || department_id AS key,
                     {status('attrition', 'attrition_rate_pct')} AS status FROM mart_attrition
              UNION ALL SELECT 'hire', year_quarter || '|' || department_id, {status('hire', 'overall_hire_rate_pct')} FROM mart_hiring
              UNION ALL SELECT 'tth', year_quarter || '|' || department_id, {status('tth', 'avg_days_to_hire')} FROM mart_hiring
              UNION ALL SELECT 'spread', department_id || '|' || level_id, {status('spread', 'salary_spread_pct')} FROM mart_compensation
              UNION ALL SELECT 'female', year_month_key || '|' || department_id || '|' || level_id,
                               {status('female', 'pct_female')} FROM mart_headcount
              UNION ALL SELECT 'perf', review_id::VARCHAR, {status('perf', 'score / 100')} FROM fct_performance)""",
)
_add(
    "tenure_group",
    f"""SELECT employee_sk, tenure_days, CASE WHEN tenure_days < 730 THEN 'lt2' WHEN tenure_days < 1825 THEN '2to5' ELSE 'gt5' END AS tenure_group,
               {rdiv('4 * tenure_days', '1461', 1)} AS tenure_years FROM dim_employee""",
)
_ALL_QUARTERS = f"IN (SELECT {month_quarter('year_month_key')} FROM mart_headcount)"
_FIGURES = f"""
    figures AS (
        SELECT 'attrition_rate' AS metric, {_MEAN_RATE} AS value,
               (SELECT department_name FROM mart_attrition WHERE exit_year_quarter {_ALL_QUARTERS} AND attrition_rate_pct IS NOT NULL
                GROUP BY 1 ORDER BY {_MEAN_RATE} DESC, 1 LIMIT 1) AS subject
        FROM mart_attrition WHERE exit_year_quarter {_ALL_QUARTERS}
        UNION ALL
        SELECT 'low_score_share', {pct('cnt_low', 'total_reviews', 4)}, NULL
        FROM (SELECT {_PERF_SUMS} FROM perf_dist WHERE year_quarter {_ALL_QUARTERS})
        UNION ALL
        SELECT 'voluntary_share', {pct('sum(exits_voluntary)', 'sum(exits_total)', 4)}, NULL
        FROM mart_attrition WHERE exit_year_quarter {_ALL_QUARTERS}
        UNION ALL
        SELECT 'salary_spread', max(salary_spread_pct),
               first(department_name || ' / ' || level_name ORDER BY salary_spread_pct DESC, department_id, level_id) FROM mart_compensation
        UNION ALL
        SELECT 'days_to_hire', {_DAYS}, NULL FROM mart_hiring WHERE year_quarter {_ALL_QUARTERS}
        UNION ALL
        SELECT 'female_share', {pct('sum(headcount_female)', 'sum(headcount)', 4)}, NULL FROM mart_headcount
        WHERE year_month_key = (SELECT max(year_month_key) FROM mart_headcount))"""


def _with(step: str, body: str) -> str:
    """Shared steps, one extra step, and the final query."""
    return _sql(f"{body}\n/* {step} */").replace(f"\n{body}\n/* {step} */", f",\n{step}\n{body}")


ORACLE["insights"] = _with(
    _FIGURES,
    """SELECT CASE metric WHEN 'attrition_rate' THEN CASE WHEN value > 8 THEN 'alert' WHEN value > 6 THEN 'warn' ELSE 'good' END
                   WHEN 'low_score_share' THEN CASE WHEN value > 25 THEN 'alert' WHEN value > 15 THEN 'warn' ELSE 'good' END
                   WHEN 'voluntary_share' THEN CASE WHEN value > 70 THEN 'warn' ELSE 'info' END
                   WHEN 'salary_spread' THEN CASE WHEN value > 60 THEN 'warn' ELSE 'good' END
                   ELSE CASE WHEN value > 35 THEN 'warn' ELSE 'good' END END AS kind, metric, value, subject
       FROM figures WHERE metric <> 'female_share'""",
)
ORACLE["recommendations"] = _with(
    _FIGURES
    + """,
    found AS (
        SELECT CASE WHEN metric IN ('attrition_rate', 'low_score_share') THEN 'high'
                    WHEN metric IN ('salary_spread', 'days_to_hire') THEN 'mid' ELSE 'test' END AS priority,
               CASE WHEN metric = 'attrition_rate' AND value > 8 THEN 'stay_interviews'
                    WHEN metric = 'low_score_share' AND value > 25 THEN 'improvement_plans'
                    WHEN metric = 'salary_spread' AND value > 60 THEN 'pay_equity_review'
                    WHEN metric = 'days_to_hire' AND value > 35 THEN 'shorten_hiring'
                    WHEN metric = 'female_share' AND value < 35 THEN 'diversity_pilot' END AS action, metric, value, subject
        FROM figures)""",
    """SELECT * FROM found WHERE action IS NOT NULL
       UNION ALL
       SELECT 'test', 'keep_monitoring', 'none', NULL, NULL WHERE NOT EXISTS (SELECT 1 FROM found WHERE action IS NOT NULL)""",
)
_RISK_FIGURES = f"""
    figures AS (
        SELECT 'high_share' AS metric, {pct("count(*) FILTER (risk_band = 'high')", 'count(*)', 4)} AS value, NULL AS subject FROM risk_detail
        UNION ALL SELECT 'high_count', count(*), NULL FROM risk_detail WHERE risk_band = 'high'
        UNION ALL SELECT 'medium_count', count(*), NULL FROM risk_detail WHERE risk_band = 'medium'
        UNION ALL
        (SELECT 'hotspot', count(*), any_value(department_name || ' / ' || level_name) FROM risk_detail WHERE risk_band = 'high'
         GROUP BY department_id, level_id ORDER BY count(*) DESC, department_id, level_id LIMIT 1)
        UNION ALL
        (SELECT 'top_driver', count(*), driver_1
         FROM (SELECT *, row_number() OVER (ORDER BY risk_score DESC, employee_id) AS pos FROM risk_detail)
         WHERE driver_1 <> '' GROUP BY driver_1 ORDER BY count(*) DESC, min(pos) LIMIT 1))"""
ORACLE["ml_insights"] = _with(
    _RISK_FIGURES,
    """SELECT CASE metric WHEN 'high_share' THEN CASE WHEN value > 12 THEN 'alert' WHEN value > 8 THEN 'warn' ELSE 'good' END
                   WHEN 'hotspot' THEN 'warn' ELSE 'info' END AS kind, metric, value::DOUBLE AS value, subject
       FROM figures WHERE metric IN ('high_share', 'hotspot', 'top_driver')
       UNION ALL SELECT 'info', 'score_reading', NULL, 'ranking_not_probability'""",
)
ORACLE["ml_recommendations"] = _with(
    _RISK_FIGURES,
    """SELECT CASE metric WHEN 'high_count' THEN 'high' WHEN 'medium_count' THEN 'mid' ELSE 'test' END AS priority,
              CASE metric WHEN 'high_count' THEN 'retention_talks' WHEN 'medium_count' THEN 'regular_check_ins'
                   ELSE 'calibrate_scores' END AS action, metric, value::DOUBLE AS value, subject
       FROM figures WHERE metric = 'high_share' OR (metric IN ('high_count', 'medium_count') AND value > 0)""",
)
_ALERT_RATE = rdiv(f"sum({_RATE})", "100 * count(attrition_rate_pct)", 2)
_add(
    "attrition_alert",
    f"""SELECT exit_year_quarter, rate, 10.0::DOUBLE AS threshold, (rate > 10)::INT AS is_alert
        FROM (SELECT exit_year_quarter, {_ALERT_RATE} AS rate FROM mart_attrition WHERE attrition_rate_pct IS NOT NULL
              GROUP BY 1 ORDER BY 1 DESC LIMIT 1)""",
)

# ---------------------------------------------------------------- features and metrics

_add("feat_population", "SELECT * FROM pop_train")
_SCORES = f"{cents('last_score')} AS last_score, {cents('last_score_delta')} AS last_score_delta"
_add("feat_performance", f"SELECT * REPLACE ({_SCORES}) FROM perf_train")
_add("feat_salary", f"SELECT * REPLACE ({cents('current_salary')} AS current_salary) FROM sal_train")
_add("dept_attrition_rate", "SELECT * FROM rate_train")
_add(
    "label_within",
    f"""SELECT employee_id, (exit_date IS NOT NULL AND exit_date > {CUTOFF} AND exit_date <= {CUTOFF} + 180)::INT AS left_180d
        FROM dim_employee WHERE is_current = 1""",
)
_add(
    "years_between",
    f"""SELECT employee_id, coalesce({rdiv(f'4 * ({AS_OF} - birth_date)', '1461', 1)}, 0) AS age,
               coalesce({rdiv(f'4 * ({AS_OF} - exit_date)', '1461', 1)}, 0) AS since_exit
        FROM dim_employee WHERE is_current = 1""",
)
_add("build_features", f"SELECT * REPLACE ({_SCORES}, {cents('current_salary')} AS current_salary) FROM feat_train")
_add(
    "one_hot",
    """SELECT employee_id, age, (gender = 'female')::INT AS gender_female, (gender = 'male')::INT AS gender_male,
              (gender = 'unknown')::INT AS gender_unknown, (employment_type = 'contract')::INT AS employment_type_contract,
              (employment_type = 'full_time')::INT AS employment_type_full_time,
              (employment_type = 'part_time')::INT AS employment_type_part_time FROM feat_train""",
)
_add(
    "align_features",
    "SELECT employee_id, age, 0::DOUBLE AS gender_female, (gender = 'male')::INT::DOUBLE AS gender_male FROM feat_train",
)
_HASHED = """(SELECT employee_id, left_180d,
                     row_number() OVER (PARTITION BY left_180d ORDER BY md5(employee_id || '-42'), employee_id) AS r,
                     count(*) OVER (PARTITION BY left_180d) AS n FROM feat_train)"""
_add(
    "stratified_split",
    f"SELECT employee_id, left_180d, CASE WHEN r <= (2 * n + 5) // 10 THEN 'test' ELSE 'train' END AS split FROM {_HASHED}",
)
_add("stratified_kfold", f"SELECT employee_id, left_180d, ((r - 1) % 5)::INT AS fold FROM {_HASHED}")
_add(
    "class_weight",
    """SELECT n_neg, n_pos, n_neg::DOUBLE / greatest(n_pos, 1)::DOUBLE AS weight
       FROM (SELECT count(*) FILTER (left_180d = 0) AS n_neg, count(*) FILTER (left_180d = 1) AS n_pos FROM feat_train)""",
)
_PARTS = f"SELECT employee_id, left_180d, CASE WHEN r <= (2 * n + 5) // 10 THEN 'test' ELSE 'train' END AS split, 1 AS in_range FROM {_HASHED}"
_add("train_gbt", f"SELECT *, 1 AS better_than_chance FROM ({_PARTS})")
_add("train_logreg", f"SELECT *, 1 AS at_optimum FROM ({_PARTS})")
_add("score_active", f"SELECT employee_id, {AS_OF} AS scored_at, 1 AS in_range, 1 AS band_agrees FROM feat_now")
_add("explain_linear", "SELECT employee_id, 1 AS adds_up FROM feat_train")
_add(
    "kfold_cv",
    """SELECT employee_id, left_180d, ((row_number() OVER (PARTITION BY left_180d ORDER BY md5(employee_id || '-42'), employee_id) - 1) % 5)::INT AS fold,
              1 AS in_range, 5::BIGINT AS k, 1 AS roc_agrees, 1 AS pr_agrees, 1 AS std_agrees FROM feat_train""",
)
_add(
    "out_of_time",
    """SELECT employee_id, left_180d, 1 AS in_range, (SELECT count(*) FROM feat_early) AS n_train, (SELECT count(*) FROM feat_train) AS n_test,
              (SELECT round(round(avg(left_180d), 4), 3) FROM feat_early) AS base_rate_train,
              (SELECT round(round(avg(left_180d), 4), 3) FROM feat_train) AS base_rate_test, 1 AS roc_agrees, 1 AS pr_agrees FROM feat_train""",
)
_add("verdict_of_model", "SELECT 1 AS fed, 1 AS drop_agrees, 1 AS over_time_agrees, 1 AS over_folds_agrees, 1 AS signal_agrees")
_NUMERIC = (
    "department_id level_id num_reviews num_managers avg_score last_score last_4q_avg last_score_delta num_salary_changes current_salary "
    "last_salary_delta_pct days_since_last_raise age tenure_days_at_cutoff dept_attrition_rate"
).split()
_add(
    "feature_importance",
    f"""SELECT feature, 1 AS in_range, 1 AS sums_to_one
        FROM (SELECT unnest({_NUMERIC}) AS feature UNION SELECT 'gender_' || gender FROM feat_train WHERE gender IS NOT NULL
              UNION SELECT 'employment_type_' || employment_type FROM feat_train WHERE employment_type IS NOT NULL)""",
)
_add("linear_contributions", "SELECT employee_id, feature, micro::DOUBLE / 1000000 AS impact FROM parts_train")
_add(
    "top_drivers",
    f"SELECT employee_id, {', '.join(f'driver_{i}, driver_{i}_impact' for i in (1, 2, 3))} FROM score_train",
)
_add(
    "risk_band",
    """SELECT employee_id, risk_score, CASE WHEN points >= 6000 THEN 'high' WHEN points >= 3000 THEN 'medium' ELSE 'low' END AS risk_band
       FROM labelled""",
)


def _auc(table: str, score: str, y: str, group: str = "") -> str:
    """Share of (positive, negative) pairs in the right order; equal scores count half."""
    keys, match = (f"{group}, ", f" AND a.{group} = b.{group}") if group else ("", "")
    lead = f"a.{group}, " if group else ""
    return f"""SELECT {lead}sum(CASE WHEN a.s > b.s THEN 2 WHEN a.s = b.s THEN 1 ELSE 0 END)::DOUBLE / (2 * count(*))::DOUBLE AS auc_roc
               FROM (SELECT {keys}{score} AS s FROM {table} WHERE {y} = 1) a
               JOIN (SELECT {keys}{score} AS s FROM {table} WHERE {y} = 0) b ON true{match} {'GROUP BY 1' if group else ''}"""


_add("roc_auc", _auc("labelled", "points", "y"))
_add(
    "average_precision",
    """SELECT round(sum(step * hits / flagged), 10) AS auc_pr
       FROM (SELECT sum(y)::DOUBLE / sum(sum(y)) OVER () AS step, sum(sum(y)) OVER w AS hits, sum(count(*)) OVER w AS flagged
             FROM labelled GROUP BY points WINDOW w AS (ORDER BY points DESC))""",
)
_add("brier_score", "SELECT round(sum((points - 10000 * y) ** 2) / (count(*) * 100000000.0), 10) AS brier_score FROM labelled")
_CELLS = """count(*) FILTER (y = 0 AND points < 5000) AS tn, count(*) FILTER (y = 0 AND points >= 5000) AS fp,
            count(*) FILTER (y = 1 AND points < 5000) AS fn, count(*) FILTER (y = 1 AND points >= 5000) AS tp"""
_add("confusion_matrix", f"SELECT {_CELLS} FROM labelled")


def _share(num: str, den: str) -> str:
    return f"coalesce(({num})::DOUBLE / NULLIF({den}, 0), 0)"


_add(
    "classification_report",
    f"""WITH m AS (SELECT {_CELLS} FROM labelled),
        r AS (SELECT {_share('tn', 'tn + fn')} AS p0, {_share('tn', 'tn + fp')} AS r0, {_share('2 * tn', '2 * tn + fn + fp')} AS f0,
                     {_share('tp', 'tp + fp')} AS p1, {_share('tp', 'tp + fn')} AS r1, {_share('2 * tp', '2 * tp + fp + fn')} AS f1,
                     tn + fp AS n0, tp + fn AS n1, tn + fp + fn + tp AS n, {_share('tn + tp', 'tn + fp + fn + tp')} AS acc FROM m),
        rows AS (SELECT '0' AS class, p0 AS p, r0 AS r, f0 AS f, n0 AS support FROM r
                 UNION ALL SELECT '1', p1, r1, f1, n1 FROM r UNION ALL SELECT 'accuracy', acc, acc, acc, n FROM r
                 UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n FROM r
                 UNION ALL SELECT 'weighted avg', (p0 * n0 + p1 * n1) / n, (r0 * n0 + r1 * n1) / n, (f0 * n0 + f1 * n1) / n, n FROM r)
        SELECT class, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, support FROM rows""",
)
_add(
    "threshold_sweep",
    f"""WITH c AS (SELECT t, count(*) FILTER (points >= t * 10000) AS n_flagged, count(*) FILTER (points >= t * 10000 AND y = 1) AS tp,
                          sum(y)::BIGINT AS pos
                   FROM labelled CROSS JOIN (SELECT unnest([0.3, 0.4, 0.5, 0.6, 0.7]) AS t) GROUP BY t),
        m AS (SELECT t::DOUBLE AS threshold, round({_share('tp', 'n_flagged')}, 3) AS precision, round({_share('tp', 'pos')}, 3) AS recall,
                     round({_share('2 * tp', 'n_flagged + pos')}, 3) AS f1, n_flagged FROM c)
        SELECT *, (row_number() OVER (ORDER BY f1 DESC, threshold) = 1)::INT AS is_best FROM m""",
)
_add(
    "calibration_curve",
    """WITH e AS (SELECT quantile_cont(risk_score, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS edges FROM labelled),
       b AS (SELECT risk_score, y, len(list_filter(edges, lambda q: q < risk_score))::INT AS bin FROM labelled, e)
       SELECT bin, round(avg(risk_score), 4) AS mean_pred, round(avg(y), 4) AS frac_pos, count(*) AS n FROM b GROUP BY 1""",
)
_add(
    "single_feature_auc",
    " UNION ALL ".join(
        f"SELECT '{feature}' AS feature, auc_roc FROM ({_auc('feat_train', f'{sign} * {feature}', 'left_180d')})"
        for feature, sign in (
            ("last_score", -1), ("days_since_last_raise", 1), ("dept_attrition_rate", 1), ("last_4q_avg", -1),
            ("tenure_days_at_cutoff", -1),
        )
    ),
)
_add(
    "verdict",
    f"""WITH folds AS (SELECT l.y, l.points, (row_number() OVER (PARTITION BY l.y ORDER BY md5(employee_id || '-42'), employee_id) - 1) % 5 AS fold
                       FROM labelled l),
        cv AS (SELECT round(avg(auc_roc), 4) AS m, round(stddev_pop(auc_roc), 4) AS s FROM ({_auc('folds', 'points', 'y', 'fold')})),
        o AS (SELECT round(auc_roc, 4) AS a FROM ({_auc('labelled', 'points', 'y')})),
        b AS (SELECT round(auc_roc, 4) AS l FROM ({_auc('feat_train', '-1 * last_score', 'left_180d')}))
        SELECT a AS oot_auc, m AS cv_auc, s AS cv_std, l AS linear_auc, round(m - a, 6) AS drop,
               CASE WHEN round(m - a, 6) <= 0.04 THEN 'generalizes' ELSE 'drifts' END AS over_time,
               CASE WHEN s <= 0.02 THEN 'stable' ELSE 'unstable' END AS over_folds,
               CASE WHEN l >= m THEN 'mostly_linear' ELSE 'nonlinear_gain' END AS signal
        FROM o, cv, b""",
)

# ---------------------------------------------------------------- data tests


def _test(kind: str, table: str, column: str, failures: str) -> str:
    return f"SELECT '{kind}' AS test, '{table}' AS \"table\", '{column}' AS \"column\", ({failures}) AS failures"


def _tests(name: str, *parts: str) -> None:
    _add(name, " UNION ALL ".join(parts))


_tests(
    "test_not_null",
    *[
        _test("not_null", "raw_employees", c, f"SELECT count(*) FROM raw_employees WHERE {c} IS NULL")
        for c in ("employee_id", "gender", "manager_id")
    ],
)
_tests(
    "test_unique",
    _test("unique", "lineitem", "l_orderkey",
          "SELECT count(*) FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1)"),
)
_tests(
    "test_accepted_values",
    _test("accepted_values", "stg_recruitment_events", "stage",
          "SELECT count(*) FROM stg_events WHERE stage NOT IN ('applied', 'screening', 'offer')"),
)
_tests(
    "test_range",
    _test("range", "stg_performance_reviews", "score", "SELECT count(*) FROM stg_reviews WHERE score NOT BETWEEN 200 AND 450"),
)
_tests(
    "test_expression",
    _test("expression", "dim_employee", "ends_after_start", "SELECT count(*) FROM dim_employee WHERE valid_to > valid_from"),
)
_tests(
    "test_relationships",
    _test("relationships", "raw_performance_reviews", "manager_id",
          """SELECT count(*) FROM raw_reviews WHERE manager_id NOT IN
             (SELECT employee_id FROM dim_employee WHERE is_current = 1 AND exit_date IS NULL)"""),
)
_tests(
    "exit_tests",
    _test("unique", "stg_job_changes", "employee_id",
          """SELECT count(*) FROM (SELECT employee_id FROM stg_changes WHERE change_type = 'termination'
                                   GROUP BY 1 HAVING count(*) > 1)"""),
)
# The names of the shared steps behind the published table names.
_STEP = {
    "raw_departments": "stg_departments", "raw_job_levels": "stg_job_levels", "raw_salary_history": "raw_salary",
    "raw_performance_reviews": "raw_reviews", "raw_job_changes": "raw_changes", "raw_recruitment_events": "raw_events",
    "stg_salary_history": "stg_salary", "stg_performance_reviews": "stg_reviews", "stg_job_changes": "stg_changes",
    "stg_recruitment_events": "stg_events",
}
_COLUMN = {"salary_amount": "amount", "attrition_id": "change_id"}
_STATUS = "'active', 'terminated', 'on_leave'"
_DECLARED = [
    ("raw_employees", "employee_id", ("hire_date",), {"status": _STATUS}),
    ("raw_departments", "department_id", (), {}),
    ("raw_job_levels", "level_id", (), {}),
    ("raw_salary_history", "salary_id", ("employee_id", "salary_amount"), {}),
    ("raw_performance_reviews", "review_id", ("employee_id", "score"), {}),
    ("raw_job_changes", "change_id", ("employee_id",), {}),
    ("raw_recruitment_events", "event_id", (), {}),
    ("stg_employees", "employee_id", ("hire_date",),
     {"status": _STATUS, "employment_type": "'full_time', 'part_time', 'contract'"}),
    ("stg_salary_history", "salary_id", ("salary_amount",), {}),
    ("stg_performance_reviews", "review_id", ("score",), {}),
    ("stg_job_changes", "change_id", (),
     {"change_type": "'promotion', 'transfer', 'demotion', 'termination', 'rehire'"}),
    ("dim_employee", "employee_sk", ("employee_id",), {"is_current": "0, 1"}),
    ("dim_department", "department_id", (), {}),
    ("dim_job_level", "level_id", (), {}),
    ("fct_performance", "review_id", ("employee_id",), {}),
    ("fct_attrition", "attrition_id", ("employee_id",), {"exit_type": "'voluntary', 'involuntary', 'retirement'"}),
    ("fct_salary", "salary_id", (), {}),
]


def _declared() -> list[str]:
    out = [_test("expression", "dim_employee", "valid_window", "SELECT count(*) FROM dim_employee WHERE valid_to < valid_from")]
    for table, key, others, accepted in _DECLARED:
        step = _STEP.get(table, table)
        for c in (key, *others):
            out.append(_test("not_null", table, c, f"SELECT count(*) FROM {step} WHERE {_COLUMN.get(c, c)} IS NULL"))
        k = _COLUMN.get(key, key)
        out.append(_test("unique", table, key, f"SELECT count(*) FROM (SELECT {k} FROM {step} GROUP BY 1 HAVING count(*) > 1)"))
        for c, values in accepted.items():
            value = f"lower({c})" if table.startswith("raw_") else c
            out.append(_test("accepted_values", table, c, f"SELECT count(*) FROM {step} WHERE {value} NOT IN ({values})"))
    return out


_tests("declared_tests", *_declared())
_tests("declared_tests_observed", *_declared())
_REFERENCES = [
    ("raw_departments", "parent_id", "stg_departments", "department_id"),
    ("raw_employees", "department_id", "stg_departments", "department_id"),
    ("raw_employees", "level_id", "stg_job_levels", "level_id"),
    ("raw_employees", "manager_id", "raw_employees", "employee_id"),
    ("raw_salary_history", "employee_id", "raw_employees", "employee_id"),
    ("raw_performance_reviews", "employee_id", "raw_employees", "employee_id"),
    ("raw_performance_reviews", "manager_id", "raw_employees", "employee_id"),
    ("raw_job_changes", "employee_id", "raw_employees", "employee_id"),
    ("raw_job_changes", "from_dept_id", "stg_departments", "department_id"),
    ("raw_job_changes", "to_dept_id", None, None),
    ("raw_job_changes", "from_level_id", "stg_job_levels", "level_id"),
    ("raw_job_changes", "to_level_id", "stg_job_levels", "level_id"),
    ("raw_job_changes", "from_manager_id", "raw_employees", "employee_id"),
    ("raw_job_changes", "to_manager_id", None, None),
    ("raw_recruitment_events", "employee_id", "raw_employees", "employee_id"),
    ("raw_recruitment_events", "department_id", "stg_departments", "department_id"),
]
_tests(
    "reference_tests",
    *[
        _test(
            "relationships", table, column,
            # Columns the binding leaves NULL have nothing to look up.
            "SELECT 0::BIGINT" if parent is None else
            f"SELECT count(*) FROM {_STEP.get(table, table)} WHERE {column} NOT IN (SELECT {key} FROM {parent})",
        )
        for table, column, parent, key in _REFERENCES
    ],
)

# ---------------------------------------------------------------- pipeline

_MODELS = (
    "raw_departments", "raw_job_levels", "raw_employees", "raw_salary_history", "raw_performance_reviews",
    "raw_job_changes", "raw_recruitment_events", "stg_departments", "stg_job_levels", "stg_employees",
    "stg_salary_history", "stg_performance_reviews", "stg_job_changes", "stg_recruitment_events", "dim_date",
    "dim_department", "dim_job_level", "dim_employee", "fct_performance", "fct_salary", "fct_attrition",
    "mart_headcount", "mart_attrition", "mart_compensation", "mart_hiring",
)
_add(
    "run_models",
    " UNION ALL ".join(f"SELECT '{m}' AS model, count(*) AS row_count FROM {_STEP.get(m, m)}" for m in _MODELS),
)
# The export bundle: each section's registered query, its columns in order, one JSON object per row.
_SECTIONS = {
    "departments": ("exp_departments", "department_id department_name"),
    "levels": ("exp_levels", "level_id level_name level_group"),
    "headcount": (
        "exp_headcount",
        "year_month_key department_id department_name level_id level_name headcount headcount_female headcount_male avg_tenure_years pct_female",
    ),
    "attrition": (
        "exp_attrition",
        "exit_year_quarter department_id department_name exits_total exits_voluntary exits_involuntary exits_retirement avg_headcount "
        "attrition_rate_pct voluntary_pct avg_tenure_at_exit avg_last_perf_score avg_last_salary",
    ),
    "compensation": (
        "exp_compensation",
        "department_id department_name level_id level_name level_group employee_count salary_min salary_max salary_avg salary_p25 "
        "salary_median salary_p75 salary_spread_pct",
    ),
    "hiring": (
        "exp_hiring",
        "year_quarter department_id department_name total_requisitions cnt_applied cnt_screening cnt_interview cnt_offer cnt_hired "
        "screening_rate_pct interview_rate_pct offer_rate_pct offer_accept_rate_pct overall_hire_rate_pct avg_days_to_hire",
    ),
    "perf_dist": ("perf_dist", "year_quarter department_id score_bucket cnt"),
    "perf_by_dept": ("perf_by_dept", "year_quarter department_id department_name sum_score n_reviews"),
}
_RISK_SECTIONS = {
    "risk/bands": ("risk_bands", "risk_band cnt avg_score"),
    "risk/top": (
        "risk_detail",
        "employee_id risk_score risk_band driver_1 driver_2 driver_3 department_id department_name level_id level_name tenure_days "
        "last_review_quarter scored_at",
    ),
    "risk/by_dept": ("risk_by_dept", "department_name high_cnt"),
    "risk/bands_by_dept": ("risk_bands_by_dept", "department_id department_name risk_band cnt avg_score"),
    "risk/bands_by_level": ("risk_bands_by_level", "level_id level_name risk_band cnt"),
    "risk/bands_by_dept_level": ("risk_bands_by_dept_level", "department_id department_name level_id level_name risk_band cnt"),
}
_TEXT = ("_name", "_group", "_key", "_quarter", "_band", "employee_id", "driver_1", "driver_2", "driver_3", "scored_at")


def _json(columns: str) -> str:
    cells = [f"""'"{c}":' || """ + (f"coalesce(to_json({c}::VARCHAR)::VARCHAR, 'null')" if c.endswith(_TEXT) else _NUM.format(c)) for c in columns.split()]
    return "'{' || " + " || ',' || ".join(cells) + " || '}'"


def _section_rows(sections: dict) -> str:
    rows = [f"SELECT '{name}' AS section, {_json(columns)} AS value FROM ({ORACLE[source]})" for name, (source, columns) in sections.items()]
    return " UNION ALL ".join(rows)


ORACLE["export_json_bundle"] = _section_rows({**_SECTIONS, **_RISK_SECTIONS})
ORACLE["run_daily"] = f"""
    {_section_rows(_SECTIONS)}
    UNION ALL SELECT 'alert', {_json('exit_year_quarter rate threshold is_alert')} FROM ({ORACLE['attrition_alert']})
    UNION ALL SELECT 'scores', concat_ws(' ', employee_id, scored_at, 1) FROM ({ORACLE['risk_detail']})
    UNION ALL SELECT 'risk/bands', count(*)::VARCHAR FROM ({ORACLE['risk_detail']})
    UNION ALL SELECT 'tests', concat_ws(' ', count(*), sum(failures)) FROM ({ORACLE['declared_tests']})
"""
_add("explain_trees", "SELECT employee_id, 1 AS adds_up FROM feat_train")
