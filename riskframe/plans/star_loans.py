"""The loan preset's own twelve questions, run on a loan-shaped table that
Spark derives from the whole star schema (orders ⋈ customer ⋈ nation).

The derived table arrives the way the raw loan file does: every column is
text, dates are ``MMM-yyyy``, and some interest rates carry a ``%`` sign.
``presets.loans.prepare_loans`` then casts it and ``QUESTIONS`` answers,
exactly as on a real loan file. Numbers survive the text round trip
exactly, so the SQL oracles use the numeric expressions directly.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..ml import features as feat
from ..operators.joins import checked_broadcast, plan_bytes
from ..presets import loans
from ..session import scratch_path, stage_table, wide_rows
from ..sources.files import write_table
from .star import _r, query, table
from .star_dist import _box_sql, _hist_sql
from .star_misc import UNIFORM_SQL
from .star_misc import _uniform as uniform
from .star_ml import SUITE_SQL, plausible

ORACLE_LOANS: dict[str, str] = {}


def _s(c):
    return c.cast("string")


def loan_text_table(spark, sf_dir, spread=False):
    """The loans as text; with ``spread`` the orders are first dealt to all cores, as few row groups leave most idle."""
    o = table(spark, sf_dir, "orders")
    if spread:
        o = o.repartition(max(3 * spark.sparkContext.defaultParallelism, plan_bytes(o) >> 26), "o_orderkey")
    c = checked_broadcast(table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"))
    n = checked_broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    t = o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    rate = _s(F.lit(5) + key % 20)
    months_back = (cust % 240).cast("int")
    return t.select(
        _s(key).alias("id"),
        _s(F.col("o_totalprice")).alias("loan_amnt"),
        F.when(key % 2 == 0, F.concat(rate, F.lit("%"))).otherwise(rate).alias("int_rate"),
        F.when(F.col("c_mktsegment") == "BUILDING", "OWN").when(F.col("c_mktsegment") == "HOUSEHOLD", "RENT")
         .when(F.col("c_mktsegment") == "MACHINERY", "MORTGAGE").otherwise("OTHER").alias("home_ownership"),
        _s(F.col("c_acctbal") * 20.0).alias("annual_inc"),
        F.date_format("o_orderdate", "MMM-yyyy").alias("issue_d"),
        F.when(F.col("o_orderstatus") == "F", "Fully Paid").when(F.col("o_orderstatus") == "P", "Charged Off")
         .otherwise("Current").alias("loan_status"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "debt_consolidation")
         .when(F.col("o_orderpriority") == "2-HIGH", "credit_card")
         .when(F.col("o_orderpriority") == "3-MEDIUM", "car").otherwise("other").alias("purpose"),
        F.col("n_name").alias("addr_state"),
        _s(F.col("c_acctbal") / 500.0).alias("dti"),
        _s(key % 4).alias("delinq_2yrs"),
        F.date_format(F.add_months(F.to_date("o_orderdate"), -months_back), "MMM-yyyy").alias("earliest_cr_line"),
        _s(F.lit(550) + cust % 300).alias("fico_range_low"),
        _s(cust % 30).alias("open_acc"),
        _s(F.col("o_totalprice") / 10000.0).alias("total_rec_late_fee"),
        F.when(cust % 7 == 0, F.lit(None))
         .otherwise(F.concat(F.col("c_mktsegment"), F.lit("-"), _s(F.col("c_nationkey")))).alias("emp_title"),
        _s(F.col("o_totalprice") * 2.0).alias("tot_hi_cred_lim"),
        F.when(cust % 5 == 0, "Joint App").otherwise("Individual").alias("application_type"),
        F.when(key % 3 == 0, "Verified").when(key % 3 == 1, "Source Verified")
         .otherwise("Not Verified").alias("verification_status"),
        F.when(F.col("o_orderpriority").startswith("1"), "A").when(F.col("o_orderpriority").startswith("2"), "B")
         .when(F.col("o_orderpriority").startswith("3"), "C").otherwise("D").alias("grade"),
        _s(cust % 3).alias("num_accts_ever_120_pd"))


def _answer(name):
    def run(spark, sf_dir):
        df = loans.prepare_loans(loan_text_table(spark, sf_dir))
        # the random rows of q06 by an arithmetic uniform value, so that SQL can follow
        out = loans.q06(df, by=uniform("id")) if name == "q06" else loans.QUESTIONS.answer(name, df)
        return _r(out, money=("total_late_fees",) if name == "q04" else ())
    return run


_TITLES = {
    "q01": "conditional_mean", "q02": "conditional_count", "q03": "conditional_share",
    "q04": "group_profile", "q05": "top_groups", "q06": "diff_from_group_mean",
    "q07": "rate_by_group", "q08": "age_quantile_profile", "q09": "compare_groups",
    "q10": "compare_to_overall", "q11": "quantile_success", "q12": "compare_to_subgroup",
}
for _q, _t in _TITLES.items():
    _fn = _answer(_q)
    _fn.__name__ = f"loan_{_q}_{_t}"
    _fn.__doc__ = f"Loan preset question {_q} on the loan table derived from the star schema."
    query(_fn)


# --------------------------------------------------------------------------
# Oracle SQL. Numeric columns are the numbers the text encodes.
# --------------------------------------------------------------------------

LOAN_SQL = """
WITH L AS (
  SELECT o_orderkey AS id,
         o_totalprice AS loan_amnt,
         CAST(5 + o_orderkey % 20 AS DOUBLE) AS int_rate,
         CASE c_mktsegment WHEN 'BUILDING' THEN 'OWN' WHEN 'HOUSEHOLD' THEN 'RENT'
                           WHEN 'MACHINERY' THEN 'MORTGAGE' ELSE 'OTHER' END AS home_ownership,
         c_acctbal * 20.0 AS annual_inc,
         CASE o_orderstatus WHEN 'F' THEN 'Fully Paid' WHEN 'P' THEN 'Charged Off' ELSE 'Current' END
             AS loan_status,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'debt_consolidation' WHEN '2-HIGH' THEN 'credit_card'
                              WHEN '3-MEDIUM' THEN 'car' ELSE 'other' END AS purpose,
         n_name AS addr_state,
         c_acctbal / 500.0 AS dti,
         CAST(o_orderkey % 4 AS DOUBLE) AS delinq_2yrs,
         CAST(o_custkey % 240 AS DOUBLE) / 12.0 AS credit_history_years,
         CAST(550 + o_custkey % 300 AS DOUBLE) AS fico_range_low,
         CAST(o_custkey % 30 AS DOUBLE) AS open_acc,
         o_totalprice / 10000.0 AS total_rec_late_fee,
         CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE c_mktsegment || '-' || CAST(c_nationkey AS VARCHAR) END
             AS emp_title,
         o_totalprice * 2.0 AS tot_hi_cred_lim,
         CASE WHEN o_custkey % 5 = 0 THEN 'Joint App' ELSE 'Individual' END AS application_type,
         CASE o_orderkey % 3 WHEN 0 THEN 'Verified' WHEN 1 THEN 'Source Verified' ELSE 'Not Verified' END
             AS verification_status,
         CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 'A' WHEN '2' THEN 'B' WHEN '3' THEN 'C' ELSE 'D' END
             AS grade,
         CAST(o_custkey % 3 AS DOUBLE) AS num_accts_ever_120_pd
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
"""


def _pct(cond: str) -> str:
    return f"CAST(count_if({cond}) AS DOUBLE) / count(*) * 100.0"


ORACLE_LOANS["loan_q01_conditional_mean"] = LOAN_SQL + """
SELECT round(avg(loan_amnt), 6) AS avg_loan_amount FROM L
WHERE home_ownership = 'OWN' AND annual_inc > 100000
"""

ORACLE_LOANS["loan_q02_conditional_count"] = LOAN_SQL + """
SELECT count(*) AS count FROM L WHERE num_accts_ever_120_pd > 0 AND purpose = 'debt_consolidation'
"""

ORACLE_LOANS["loan_q03_conditional_share"] = LOAN_SQL + f"""
SELECT round({_pct("delinq_2yrs > 0")}, 6) AS delinquency_rate_pct FROM L WHERE fico_range_low < 650
"""

ORACLE_LOANS["loan_q04_group_profile"] = LOAN_SQL + """
SELECT addr_state, round(avg(dti), 6) AS avg_dti, round(sum(total_rec_late_fee), 2) AS total_late_fees
FROM L GROUP BY addr_state
"""

ORACLE_LOANS["loan_q05_top_groups"] = LOAN_SQL + """
SELECT emp_title, round(avg(tot_hi_cred_lim), 6) AS avg_credit_limit, count(*) AS num_clients
FROM L WHERE emp_title IS NOT NULL GROUP BY emp_title ORDER BY num_clients DESC, emp_title LIMIT 10
"""

ORACLE_LOANS["loan_q07_rate_by_group"] = LOAN_SQL + f"""
SELECT addr_state, count(*) AS total_loans,
       CAST(count_if(loan_status = 'Charged Off') AS BIGINT) AS charged_off_count,
       round({_pct("loan_status = 'Charged Off'")}, 6) AS default_rate_pct
FROM L WHERE loan_status IN ('Fully Paid', 'Charged Off')
GROUP BY addr_state HAVING count(*) >= 10
ORDER BY {_pct("loan_status = 'Charged Off'")} DESC, addr_state LIMIT 10
"""

ORACLE_LOANS["loan_q08_age_quantile_profile"] = LOAN_SQL + """
, q AS (SELECT *, ntile(4) OVER (ORDER BY credit_history_years, id) AS quartile
        FROM L WHERE credit_history_years >= 0)
SELECT CAST(quartile AS INTEGER) AS quartile, round(min(credit_history_years), 6) AS min_years,
       round(max(credit_history_years), 6) AS max_years, round(avg(int_rate), 6) AS avg_interest_rate,
       count(*) AS loan_count
FROM q GROUP BY quartile
"""

ORACLE_LOANS["loan_q09_compare_groups"] = LOAN_SQL + f"""
SELECT application_type, round(avg(loan_amnt), 6) AS avg_loan_amount,
       round(avg(int_rate), 6) AS avg_interest_rate, count(*) AS total_applications,
       CAST(count_if(loan_status = 'Fully Paid') AS BIGINT) AS fully_paid_count,
       round({_pct("loan_status = 'Fully Paid'")}, 6) AS full_payment_rate_pct
FROM L WHERE application_type IN ('Individual', 'Joint App') GROUP BY application_type
"""

ORACLE_LOANS["loan_q10_compare_to_overall"] = LOAN_SQL + """
, g AS (SELECT purpose, count(*) AS total_loans, CAST(count_if(delinq_2yrs > 0) AS BIGINT) AS delinquent_loans,
               avg(delinq_2yrs) AS avg_delinquencies FROM L WHERE purpose IS NOT NULL GROUP BY purpose),
o AS (SELECT avg(delinq_2yrs) AS overall FROM L WHERE purpose IS NOT NULL)
SELECT purpose, total_loans, delinquent_loans,
       round(CAST(delinquent_loans AS DOUBLE) / total_loans * 100.0, 6) AS delinquency_rate_pct,
       round(avg_delinquencies, 6) AS avg_delinquencies, round(avg_delinquencies / overall, 6) AS vs_overall_ratio
FROM g, o ORDER BY CAST(delinquent_loans AS DOUBLE) / total_loans DESC, purpose LIMIT 5
"""

ORACLE_LOANS["loan_q11_quantile_success"] = LOAN_SQL + f"""
, q AS (SELECT *, ntile(4) OVER (ORDER BY open_acc, id) AS accounts_quartile
        FROM L WHERE open_acc IS NOT NULL AND loan_status IN ('Fully Paid', 'Charged Off'))
SELECT CAST(accounts_quartile AS INTEGER) AS accounts_quartile, round(min(open_acc), 6) AS min_accounts,
       round(max(open_acc), 6) AS max_accounts, round(avg(open_acc), 6) AS avg_accounts,
       count(*) AS total_loans, CAST(count_if(loan_status = 'Fully Paid') AS BIGINT) AS fully_paid_count,
       round({_pct("loan_status = 'Fully Paid'")}, 6) AS success_rate_pct
FROM q GROUP BY accounts_quartile
"""

ORACLE_LOANS["loan_q12_compare_to_subgroup"] = LOAN_SQL + """
, f AS (SELECT verification_status, grade, count(*) AS loan_count, avg(loan_amnt) AS avg_loan_amount,
               avg(int_rate) AS avg_interest_rate, count_if(loan_status = 'Charged Off') AS hits
        FROM L WHERE verification_status IS NOT NULL AND grade IS NOT NULL GROUP BY verification_status, grade),
c AS (SELECT grade AS g, avg(int_rate) AS grade_avg FROM L
      WHERE verification_status IS NOT NULL AND grade IS NOT NULL GROUP BY grade)
SELECT verification_status, grade, loan_count, round(avg_loan_amount, 6) AS avg_loan_amount,
       round(avg_interest_rate, 6) AS avg_interest_rate,
       round(CAST(hits AS DOUBLE) / loan_count * 100.0, 6) AS default_rate_pct,
       round(avg_interest_rate - grade_avg, 6) AS rate_vs_avg
FROM f JOIN c ON f.grade = c.g
"""


ORACLE_LOANS["loan_q06_diff_from_group_mean"] = LOAN_SQL + f"""
SELECT CAST(id AS VARCHAR) AS id, addr_state, round(annual_inc, 6) AS annual_inc,
       round(avg_state_income, 6) AS avg_state_income, round(annual_inc - avg_state_income, 6) AS income_difference
FROM (SELECT *, avg(annual_inc) OVER (PARTITION BY addr_state) AS avg_state_income FROM L)
ORDER BY {UNIFORM_SQL.replace("o_orderkey", "id")}, CAST(id AS VARCHAR) LIMIT 10
"""


# --------------------------------------------------------------------------
# The preset's jobs on the same data, with every column its cleaning and ML
# specs name, and missing values, placeholders, sparse columns and bad terms
# planted by fixed rules of the key, so that each of the eleven steps acts.
# --------------------------------------------------------------------------

def loan_full_table(spark, sf_dir):
    t = loan_text_table(spark, sf_dir, spread=True)
    key, null = F.col("id").cast("long"), F.lit(None).cast("string")
    price = F.col("loan_amnt").cast("double")

    def some(n, column):
        return F.when(key % n == 0, null).otherwise(column)

    return t.select(
        "*", F.col("id").alias("member_id"), F.concat("grade", F.lit("1")).alias("sub_grade"),
        F.lit("10+ years").alias("emp_length"), some(13, F.col("loan_amnt")).alias("funded_amnt"),
        F.col("loan_amnt").alias("funded_amnt_inv"),
        some(19, _s(F.col("fico_range_low").cast("int") + 4)).alias("fico_range_high"),
        F.when(key % 4 == 0, " 60 months").when(key % 4 == 1, null).when(key % 4 == 2, " 36 months")
         .otherwise("bad").alias("term"),
        F.when(key % 5 == 0, "...").when(key % 5 == 1, null).otherwise(F.col("purpose")).alias("title"),
        F.when(key % 6 == 0, "Y").when(key % 6 == 1, null).otherwise("N").alias("hardship_flag"),
        F.when(key % 8 == 0, "Y").otherwise("N").alias("debt_settlement_flag"),
        F.when(key % 10 == 0, "some text").alias("desc"),
        _s(price / 36.0).alias("installment"), F.concat(_s(key % 100), F.lit(".5%")).alias("revol_util"),
        F.when(key % 7 == 0, "NaN").otherwise(_s((key % 1000) * F.lit(1.5))).alias("bc_open_to_buy"),
        _s((key % 2000) * F.lit(2.5)).alias("total_bc_limit"), _s(key % 5).alias("mort_acc"),
        _s(key % 3).alias("pub_rec"), _s(key % 2).alias("pub_rec_bankruptcies"), _s(key % 9000).alias("revol_bal"),
        _s(key % 60).alias("total_acc"), _s(key % 4).alias("inq_last_6mths"), F.lit("n").alias("pymnt_plan"),
        F.lit("http://x").alias("url"), F.lit("123xx").alias("zip_code"), F.lit("w").alias("initial_list_status"),
        F.lit("Jan-2016").alias("last_pymnt_d"), F.lit("Jan-2016").alias("last_credit_pull_d"),
        F.lit("Cash").alias("disbursement_method")).withColumns({
            "annual_inc": some(11, F.col("annual_inc")), "loan_amnt": some(17, F.col("loan_amnt")),
            "home_ownership": some(9, F.col("home_ownership")),
            "purpose": F.when(key % 23 == 0, null).when(key % 29 == 0, "...").otherwise(F.col("purpose"))})


def _csv(spark, table_, name):
    path = scratch_path(spark, name)
    write_table(table_, path, fmt="csv")
    return path


def _cleaned(spark, sf_dir):
    out = scratch_path(spark, "loan_clean")
    loans.cleaning_job(spark, _csv(spark, loan_full_table(spark, sf_dir), "loan_csv"), out)
    return spark.read.parquet(out)


def _rounded(rows):
    """``_r`` of a wide table, staged: a lazy result would be computed outside ``wide_rows``."""
    with wide_rows(rows.sparkSession):
        return stage_table(_r(rows), "loan_rounded")


@query
def loan_cleaning_job(spark, sf_dir):
    """Text loan table -> CSV -> ingest with inferred types -> the 11-step cleaning chain -> Parquet."""
    return _rounded(_cleaned(spark, sf_dir))


@query
def loan_ml_features(spark, sf_dir):
    """The cleaned loans' features and labels before any fit."""
    rows = loans.ml_table(_cleaned(spark, sf_dir))
    numeric, ind = feat.feature_columns(rows, loans.LOAN_ML)
    return _rounded(rows.select(*numeric, *ind, feat.LABEL_CLASS, feat.LABEL_REG))


@query
def loan_ml_job(spark, sf_dir):
    """Cleaned loan table -> features, labels, 70/15/15 split -> all six models -> metrics of every split."""
    metrics, _, _ = loans.ml_job(spark, _cleaned(spark, sf_dir))
    return plausible(metrics)


@query
def loan_questions_from_csv(spark, sf_dir):
    """The first three questions answered by the job from raw CSV, ingested once."""
    answers = loans.questions_job(spark, _csv(spark, loan_text_table(spark, sf_dir), "loan_csv"), ["q01", "q02", "q03"])
    parts = [a.select(F.lit(n).alias("question"), F.col(a.columns[0]).cast("double").alias("value"))
             for n, a in sorted(answers.items())]
    return _r(parts[0].unionByName(parts[1]).unionByName(parts[2]))


@query
def loan_questions_all(spark, sf_dir):
    """All twelve answers from raw CSV: ingested once by many tasks, nine of them and q06's state means from one scan."""
    path = scratch_path(spark, "loan_csv")
    write_table(loan_text_table(spark, sf_dir), path, fmt="csv")
    answers = loans.questions_job(spark, path, by=uniform("id"))
    return _r(loans.long_answers({n: _r(a, money=("total_late_fees",) if n == "q04" else ()) for n, a in answers.items()}))


@query
def loan_summary_boxes(spark, sf_dir):
    """Box figures of amount, rate and instalment."""
    return _r(loans.loan_summaries(_priced(spark, sf_dir))["boxes"])


@query
def loan_summary_histograms(spark, sf_dir):
    """Histograms of amount, rate and instalment."""
    return _r(loans.loan_summaries(_priced(spark, sf_dir))["histograms"])


def _priced(spark, sf_dir):
    df = loans.prepare_loans(loan_text_table(spark, sf_dir))
    return df.select("loan_amnt", "int_rate", (F.col("loan_amnt") / 36.0).alias("installment"))


_PRICED_SQL = LOAN_SQL + ", S AS (SELECT loan_amnt, int_rate, loan_amnt / 36.0 AS installment FROM L) "
ORACLE_LOANS["loan_summary_boxes"] = _PRICED_SQL + " UNION ALL ".join(_box_sql(c, "S") for c in loans.SUMMARY_COLUMNS)
ORACLE_LOANS["loan_summary_histograms"] = _PRICED_SQL + " UNION ALL ".join(
    _hist_sql(c, 30, "S") for c in loans.SUMMARY_COLUMNS)

ORACLE_LOANS["loan_questions_from_csv"] = LOAN_SQL + f"""
SELECT 'q01' AS question, round(avg(loan_amnt), 6) AS value FROM L WHERE home_ownership = 'OWN' AND annual_inc > 100000
UNION ALL SELECT 'q02', CAST(count(*) AS DOUBLE) FROM L WHERE num_accts_ever_120_pd > 0 AND purpose = 'debt_consolidation'
UNION ALL SELECT 'q03', round({_pct("delinq_2yrs > 0")}, 6) FROM L WHERE fico_range_low < 650
"""

def _long_sql() -> str:
    """The answers' oracles, one row per figure."""
    parts = []
    for n, title in _TITLES.items():
        sql = ORACLE_LOANS[f"loan_{n}_{title}"]
        keys = " || '|' || ".join(f"CAST({k} AS VARCHAR)" for k in loans.ANSWER_KEYS.get(n, [])) or "''"
        for c in _FIGURES[n]:
            parts.append(f"SELECT '{n}' AS question, {keys} AS row_key, '{c}' AS \"column\", CAST({c} AS DOUBLE) AS value FROM ({sql})")
    return " UNION ALL ".join(parts)


_FIGURES = {
    "q01": ["avg_loan_amount"], "q02": ["count"], "q03": ["delinquency_rate_pct"], "q04": ["avg_dti", "total_late_fees"],
    "q05": ["avg_credit_limit", "num_clients"], "q06": ["annual_inc", "avg_state_income", "income_difference"],
    "q07": ["total_loans", "charged_off_count", "default_rate_pct"],
    "q08": ["min_years", "max_years", "avg_interest_rate", "loan_count"],
    "q09": ["avg_loan_amount", "avg_interest_rate", "total_applications", "fully_paid_count", "full_payment_rate_pct"],
    "q10": ["total_loans", "delinquent_loans", "delinquency_rate_pct", "avg_delinquencies", "vs_overall_ratio"],
    "q11": ["min_accounts", "max_accounts", "avg_accounts", "total_loans", "fully_paid_count", "success_rate_pct"],
    "q12": ["loan_count", "avg_loan_amount", "avg_interest_rate", "default_rate_pct", "rate_vs_avg"],
}
ORACLE_LOANS["loan_questions_all"] = _long_sql()

# Means of the named columns are over all rows, those of the floating columns over the kept ones.
_CLEAN_SQL = LOAN_SQL + """
, P AS (SELECT L.*, CASE WHEN id % 17 = 0 THEN NULL ELSE loan_amnt END AS amount,
               CASE WHEN id % 11 = 0 THEN NULL ELSE annual_inc END AS income,
               CASE WHEN id % 7 = 0 THEN NULL ELSE (id % 1000) * 1.5 END AS open_to_buy,
               CASE WHEN id % 9 = 0 THEN 'ANY' ELSE home_ownership END AS home,
               CASE WHEN id % 23 = 0 THEN 'any' WHEN id % 29 = 0 THEN '...' ELSE purpose END AS why,
               CASE WHEN id % 5 < 2 THEN 'any' ELSE purpose END AS heading
        FROM L),
K AS (SELECT *, round(coalesce(amount, (SELECT avg(amount) FROM P)), 6) AS filled_amount,
             round(coalesce(income, avg(income) OVER ()), 6) AS filled_income,
             round(coalesce(open_to_buy, avg(open_to_buy) OVER ()), 6) AS filled_open
      FROM P WHERE id % 19 <> 0)
"""

_HOMES = "".join(f", CAST(home = '{h}' AS INTEGER) AS home_ownership_{h}" for h in ("ANY", "MORTGAGE", "OTHER", "OWN", "RENT"))

ORACLE_LOANS["loan_cleaning_job"] = _CLEAN_SQL + f"""
SELECT filled_amount AS loan_amnt, int_rate, filled_income AS annual_inc, loan_status, why AS purpose,
       round(dti, 6) AS dti, CAST(delinq_2yrs AS INTEGER) AS delinq_2yrs, CAST(fico_range_low AS INTEGER) AS fico_range_low,
       CAST(open_acc AS INTEGER) AS open_acc, round(total_rec_late_fee, 6) AS total_rec_late_fee,
       round(tot_hi_cred_lim, 6) AS tot_hi_cred_lim, CAST(num_accts_ever_120_pd AS INTEGER) AS num_accts_ever_120_pd,
       CAST(fico_range_low + 4 AS INTEGER) AS fico_range_high, CASE WHEN id % 4 = 0 THEN 60 ELSE 36 END AS term,
       heading AS title, CAST(id % 6 = 0 AS INTEGER) AS hardship_flag, CAST(id % 8 = 0 AS INTEGER) AS debt_settlement_flag,
       round(loan_amnt / 36.0, 6) AS installment, CAST(id % 100 + 0.5 AS DOUBLE) AS revol_util,
       filled_open AS bc_open_to_buy, CAST((id % 2000) * 2.5 AS DOUBLE) AS total_bc_limit,
       CAST(id % 5 AS INTEGER) AS mort_acc, CAST(id % 3 AS INTEGER) AS pub_rec,
       CAST(id % 2 AS INTEGER) AS pub_rec_bankruptcies, CAST(id % 9000 AS INTEGER) AS revol_bal,
       CAST(id % 60 AS INTEGER) AS total_acc, CAST(id % 4 AS INTEGER) AS inq_last_6mths{_HOMES}
FROM K
"""

ORACLE_LOANS["loan_ml_features"] = _CLEAN_SQL + f"""
SELECT int_rate, filled_amount AS loan_amnt, CAST(CASE WHEN id % 4 = 0 THEN 60 ELSE 36 END AS DOUBLE) AS term,
       round(loan_amnt / 36.0, 6) AS installment, filled_income AS annual_inc, round(dti, 6) AS dti,
       CAST(id % 100 + 0.5 AS DOUBLE) AS revol_util, filled_open AS bc_open_to_buy,
       CAST((id % 2000) * 2.5 AS DOUBLE) AS total_bc_limit, CAST(id % 5 AS DOUBLE) AS mort_acc,
       CAST(id % 3 AS DOUBLE) AS pub_rec, CAST(id % 2 AS DOUBLE) AS pub_rec_bankruptcies, delinq_2yrs, open_acc,
       CAST(id % 9000 AS DOUBLE) AS revol_bal, CAST(id % 60 AS DOUBLE) AS total_acc,
       CAST(id % 4 AS DOUBLE) AS inq_last_6mths, CAST(id % 6 = 0 AS DOUBLE) AS hardship_flag,
       CAST(id % 8 = 0 AS DOUBLE) AS debt_settlement_flag{_HOMES.replace("INTEGER", "DOUBLE")},
       CASE WHEN loan_status = 'Fully Paid' THEN 0.0 ELSE 1.0 END AS label_class, fico_range_low AS label_reg
FROM K WHERE loan_status IN ('Fully Paid', 'Charged Off', 'Default')
"""

ORACLE_LOANS["loan_ml_job"] = SUITE_SQL
