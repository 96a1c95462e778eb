"""Preset for a consumer-loan table: schema, casts, the cleaning chain, the
twelve questions and the ML feature spec, bound to the generic operators.

Typical use::

    raw = read_loans(spark, "loans/*.csv")              # strings, robust CSV
    loans = prepare_loans(raw)                           # TRY_CAST of the measures
    loans = ingest(spark, "loans/*.csv")                 # or both, once, as Parquet
    answers = QUESTIONS.run(loans)                       # 12 DataFrames
    cleaned, facts = clean_loans(read_typed(spark, p, infer=True))   # typed input
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import safe_cast, sanitize_names
from ..functions.exprs import age_years, parse_month, percent, try_number, unit_hash
from ..ml import features as feat
from ..ml import suite
from ..ml.features import FeatureSpec
from ..operators import compare, measures, ntile, sampling, shared, windows
from ..operators.distribution import box_summary, describe_table, histogram, histogram_first, numeric_columns
from ..operators.sampling import split_rows
from ..plans.cleaning import CleaningSpec, clean_table
from ..plans.questions import QuestionRegistry
from ..session import scratch_path, stage_table, wide_rows
from ..sources.files import apply_header, infer_types, ingest_raw, read_raw, string_schema, write_table
from ..sources.models import save_model

# ---------------------------------------------------------------------------
# The 151 column names of the raw loan file, in file order.
# ---------------------------------------------------------------------------
LOAN_COLUMNS: list[str] = [
    "id", "member_id", "loan_amnt", "funded_amnt", "funded_amnt_inv", "term", "int_rate",
    "installment", "grade", "sub_grade", "emp_title", "emp_length", "home_ownership",
    "annual_inc", "verification_status", "issue_d", "loan_status", "pymnt_plan", "url", "desc",
    "purpose", "title", "zip_code", "addr_state", "dti", "delinq_2yrs", "earliest_cr_line",
    "fico_range_low", "fico_range_high", "inq_last_6mths", "mths_since_last_delinq",
    "mths_since_last_record", "open_acc", "pub_rec", "revol_bal", "revol_util", "total_acc",
    "initial_list_status", "out_prncp", "out_prncp_inv", "total_pymnt", "total_pymnt_inv",
    "total_rec_prncp", "total_rec_int", "total_rec_late_fee", "recoveries",
    "collection_recovery_fee", "last_pymnt_d", "last_pymnt_amnt", "next_pymnt_d",
    "last_credit_pull_d", "last_fico_range_high", "last_fico_range_low",
    "collections_12_mths_ex_med", "mths_since_last_major_derog", "policy_code",
    "application_type", "annual_inc_joint", "dti_joint", "verification_status_joint",
    "acc_now_delinq", "tot_coll_amt", "tot_cur_bal", "open_acc_6m", "open_act_il", "open_il_12m",
    "open_il_24m", "mths_since_rcnt_il", "total_bal_il", "il_util", "open_rv_12m", "open_rv_24m",
    "max_bal_bc", "all_util", "total_rev_hi_lim", "inq_fi", "total_cu_tl", "inq_last_12m",
    "acc_open_past_24mths", "avg_cur_bal", "bc_open_to_buy", "bc_util",
    "chargeoff_within_12_mths", "delinq_amnt", "mo_sin_old_il_acct", "mo_sin_old_rev_tl_op",
    "mo_sin_rcnt_rev_tl_op", "mo_sin_rcnt_tl", "mort_acc", "mths_since_recent_bc",
    "mths_since_recent_bc_dlq", "mths_since_recent_inq", "mths_since_recent_revol_delinq",
    "num_accts_ever_120_pd", "num_actv_bc_tl", "num_actv_rev_tl", "num_bc_sats", "num_bc_tl",
    "num_il_tl", "num_op_rev_tl", "num_rev_accts", "num_rev_tl_bal_gt_0", "num_sats",
    "num_tl_120dpd_2m", "num_tl_30dpd", "num_tl_90g_dpd_24m", "num_tl_op_past_12m",
    "pct_tl_nvr_dlq", "percent_bc_gt_75", "pub_rec_bankruptcies", "tax_liens", "tot_hi_cred_lim",
    "total_bal_ex_mort", "total_bc_limit", "total_il_high_credit_limit", "revol_bal_joint",
    "sec_app_fico_range_low", "sec_app_fico_range_high", "sec_app_earliest_cr_line",
    "sec_app_inq_last_6mths", "sec_app_mort_acc", "sec_app_open_acc", "sec_app_revol_util",
    "sec_app_open_act_il", "sec_app_num_rev_accts", "sec_app_chargeoff_within_12_mths",
    "sec_app_collections_12_mths_ex_med", "sec_app_mths_since_last_major_derog", "hardship_flag",
    "hardship_type", "hardship_reason", "hardship_status", "deferral_term", "hardship_amount",
    "hardship_start_date", "hardship_end_date", "payment_plan_start_date", "hardship_length",
    "hardship_dpd", "hardship_loan_status", "orig_projected_additional_accrued_interest",
    "hardship_payoff_balance_amount", "hardship_last_payment_amount", "disbursement_method",
    "debt_settlement_flag", "debt_settlement_flag_date", "settlement_status", "settlement_date",
    "settlement_amount", "settlement_percentage", "settlement_term",
]

# Measures cast to DOUBLE before the questions run.
QUESTION_CASTS: dict[str, str] = {
    "loan_amnt": "double", "annual_inc": "double", "num_accts_ever_120_pd": "double",
    "delinq_2yrs": "double", "fico_range_low": "double", "dti": "double",
    "total_rec_late_fee": "double", "tot_hi_cred_lim": "double", "int_rate": "double",
    "open_acc": "double",
}

# Columns of the summary-statistics table.
STATS_COLUMNS: list[str] = [
    "loan_amnt", "funded_amnt", "funded_amnt_inv", "annual_inc", "dti", "delinq_2yrs",
    "fico_range_low", "fico_range_high", "open_acc", "revol_bal", "total_acc",
]

# Status and category values the questions test for.
FINISHED = ("Fully Paid", "Charged Off")
FINISHED_ML = ("Fully Paid", "Charged Off", "Default")
PAID, CHARGED_OFF = "Fully Paid", "Charged Off"
APPLICATION_TYPES = ("Individual", "Joint App")
DATE_FORMAT = "MMM-yyyy"

# The cleaning chain's column lists.
LOAN_CLEANING = CleaningSpec(
    initial_drop=["id", "member_id", "grade", "sub_grade", "emp_title", "emp_length"],
    mean_fill=["loan_amnt", "funded_amnt", "funded_amnt_inv"],
    required=["fico_range_low", "fico_range_high"],
    term_column="term",
    one_hot_column="home_ownership",
    object_drop=["verification_status", "issue_d", "pymnt_plan", "url", "zip_code", "addr_state",
                 "earliest_cr_line", "initial_list_status", "last_pymnt_d", "last_credit_pull_d",
                 "application_type", "disbursement_method"],
    text_columns=["purpose", "title"],
    text_placeholders={"title": ("...",)},
    percent_columns=["int_rate", "revol_util"],
    flag_columns=["hardship_flag", "debt_settlement_flag"],
    redundant_drop=["funded_amnt", "funded_amnt_inv"],
)

# The ML features (hardship_flag and debt_settlement_flag are
# known only after trouble starts; they are kept to match, and marked here).
ML_NUMERIC = ["int_rate", "loan_amnt", "term", "installment", "annual_inc", "dti", "revol_util",
              "bc_open_to_buy", "total_bc_limit", "mort_acc", "pub_rec", "pub_rec_bankruptcies",
              "delinq_2yrs", "open_acc", "revol_bal", "total_acc", "inq_last_6mths",
              "hardship_flag", "debt_settlement_flag"]
POST_OUTCOME_FEATURES = ("hardship_flag", "debt_settlement_flag")
LOAN_ML = FeatureSpec(numeric=ML_NUMERIC, indicator_pattern="^home_ownership_",
                      status_column="loan_status", keep_status=FINISHED_ML,
                      negative_status=PAID, reg_target="fico_range_low")

RAW_SCHEMA: T.StructType = string_schema(LOAN_COLUMNS)


def read_loans(spark: SparkSession, paths, fmt: str = "csv", relabel: bool = False) -> DataFrame:
    """Read the raw loan file(s) as strings. ``relabel`` names columns by
    position with the 151 canonical names (for headerless or renamed files)."""
    if relabel:
        return apply_header(read_raw(spark, paths, fmt), LOAN_COLUMNS)
    return read_raw(spark, paths, fmt)


def prepare_loans(raw: DataFrame, strip_percent: bool = True) -> DataFrame:
    """TRY_CAST the question measures to DOUBLE in one projection ("13.99%"
    becomes 13.99 when ``strip_percent``; the text "NaN" becomes NULL)."""
    return safe_cast(raw, QUESTION_CASTS, strip_chars="%" if strip_percent else None,
                     nan_as_null=True)


def numeric_stats(df: DataFrame) -> DataFrame:
    """count/mean/stddev/min/max of the eleven statistics columns (text as read or numbers)."""
    return describe_table(df, STATS_COLUMNS)


# The columns and the column count of the summaries that stand for the charts.
SUMMARY_COLUMNS = ["loan_amnt", "int_rate", "installment"]
SUMMARY_FIRST = 18


def loan_summaries(df: DataFrame) -> dict[str, DataFrame]:
    """Histograms and box figures of the loan amount, rate and instalment, histograms of the
    numeric columns among the first 18, and box figures of the first numeric column."""
    present = [c for c in SUMMARY_COLUMNS if c in df.columns]
    numeric = numeric_columns(df)
    return {"histograms": histogram(df, present), "boxes": box_summary(df, present),
            "histograms_first": histogram_first(df, SUMMARY_FIRST), "box_first": box_summary(df, numeric[:1])}


def clean_loans(df: DataFrame):
    """The eleven cleaning steps; returns (cleaned table, fitted facts)."""
    return clean_table(df, LOAN_CLEANING)


def _with_row_keys(rows: DataFrame, name: str) -> tuple[DataFrame, list[str]]:
    """``rows`` (with the text column ``id``) staged once, with its tie-break keys.

    Ids order as numbers where they are numbers (others first, as NULL), then by hash; rows whose id is NULL
    or repeated are told apart by a row number that is fixed when the table is staged.
    """
    keyed = rows.withColumns({"_id": try_number("id", "long"), "_hash": F.coalesce(F.xxhash64("id"), F.lit(0)),
                              "_row": F.monotonically_increasing_id()}).drop("id")
    # the exact n-tile scans its input several times
    return stage_table(keyed, name), ["_id", "_hash", "_row"]


QUESTIONS = QuestionRegistry()


@QUESTIONS.register("q01", "Mean loan amount of home owners with income above 100,000")
def q01(df: DataFrame) -> DataFrame:
    pred = (F.col("home_ownership") == "OWN") & (F.col("annual_inc") > 100000)
    return measures.conditional_mean(df, pred, "loan_amnt", alias="avg_loan_amount")


@QUESTIONS.register("q02", "Clients ever 120+ days past due who borrowed to consolidate debt")
def q02(df: DataFrame) -> DataFrame:
    pred = (F.col("num_accts_ever_120_pd") > 0) & (F.col("purpose") == "debt_consolidation")
    return measures.conditional_count(df, pred, alias="count")


@QUESTIONS.register("q03", "Percent with delinquencies in 2 years among FICO below 650")
def q03(df: DataFrame) -> DataFrame:
    return measures.conditional_share(df, F.col("fico_range_low") < 650,
                                      F.col("delinq_2yrs") > 0, alias="delinquency_rate_pct")


@QUESTIONS.register("q04", "Mean DTI and total late fees per state")
def q04(df: DataFrame) -> DataFrame:
    return measures.group_profile(df, ["addr_state"],
                                  {"avg_dti": F.avg("dti"),
                                   "total_late_fees": F.sum("total_rec_late_fee")},
                                  order_by=[F.col("total_late_fees").desc()])


@QUESTIONS.register("q05", "Top 10 job titles by clients, with mean credit limit")
def q05(df: DataFrame) -> DataFrame:
    return measures.top_groups(df, "emp_title", {"avg_credit_limit": F.avg("tot_hi_cred_lim"),
                                                 "num_clients": F.count(F.lit(1))},
                               by="num_clients", k=10)


@QUESTIONS.register("q06", "Income minus state mean income (10 random clients)")
def q06(df: DataFrame, k: int = 10, seed: int = 42, by: Column | None = None) -> DataFrame:
    rows = windows.diff_from_group_mean(
        df, "addr_state", "annual_inc", mean_alias="avg_state_income",
        diff_alias="income_difference", columns=["id", "addr_state", "annual_inc"])
    return sampling.random_k(rows, k, keys=["id"], seed=seed, by=by)


@QUESTIONS.register("q07", "Top 10 states by charged-off share of finished loans (10+ loans)")
def q07(df: DataFrame) -> DataFrame:
    return measures.rate_by_group(df, "addr_state", F.col("loan_status").isin(list(FINISHED)),
                                  F.col("loan_status") == CHARGED_OFF, min_n=10, k=10,
                                  total_alias="total_loans", hit_alias="charged_off_count",
                                  rate_alias="default_rate_pct")


@QUESTIONS.register("q08", "Interest rate by quartile of credit-history age")
def q08(df: DataFrame) -> DataFrame:
    age = age_years(parse_month("issue_d", DATE_FORMAT), parse_month("earliest_cr_line", DATE_FORMAT))
    rows = (df.filter(F.col("earliest_cr_line").isNotNull() & F.col("issue_d").isNotNull()
                      & F.col("int_rate").isNotNull())
            .select("id", age.alias("credit_history_years"), "int_rate")
            .filter(F.col("credit_history_years") >= 0))
    rows, ties = _with_row_keys(rows, "q08_rows")
    return ntile.quantile_profile(
        rows, "credit_history_years", 4, ties,
        {"min_years": F.min("credit_history_years"), "max_years": F.max("credit_history_years"),
         "avg_interest_rate": F.avg("int_rate"), "loan_count": F.count(F.lit(1))},
        tile_alias="quartile")


@QUESTIONS.register("q09", "Individual vs joint applications")
def q09(df: DataFrame) -> DataFrame:
    return measures.compare_groups(df, "application_type", list(APPLICATION_TYPES),
                                   {"avg_loan_amount": F.avg("loan_amnt"),
                                    "avg_interest_rate": F.avg("int_rate")},
                                   hit=F.col("loan_status") == PAID,
                                   total_alias="total_applications", hit_alias="fully_paid_count",
                                   rate_alias="full_payment_rate_pct")


@QUESTIONS.register("q10", "Top 5 purposes by delinquency rate, against the overall mean")
def q10(df: DataFrame) -> DataFrame:
    return compare.compare_to_overall(df, "purpose", "delinq_2yrs", F.col("delinq_2yrs") > 0, k=5,
                                      total_alias="total_loans", hit_alias="delinquent_loans",
                                      rate_alias="delinquency_rate_pct",
                                      avg_alias="avg_delinquencies", ratio_alias="vs_overall_ratio")


@QUESTIONS.register("q11", "Repayment success by quartile of open accounts")
def q11(df: DataFrame) -> DataFrame:
    rows = (df.filter(F.col("open_acc").isNotNull() & F.col("loan_status").isin(list(FINISHED)))
            .select("id", "open_acc", "loan_status"))
    rows, ties = _with_row_keys(rows, "q11_rows")
    out = ntile.quantile_profile(
        rows, "open_acc", 4, ties,
        {"min_accounts": F.min("open_acc"), "max_accounts": F.max("open_acc"),
         "avg_accounts": F.avg("open_acc"), "total_loans": F.count(F.lit(1)),
         "fully_paid_count": F.count_if(F.col("loan_status") == PAID)},
        tile_alias="accounts_quartile")
    return out.withColumn("success_rate_pct",
                          F.try_divide(F.col("fully_paid_count").cast("double"),
                                       F.col("total_loans")) * 100.0)


@QUESTIONS.register("q12", "Verification status x grade against the grade's mean rate")
def q12(df: DataFrame) -> DataFrame:
    return compare.compare_to_subgroup(
        df, ["verification_status", "grade"], ["grade"], "int_rate",
        hit=F.col("loan_status") == CHARGED_OFF, aggs={"avg_loan_amount": F.avg("loan_amnt")},
        count_alias="loan_count", measure_alias="avg_interest_rate", rate_alias="default_rate_pct",
        diff_alias="rate_vs_avg")


# ---------------------------------------------------------------------------
# The same answers from one scan
# ---------------------------------------------------------------------------

def _shared_requests() -> dict[str, shared.Request]:
    """What the questions need per group; q06 needs its state means only."""
    charged_off, paid = F.col("loan_status") == CHARGED_OFF, F.col("loan_status") == PAID
    late = F.col("delinq_2yrs") > 0
    mean, total, rows, R = shared.mean_of, shared.sum_of, shared.rows_where, shared.Request
    return {
        "q01": R([], {"avg_loan_amount": mean("loan_amnt")}, (F.col("home_ownership") == "OWN") & (F.col("annual_inc") > 100000)),
        "q02": R([], {"count": rows()}, (F.col("num_accts_ever_120_pd") > 0) & (F.col("purpose") == "debt_consolidation")),
        "q03": R([], {"_n": rows(), "_hit": rows(late)}, F.col("fico_range_low") < 650),
        "q04": R(["addr_state"], {"avg_dti": mean("dti"), "total_late_fees": total("total_rec_late_fee")}),
        "q05": R(["emp_title"], {"avg_credit_limit": mean("tot_hi_cred_lim"), "num_clients": rows()}, drop_null_keys=True),
        "q06": R(["addr_state"], {"avg_state_income": mean("annual_inc")}),
        "q07": R(["addr_state"], {"total_loans": rows(), "charged_off_count": rows(charged_off)}, F.col("loan_status").isin(list(FINISHED))),
        "q09": R(["application_type"], {"avg_loan_amount": mean("loan_amnt"), "avg_interest_rate": mean("int_rate"),
                                        "total_applications": rows(), "fully_paid_count": rows(paid)},
                 F.col("application_type").isin(list(APPLICATION_TYPES))),
        "q10": R(["purpose"], {"total_loans": rows(), "delinquent_loans": rows(late), "avg_delinquencies": mean("delinq_2yrs"),
                               "_sum": total("delinq_2yrs"), "_cnt": rows(F.col("delinq_2yrs").isNotNull())}, drop_null_keys=True),
        "q12": R(["verification_status", "grade"], {"loan_count": rows(), "avg_loan_amount": mean("loan_amnt"),
                                                    "avg_interest_rate": mean("int_rate"), "_hit": rows(charged_off),
                                                    "_sum": total("int_rate"), "_cnt": rows(F.col("int_rate").isNotNull())},
                 F.col("verification_status").isNotNull() & F.col("grade").isNotNull()),
    }


def shared_answers(df: DataFrame, names=None, k: int = 10, seed: int = 42, by: Column | None = None) -> dict[str, DataFrame]:
    """The answers of ``QUESTIONS.run``, where all that aggregate by fixed keys come from one scan of ``df``.

    Only q08 and q11 (quartiles) and the choice of q06's rows, which join the state means afterwards, scan again.
    ``k``, ``seed`` and ``by`` are those of q06.
    """
    names = list(names or QUESTIONS.names())
    requests = {n: r for n, r in _shared_requests().items() if n in names}
    got = shared.shared_groups(df, requests) if requests else {}

    def finished(n: str) -> DataFrame:
        if n not in got:
            return QUESTIONS.answer(n, df)
        g = got[n]
        if n == "q03":
            return g.select(percent("_hit", "_n").alias("delinquency_rate_pct"))
        if n == "q04":
            return g.orderBy(F.col("total_late_fees").desc())
        if n == "q05":
            return g.orderBy(F.col("num_clients").desc(), "emp_title").limit(10)
        if n == "q06":
            chosen = sampling.random_k(df.select("id", "addr_state", "annual_inc"), k, keys=["id"], seed=seed, by=by)
            means = g.withColumnRenamed("addr_state", "_state")
            return chosen.join(means, F.col("addr_state").eqNullSafe(F.col("_state"))).drop("_state").withColumn(
                "income_difference", F.col("annual_inc") - F.col("avg_state_income"))
        if n == "q07":
            rated = g.withColumn("default_rate_pct", percent("charged_off_count", "total_loans")).where(F.col("total_loans") >= 10)
            return rated.orderBy(F.col("default_rate_pct").desc(), F.col("addr_state").asc_nulls_first()).limit(10)
        if n == "q09":
            return g.withColumn("full_payment_rate_pct", percent("fully_paid_count", "total_applications")).orderBy("application_type")
        if n == "q10":
            return compare.overall_from_groups(g, "purpose", 5, "total_loans", "delinquent_loans", "delinquency_rate_pct",
                                               "avg_delinquencies", "vs_overall_ratio")
        if n == "q12":
            return compare.subgroup_from_groups(g, ["verification_status", "grade"], ["grade"], ["avg_loan_amount"], "loan_count",
                                                "avg_interest_rate", "default_rate_pct", "rate_vs_avg")
        return g

    return {n: finished(n) for n in names}


# The columns that tell an answer's rows apart.
ANSWER_KEYS = {"q04": ["addr_state"], "q05": ["emp_title"], "q06": ["id", "addr_state"], "q07": ["addr_state"], "q08": ["quartile"],
               "q09": ["application_type"], "q10": ["purpose"], "q11": ["accounts_quartile"], "q12": ["verification_status", "grade"]}


def long_answers(answers: dict[str, DataFrame]) -> DataFrame:
    """All answers as one table (question, row_key, column, value): a row per figure."""
    parts = []
    for n, a in answers.items():
        keys = ANSWER_KEYS.get(n, [])
        figures = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in a.columns if c not in keys]
        parts.append(a.select(F.lit(n).alias("question"), F.concat_ws("|", *[F.col(c).cast("string") for c in keys]).alias("row_key"),
                              F.explode(F.array(*figures)).alias("f")).select("question", "row_key", "f.column", "f.value"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------------------
# The three jobs, as functions
# ---------------------------------------------------------------------------

def ingest(spark: SparkSession, raw_paths, out_path: str | None = None, splittable: bool = False,
           casts: dict[str, str] | None = None, infer: bool = False) -> DataFrame:
    """The raw file(s) as a Parquet table, parsed once; every job works on this table.

    ``casts`` (default: the question measures) happen in the same pass, "13.99%" becoming 13.99. With
    ``infer`` the text columns are written first, their types told by one aggregate over them, and cast. Files are read by many
    tasks also where fields hold line breaks; ``splittable`` says that none does, which saves the pass that finds them.
    """
    out_path = out_path or scratch_path(spark, "loans")
    if infer:
        text = ingest_raw(spark, raw_paths, scratch_path(spark, "loans-text"), multiline=not splittable, parallel=not splittable)
        # every text fits its column's type: no test per value
        with wide_rows(spark):
            write_table(text.withColumns({c: F.col(f"`{c}`").try_cast(t) for c, t in infer_types(text).items()}), out_path)
        return spark.read.parquet(out_path)
    return ingest_raw(spark, raw_paths, out_path, casts=QUESTION_CASTS if casts is None else casts, strip_chars="%",
                      nan_as_null=True, multiline=not splittable, parallel=not splittable)


def cleaning_job(spark: SparkSession, raw_paths, out_path: str, infer: bool = True, splittable: bool = False):
    """Ingest the raw file(s), run the cleaning chain on the ingested table, write Parquet.

    Returns the fitted facts (sparse columns dropped, means, categories).
    """
    with wide_rows(spark):
        cleaned, facts = clean_loans(ingest(spark, raw_paths, splittable=splittable, infer=infer))
        write_table(cleaned, out_path)
    return facts


def questions_job(spark: SparkSession, raw_paths, names=None, splittable: bool = False, by: Column | None = None) -> dict[str, DataFrame]:
    """Ingest the raw file(s) with the measures cast, and answer the questions from that table, those that can
    from one scan. ``by`` chooses q06's rows."""
    return shared_answers(ingest(spark, raw_paths, splittable=splittable), names, by=by)


def ml_table(cleaned: DataFrame) -> DataFrame:
    """Features and labels before any fit: names sanitised, finished loans, features as numbers."""
    return feat.add_labels(feat.select_rows(sanitize_names(cleaned), LOAN_ML), LOAN_ML)


def ml_job(spark: SparkSession, cleaned: DataFrame, tasks=("classification", "regression"),
           models="all", seed: int = 42, fit_on: str = "train", by: Column | None = None,
           save_to: str | None = None):
    """Build features and labels (staged once for all models), split 70/15/15 by a hash of
    the row (or a uniform column ``by``), fit imputation and scaling on the training split (``fit_on="all"``:
    on all rows, before the split), train and evaluate the models.

    ``tasks`` and ``models`` are a name, several, or "all" models. With ``save_to`` every model and its importance
    table (CSV) are saved below that folder. Returns (metrics table, {task/model: importance table},
    {task/model: fitted model}). A table without rows raises.
    """
    if fit_on not in ("train", "all"):
        raise ValueError("fit_on must be 'train' or 'all'")
    rows = ml_table(cleaned)
    numeric, ind = feat.feature_columns(rows, LOAN_ML)
    rows = rows.select(*numeric, *ind, feat.LABEL_CLASS, feat.LABEL_REG,
                       *([by.alias("__u")] if by is not None else [unit_hash(numeric + ind + ["loan_status"], seed).alias("__u")]))
    with wide_rows(spark):
        rows = stage_table(rows, "ml_rows", even=True)
    if not rows.take(1):
        raise ValueError("no finished loans with a target to train on")
    train, val, test = split_rows(rows, [0.7, 0.15, 0.15], by=F.col("__u"))
    prep = feat.fit_preparation(train if fit_on == "train" else rows, LOAN_ML)
    splits = {"train": prep.transform(train), "validation": prep.transform(val),
              "test": prep.transform(test)}
    metrics, results = suite.train_suite(spark, splits, tasks, models, seed)
    names = {f"{r.task}/{r.name}": r.model for r in results}
    importance = {n: suite.feature_importance(spark, m, prep.feature_names) for n, m in names.items()}
    if save_to:
        for n, m in names.items():
            path = f"{save_to.rstrip('/')}/{n.replace(' ', '_').lower()}"
            save_model(m, f"{path}/model")
            write_table(importance[n], f"{path}/importance", fmt="csv")
    return metrics, importance, names
