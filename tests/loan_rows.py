"""Hand-made loan rows: one small case per rule (see FIXTURES.md §5)."""

from riskframe.presets.loans import LOAN_COLUMNS

FIELDS = ["id", "loan_amnt", "int_rate", "home_ownership", "annual_inc", "issue_d",
          "loan_status", "purpose", "addr_state", "dti", "delinq_2yrs", "earliest_cr_line",
          "fico_range_low", "open_acc", "total_rec_late_fee", "emp_title", "tot_hi_cred_lim",
          "application_type", "verification_status", "grade", "num_accts_ever_120_pd"]


def loan(i, **kw):
    base = {
        "id": str(1000 + i), "loan_amnt": str(1000 * (i % 9 + 1)), "int_rate": f"{10 + i % 7}.5",
        "home_ownership": ["OWN", "RENT", "MORTGAGE"][i % 3], "annual_inc": str(40000 + 15000 * (i % 8)),
        "issue_d": "Dec-2015", "loan_status": ["Fully Paid", "Charged Off", "Current"][i % 3],
        "purpose": ["debt_consolidation", "car", "house"][i % 3],
        "addr_state": ["CA", "NY", "TX", None][i % 4], "dti": str(5 + i % 20),
        "delinq_2yrs": str(i % 3), "earliest_cr_line": f"Jan-{1990 + i % 20}",
        "fico_range_low": str(600 + 10 * (i % 10)), "open_acc": str(i % 6),
        "total_rec_late_fee": str(float(i % 4)), "emp_title": ["Teacher", "Nurse", None, "Driver"][i % 4],
        "tot_hi_cred_lim": str(20000 + 500 * i), "application_type": ["Individual", "Joint App"][i % 2],
        "verification_status": ["Verified", "Not Verified"][i % 2], "grade": "ABC"[i % 3],
        "num_accts_ever_120_pd": str(i % 2),
    }
    base.update(kw)
    return base


def loan_table(spark, rows):
    """A raw (all-string) loan table with all 151 columns."""
    data = [tuple(r.get(c) for c in LOAN_COLUMNS) for r in rows]
    schema = ", ".join(f"`{c}` string" for c in LOAN_COLUMNS)
    return spark.createDataFrame(data, schema)


def standard_rows(n=120):
    rows = [loan(i) for i in range(n)]
    rows[5]["int_rate"] = "13.99%"                 # percent text
    rows[6]["issue_d"] = ""                        # empty date
    rows[7]["issue_d"] = "2015-12"                 # wrong date format
    rows[8]["earliest_cr_line"] = "Jan-2020"       # issue before first credit line
    rows[9]["annual_inc"] = "NaN"                  # text NaN
    return rows
