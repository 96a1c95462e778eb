"""The twelve loan questions on hand-made rows, against brute force in Python."""

from collections import Counter, defaultdict

import pytest

from riskframe.presets import loans
from tests.loan_rows import loan, loan_table, standard_rows


@pytest.fixture(scope="module")
def data(spark):
    rows = standard_rows()
    return rows, loans.prepare_loans(loan_table(spark, rows))


def num(v):
    try:
        f = float(str(v).rstrip("%"))
        return None if f != f else f
    except (TypeError, ValueError):
        return None


def test_registry_has_twelve():
    assert loans.QUESTIONS.names() == [f"q{i:02d}" for i in range(1, 13)]


def test_q01_q02_q03(data):
    rows, df = data
    sel = [num(r["loan_amnt"]) for r in rows
           if r["home_ownership"] == "OWN" and (num(r["annual_inc"]) or 0) > 100000]
    got = loans.QUESTIONS.answer("q01", df).collect()[0][0]
    assert got == pytest.approx(sum(sel) / len(sel))
    n2 = sum(1 for r in rows if (num(r["num_accts_ever_120_pd"]) or 0) > 0
             and r["purpose"] == "debt_consolidation")
    assert loans.QUESTIONS.answer("q02", df).collect()[0][0] == n2
    base = [r for r in rows if num(r["fico_range_low"]) is not None and num(r["fico_range_low"]) < 650]
    hit = [r for r in base if (num(r["delinq_2yrs"]) or 0) > 0]
    assert loans.QUESTIONS.answer("q03", df).collect()[0][0] == pytest.approx(len(hit) / len(base) * 100)


def test_q01_no_match_is_null(spark):
    df = loans.prepare_loans(loan_table(spark, [loan(1, home_ownership="RENT")]))
    assert loans.QUESTIONS.answer("q01", df).collect()[0][0] is None
    empty = loans.prepare_loans(loan_table(spark, [loan(1, fico_range_low="700")]))
    assert loans.QUESTIONS.answer("q03", empty).collect()[0][0] is None


def test_q04_null_state_is_a_group(data):
    _, df = data
    states = {r["addr_state"] for r in loans.QUESTIONS.answer("q04", df).collect()}
    assert None in states and "CA" in states


def test_q05_top_titles(data):
    rows, df = data
    cnt = Counter(r["emp_title"] for r in rows if r["emp_title"] is not None)
    got = [(r["emp_title"], r["num_clients"]) for r in loans.QUESTIONS.answer("q05", df).collect()]
    want = sorted(cnt.items(), key=lambda kv: (-kv[1], kv[0]))[:10]
    assert got == want


def test_q06_difference(data):
    rows, df = data
    out = loans.QUESTIONS.answer("q06", df).collect()
    assert len(out) == 10
    by = defaultdict(list)
    for r in rows:
        if num(r["annual_inc"]) is not None:
            by[r["addr_state"]].append(num(r["annual_inc"]))
    for r in out:
        mean = sum(by[r["addr_state"]]) / len(by[r["addr_state"]])
        assert r["avg_state_income"] == pytest.approx(mean)
        if r["annual_inc"] is not None:
            assert r["income_difference"] == pytest.approx(r["annual_inc"] - mean)
    again = loans.QUESTIONS.answer("q06", df.repartition(7)).collect()
    assert sorted(r["id"] for r in again) == sorted(r["id"] for r in out)


def test_q07_min_loans_and_share(spark):
    rows = ([loan(i, addr_state="AA", loan_status="Charged Off" if i < 3 else "Fully Paid") for i in range(10)]
            + [loan(100 + i, addr_state="BB", loan_status="Charged Off") for i in range(9)])
    df = loans.prepare_loans(loan_table(spark, rows))
    out = loans.QUESTIONS.answer("q07", df).collect()
    assert [(r["addr_state"], r["total_loans"], r["charged_off_count"]) for r in out] == [("AA", 10, 3)]
    assert out[0]["default_rate_pct"] == pytest.approx(30.0)


def test_q08_bad_dates_fall_out(data):
    rows, df = data
    out = loans.QUESTIONS.answer("q08", df).collect()
    total = sum(r["loan_count"] for r in out)
    # rows 6, 7 (bad issue date) and 8 (negative age) are excluded; others kept
    assert total == len(rows) - 3
    assert [r["quartile"] for r in out] == [1, 2, 3, 4]


def test_q09_q10_q11_q12_shapes(data):
    _, df = data
    q9 = loans.QUESTIONS.answer("q09", df).collect()
    assert [r["application_type"] for r in q9] == ["Individual", "Joint App"]
    q10 = loans.QUESTIONS.answer("q10", df).collect()
    assert len(q10) == 3 and all(r["vs_overall_ratio"] is not None for r in q10)
    q11 = loans.QUESTIONS.answer("q11", df).collect()
    assert sum(r["total_loans"] for r in q11) == sum(
        1 for r in standard_rows() if r["loan_status"] in ("Fully Paid", "Charged Off"))
    q12 = loans.QUESTIONS.answer("q12", df).collect()
    assert {(r["verification_status"], r["grade"]) for r in q12} == {
        (v, g) for v in ("Verified", "Not Verified") for g in "ABC"
        if any(r["verification_status"] == v and r["grade"] == g for r in standard_rows())}


def test_q10_zero_overall_mean_gives_null_ratio(spark):
    rows = [loan(i, delinq_2yrs="0") for i in range(6)]
    df = loans.prepare_loans(loan_table(spark, rows))
    out = loans.QUESTIONS.answer("q10", df).collect()
    assert all(r["vs_overall_ratio"] is None for r in out)


def test_percent_rate_is_parsed(data):
    _, df = data
    assert df.filter("id = '1005'").collect()[0]["int_rate"] == pytest.approx(13.99)
    assert df.filter("id = '1009'").collect()[0]["annual_inc"] is None


def test_all_questions_on_empty_table(spark):
    df = loans.prepare_loans(loan_table(spark, []))
    out = {name: ans.collect() for name, ans in loans.QUESTIONS.run(df).items()}
    assert out["q01"][0][0] is None and out["q02"][0][0] == 0 and out["q03"][0][0] is None
    assert all(out[q] == [] for q in ("q04", "q05", "q06", "q07", "q08", "q09", "q10", "q11", "q12"))


def test_write_answers(spark, data):
    from riskframe.plans.questions import write_answers
    from riskframe.session import scratch_path
    _, df = data
    root = scratch_path(spark, "answers")
    paths = write_answers(loans.QUESTIONS.run(df, ["q04", "q07"]), root, fmt="csv")
    assert [p.rsplit("/", 1)[1] for p in paths] == ["q04", "q07"]
    assert spark.read.option("header", True).csv(paths[0]).count() == 4
