"""Row expressions on hand-made rows."""

from decimal import Decimal

from pyspark.sql import functions as F

from ledgerline.functions import columns as C


def _one(spark, data, schema, expr):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr.alias("x")).collect()]


def test_sentinel_and_blank(spark):
    got = _one(spark, [("a",), (None,), ("",), (" P ",)], "k string", C.sentinel("k"))
    assert got == ["a", "-9999", "", " P "]
    got = _one(spark, [("a",), (None,), ("",), (" P ",)], "k string", C.blank_to_sentinel("k"))
    assert got == ["a", "-9999", "-9999", " P "]


def test_core_amount_exclusion_is_three_valued(spark):
    # T6: excluded fund zeroed unless client is NG; a NULL client keeps the amount.
    data = [("70", "C01", Decimal("5.00")), ("70", "NG", Decimal("5.00")), ("70", None, Decimal("5.00")),
            ("11", "C01", None), ("91", "C02", None)]
    schema = "fund_iv string, client_id string, cash_value_amount decimal(17,2)"
    got = _one(spark, data, schema, C.core_amount(True))
    assert got == [Decimal("0.00"), Decimal("5.00"), Decimal("5.00"), Decimal("0.00"), Decimal("0.00")]
    assert _one(spark, data, schema, C.core_amount(False))[0] == Decimal("5.00")


def test_money_type_split_without_else(spark):
    data = [("EE", Decimal("1.00")), ("ER", Decimal("2.00")), (None, Decimal("3.00"))]
    schema = "money_type_description string, cash_value_amount decimal(17,2)"
    assert _one(spark, data, schema, C.money_type_amount("EE")) == [Decimal("1.00"), None, None]


def test_loan_amount_by_system(spark):
    data = [("PREMIER", Decimal("1.00"), Decimal("9.00")), ("VRP-PB", Decimal("1.00"), Decimal("9.00")),
            (None, Decimal("1.00"), Decimal("9.00"))]
    schema = "source_system string, outstanding_principal_balance decimal(17,2), loan_balance decimal(17,2)"
    assert _one(spark, data, schema, C.loan_amount()) == [Decimal("1.00"), Decimal("9.00"), Decimal("9.00")]


def test_allocated_and_active_flags(spark):
    # T4 spellings, T5 non-numeric status on a VRP system is simply not active.
    data = [("p1", "VRP-PB", "ALLOC", "16"), ("p2", "VRP_SP", "ALLOC", "3"), ("p3", "VRP-SP", "ALLOC", "3"),
            ("p4", "PREMIER", "UNALLOC", "A"), ("p5", "PREMIER", "ALLOC", "T"), ("p6", "VRP-PB", "UNALLOC", "17"),
            ("p7", "VRP-SP", "ALLOC", "X"), ("p8", "OTHER", "ALLOC", "1")]
    schema = "participant_id string, source_system string, account_type_code string, participant_status_code string"
    alloc = _one(spark, data, schema, C.allocated_id())
    active = _one(spark, data, schema, C.active_id())
    assert alloc == ["p1", "p2", None, "p4", "p5", None, None, None]
    assert active == ["p1", None, "p3", "p4", None, None, None, None]


def test_quarter_candidate(spark):
    import datetime as dt
    data = [(dt.date(2001, 3, 31),), (dt.date(2001, 4, 30),), (None,)]
    assert _one(spark, data, "d date", C.quarter_candidate("d")) == [True, False, True]
    assert _one(spark, data, "d date", C.is_quarter_month(F.col("d"))) == [True, False, None]


def test_report_date_literal():
    import datetime as dt
    assert "2001-07-31" in str(C.report_date(dt.date(2001, 8, 1), 1))


def test_status_code_compares_like_a_non_ansi_int_cast(spark):
    # T5: Spark without ANSI casts the string code to INT (blanks trimmed,
    # fraction truncated, anything else NULL); reproduced without ANSI errors.
    codes = ["16", "16.5", "17", " 3", "A", "1e1", "016", None, "-2", "99999999999"]
    got = _one(spark, [(c,) for c in codes], "participant_status_code string", F.expr(C.STATUS_AS_INT_SQL))
    assert got == [16, 16, 17, 3, None, None, 16, None, -2, None]
    rows = [(f"p{i}", "VRP-PB", "ALLOC", c) for i, c in enumerate(codes)]
    schema = "participant_id string, source_system string, account_type_code string, participant_status_code string"
    active = _one(spark, rows, schema, C.active_id())
    assert active == ["p0", "p1", None, "p3", None, None, "p6", None, "p8", None]


def test_pushable_loan_filter_equals_the_case_filter(spark):
    import itertools
    amounts = [None, Decimal("0.00"), Decimal("-1.00"), Decimal("5.00")]
    rows = list(itertools.product(["PREMIER", "VRP-PB", None], amounts, amounts))
    schema = "source_system string, outstanding_principal_balance decimal(17,2), loan_balance decimal(17,2)"
    df = spark.createDataFrame(rows, schema)
    got = df.select((C.loan_amount_positive()).alias("a"), (C.loan_amount() > 0).alias("b")).collect()
    assert len(got) == 48
    assert all((r.a is True) == (r.b is True) for r in got)
