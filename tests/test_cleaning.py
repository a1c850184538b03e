from pyspark.sql import functions as F

from creditspine import schemas as S
from creditspine.functions import cleaning as C
from creditspine.functions import ratios as R


def values(spark, rows, column):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_strict_number(spark):
    rows = ["39", "39_", "_39", "3_9", "-500", "3.7", "", "abc", None, "8547", "1e3"]
    assert values(spark, rows, C.clean_numeric("x", "int", 1, 100)) == [39, None, None, 39, None, 3, None, None, None, None, None]


def test_strict_number_keeps_large_text(spark):
    assert values(spark, ["12000000.5", "-3.25"], C.clean_numeric("x", "double")) == [12000000.5, -3.25]


def test_lenient_number(spark):
    rows = ["39_", "-500", "x7.5y", "", None, "none", "99999999999"]
    assert values(spark, rows, C.extract_number("x", "int")) == [39, -500, 7, None, None, None, None]


def test_digits_only(spark):
    assert values(spark, ["2_3", "17", "100", "101", "-45", None, "x"], C.digits_only("x")) == [23, None, 100, None, 45, None, None]


def test_placeholders_and_patterns(spark):
    assert values(spark, ["_______", " Doctor ", "a_b", None], C.null_placeholder("x")) == [None, "Doctor", "a_b", None]
    assert values(spark, ["_", "NA", "ok"], C.null_tokens("x", ["_", "NA"])) == [None, None, "ok"]
    assert values(spark, ["123-45-6789", "#F%$D@*&8", "123-45-67890"], C.valid_pattern("x")) == ["123-45-6789", None, None]


def test_categories(spark):
    assert values(spark, ["Good", "Bad", "_", None], C.ordinal_map("x", S.CREDIT_MIX_RANK)) == [2, 0, None, None]
    assert values(spark, ["Yes", "No", "NM", None], C.yes_flag("x")) == [1, 0, 0, 0]
    rows = ["High_spent_Large_value_payments", "Low_spent_Small_value_payments", "!@9#%8"]
    assert values(spark, rows, C.behaviour_level("x", S.SPENT_RANK)) == [1, 0, None]
    assert values(spark, rows, C.behaviour_value("x", S.VALUE_RANK)) == [2, 0, None]
    assert values(spark, rows, C.behaviour_value("x", S.VALUE_RANK_LEGACY)) == [None, 0, None]
    assert values(spark, rows, C.behaviour_part("x", 2)) == ["Large", "Small", None]


def test_durations(spark):
    rows = ["22 Years and 1 Months", "5 Years", "3 Months", "NA", None]
    assert values(spark, rows, C.duration_to_months("x")) == [265, None, None, None, None]
    assert values(spark, rows, C.duration_to_months("x", months_required=False)) == [265, 60, None, None, None]


def test_lists(spark):
    rows = ["Auto Loan, Student Loan, and Student Loan", "A and B", "A", None]
    assert values(spark, rows, C.list_distinct_count("x")) == [2, 2, 1, 0]
    assert values(spark, rows, C.list_distinct_count("x", legacy_split=True)) == [3, 1, 1, 0]
    assert values(spark, rows, C.list_count_of("x", "student_loan")) == [2, 0, 0, 0]


def test_bins_and_caps(spark):
    rows = ["24", "25", "39", "40", "60", None]
    assert values(spark, rows, C.bin_numeric(F.col("x").cast("int"), *S.AGE_BANDS_SILVER)) == ["<25", "25-39", "25-39", "40-59", "60+", None]
    assert values(spark, rows, C.bin_numeric(F.col("x").cast("int"), *S.AGE_BANDS_REPORT, "Unknown"))[-1] == "Unknown"
    assert values(spark, ["5", "50", None], C.cap_constant(F.col("x").cast("int"), 20, 10)) == [10, 20, None]


def test_ratios_never_fail(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, -1.0), (None, 2.0)], "a double, b double")
    rows = df.select(R.safe_ratio("a", "b"), R.safe_ratio("a", "b", 1)).collect()
    assert [tuple(r) for r in rows] == [(None, 1.0), (-1.0, None), (None, None)]
