from datetime import date

from creditspine.operators import ledger
from creditspine.plans.silver import silver_ledger
from creditspine.schemas import RAW_LEDGER

FIELDS = [f.name for f in RAW_LEDGER.fields]


def row(snapshot="2024-07-01", due="100.00", overdue="0.00", mob="6", loan="L1", paid="1.00"):
    return (loan, "C1", "2024-01-01", "10", mob, "1000.00", due, paid, overdue, "500.00", snapshot)


def silver(spark, rows, **kw):
    return silver_ledger(spark.createDataFrame(rows, RAW_LEDGER), **kw)


def test_missed_and_days(spark):
    out = silver(spark, [
        row(overdue="0.00"), row(overdue="200.00"), row(overdue="150.00"), row(overdue="100.00", snapshot="2024-03-01"),
        row(overdue="100.00", snapshot="2023-03-01"), row(due="0.00", overdue="50.00"), row(due=None, overdue="50.00"),
        row(overdue=None), row(overdue="bad text"),
    ]).select("installments_missed", "first_missed_date", "dpd").collect()
    assert [tuple(r) for r in out] == [
        (0, None, 0), (2, date(2024, 5, 1), 61), (2, date(2024, 5, 1), 61), (1, date(2024, 2, 1), 29),
        (1, date(2023, 2, 1), 28), (0, None, None), (0, None, None), (0, None, 0), (0, None, 0),
    ]


def test_exact_multiples_stay_exact(spark):
    out = silver(spark, [row(due=f"{c}.07", overdue=f"{3 * c}.21") for c in range(1, 300)])
    assert {r[0] for r in out.select("installments_missed").collect()} == {3}


def test_fill_all(spark):
    rows = [row(due=None, paid=None)]
    full = silver(spark, rows).first()
    some = silver(spark, rows, fill_all=False).first()
    assert (full["due_amt"], full["paid_amt"]) == (0, 0)
    assert (some["due_amt"], some["paid_amt"], some["installments_missed"]) == (None, None, 0)


def test_labels(spark):
    led = silver(spark, [
        row(loan="a", overdue="100.00"), row(loan="b", overdue="100.00", snapshot="2024-03-01"),
        row(loan="c", due="0.00", overdue="50.00"), row(loan="d", overdue="900.00", mob="5"),
    ])
    out = {r["loan_id"]: (r["label"], r["label_def"]) for r in ledger.build_labels(led).collect()}
    assert out == {"a": (1, "30dpd_6mob"), "b": (0, "30dpd_6mob"), "c": (0, "30dpd_6mob")}


def test_matured_customers(spark):
    led = silver(spark, [row(mob="5"), row(mob="6")])
    assert tuple(ledger.matured_customers(led).first()) == (1, 1)
