from datetime import date

from pyspark.sql import functions as F

from cuota.functions.dates import month_label, parse_month

CASES = [
    ("2025-01-31", "s", date(2025, 1, 1)), ("2025.01.31", "s", date(2025, 1, 1)), ("2025/1", "s", date(2025, 1, 1)),
    ("31/01/2025", "s", date(2025, 1, 1)), ("  2025/01/05 ", "s", date(2025, 1, 1)), ("1-2-2025", "s", date(2025, 2, 1)),
    ("45747", "n", date(2025, 3, 1)), ("45747.99", "n", date(2025, 3, 1)), ("45747", "s", None),
    ("25/01/31", "s", None), ("2025/02/30", "s", None), ("2025/13", "s", None), ("2025/001/01", "s", None),
    ("0000/01/01", "s", None), ("+2025/01/01", "s", None), ("Total", "s", None), ("2025-03-31 00:00:00", "d",
                                                                                   date(2025, 3, 1)),
    ("-0.5", "n", date(1899, 12, 1)), (None, "s", None), ("", "s", None), ("29/02/2024", "s", date(2024, 2, 1)),
]


def test_month_cells(spark):
    df = spark.createDataFrame([(i, t, k) for i, (t, k, _) in enumerate(CASES)], "i int, t string, k string")
    got = [r[0] for r in df.orderBy("i").select(parse_month(F.col("t"), F.col("k"))).collect()]
    assert got == [month for _, _, month in CASES]


def test_label(spark):
    assert spark.range(1).select(month_label(F.lit(date(2025, 3, 1)))).first()[0] == "Mar-25"
