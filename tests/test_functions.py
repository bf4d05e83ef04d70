import hashlib
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from wageledger import functions as fn
from wageledger.functions.dates import calendar_fields
from wageledger.operators.names import anonymize, fill_names, missing_names
from wageledger.sources.dates import CALENDAR_END, CALENDAR_START, calendar, date_range


def values(spark, inputs, expr, kind="string"):
    rows = list(enumerate(inputs))
    out = spark.createDataFrame(rows, f"i int, x {kind}").select("i", expr(F.col("x")).alias("y"))
    return [r["y"] for r in sorted(out.collect(), key=lambda r: r["i"])]


def test_safe_long(spark):
    got = values(spark, ["2025", "2025.0", " 2025 ", "", "FY2025", None, "-3"], fn.safe_long)
    assert got == [2025, None, 2025, None, None, None, -3]


def test_safe_double(spark):
    texts = ["1.5", "1,200.5", "$3", "1e3", None, "1.5d", "nan", "inf", "-inf", "0x1p3", "1e999", "-.5", " 7 ", ""]
    assert values(spark, texts, fn.safe_double) == [1.5, 0, 0, 1000, 0, 0, 0, 0, 0, 0, 0, -0.5, 7, 0]


def test_safe_double_without_default(spark):
    assert values(spark, ["x", "2"], lambda c: fn.safe_double(c, None)) == [None, 2.0]


def test_safe_date(spark):
    texts = ["01/05/2025", "1/5/2025", " 1/5/2025 ", "13/45/2025", "02/30/2025", "2025-01-05", "", None]
    day = date(2025, 1, 5)
    assert values(spark, texts, fn.safe_date) == [day, day, day, None, None, None, None, None]


def test_clean_label(spark):
    assert values(spark, ["\t bus ", None, "  ", "　é "], fn.clean_label) == ["BUS", "UNKNOWN", "", "É"]


def test_fill_name(spark):
    assert values(spark, [" Jo Doe ", None, "  ", "\x1cA\x1f"], fn.fill_name) == ["Jo Doe", "UNKNOWN_EMPLOYEE", "", "A"]


def test_surrogate_key(spark):
    texts = ["Ferry", "", "Tram", "Ünal", None]
    want = [t if t is None else int.from_bytes(hashlib.sha256(t.encode()).digest()[:8], "big", signed=True) for t in texts]
    assert values(spark, texts, lambda c: fn.surrogate_key(c)) == want
    assert min(want[:4]) < 0 < max(want[:4])


def test_surrogate_key_keeps_parts_apart(spark):
    df = spark.createDataFrame([("AB", "C"), ("A", "BC"), ("A", None)], "a string, b string")
    first, second, third = (r["k"] for r in df.select(fn.surrogate_key(F.col("a"), F.col("b")).alias("k")).collect())
    assert first != second and third is None
    odd = spark.createDataFrame([("A|B", "C"), ("A", "B|C"), ("1:A", "B"), ("1", "A1:B")], "a string, b string")
    assert odd.select(fn.surrogate_key(F.col("a"), F.col("b"))).distinct().count() == 4


@pytest.mark.parametrize("salt", ["one", "two", "ü"])
def test_salted_hash_equals_python(spark, salt):
    names = ["Doe,Jo Q", "Ünal", ""]
    want = [hashlib.sha256(f"{n}{salt}".encode()).hexdigest()[:16] for n in names]
    assert values(spark, names, lambda c: fn.salted_hash(c, salt)) == want


def test_salt_matters(spark):
    a, b = (values(spark, ["Doe"], lambda c, s=s: fn.salted_hash(c, s))[0] for s in ("test", "other"))
    assert a != b and len(a) == len(b) == 16


def test_fill_names(spark):
    df = fill_names(spark.createDataFrame([(7, "\tPat, Lee "), (8, None), (9, "x")], "id int, Name string"))
    assert {r["id"]: r["Name"] for r in df.collect()} == {7: "Pat, Lee", 8: "UNKNOWN_EMPLOYEE", 9: "x"}


def test_anonymize_replaces_the_column_in_place(spark):
    df = spark.createDataFrame([("b7", "Pat Lee", 3)], "badge string, Name string, shifts int")
    out = anonymize(df, "pepper")
    assert out.columns == ["badge", "name_hash", "shifts"]
    assert (out.first()["badge"], out.first()["shifts"]) == ("b7", 3)


def test_anonymize_without_the_column_changes_nothing(spark):
    df = spark.createDataFrame([(1,)], "Salary int")
    assert anonymize(df, "secret").columns == ["Salary"]


def test_missing_names_share_a_hash(spark):
    df = spark.createDataFrame([(None,), (None,)], "Name string")
    assert anonymize(df, "secret").distinct().count() == 1
    assert missing_names(df).first().asDict() == {"missing_names": 2, "total_rows": 2}


def test_week_starts_on_sunday(spark):
    days = [date(2025, 1, 4), date(2025, 1, 5), date(2023, 1, 1)]
    assert values(spark, days, fn.week_of_year_sunday, "date") == [0, 1, 1]


def test_calendar(spark):
    days = calendar(date_range(spark, CALENDAR_START, CALENDAR_END), datetime(2025, 1, 1)).cache()
    assert days.count() == 1827
    first = days.orderBy("full_date").first()
    assert (first["fiscal_qtr"], first["week_day"], first["day_name"], first["day_is_weekday"]) == ("1", "3", "Wednesday", 1)
    assert days.where("day_is_weekday = 0").select("day_name").distinct().count() == 2
    assert len(days.columns) == len(calendar_fields(F.current_date())) + 1
    # every day against Python's own calendar
    for row in days.collect():
        day = row["full_date"]
        assert row["year_week"] == int(day.strftime("%U"))
        assert row["week_day"] == day.strftime("%w")
        assert row["calendar_key"] == day.isoformat()


def test_landed_name(spark):
    paths = ["gs://b/csv/raw/payroll_1.csv", "/l/payroll_2.csv/part-00000-x.csv", "/l/notes.txt", "/part-1.csv"]
    assert values(spark, paths, fn.landed_name) == ["payroll_1.csv", "payroll_2.csv", "", "part-1.csv"]
    assert values(spark, paths, fn.landed_object)[:2] == ["gs://b/csv/raw/payroll_1.csv", "/l/payroll_2.csv"]


def test_utc_stamp(spark):
    assert values(spark, [datetime(2025, 3, 4, 5, 6, 7)], fn.utc_stamp, "timestamp_ntz") == ["20250304_050607"]
