from pyspark.sql import functions as F

from dunlin.functions import dates as D
from dunlin.functions import recode as C
from dunlin.functions import strings as S
from dunlin.operators import cleaning as M
from tests.conftest import values


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "x string").select(column(F.col("x")).alias("y")).first()["y"]


def test_standard_phone(spark):
    for raw, want in (("310/246-1501", "310-246-1501"), ("310/ 246- 1501", "310-246-1501"),
                      ("310- 246--1501", "310- 246--1501"), (None, None)):
        assert one(spark, raw, S.standard_phone) == want


def test_replace_first_and_count(spark):
    assert one(spark, "a_b_c", lambda c: S.replace_first(c, "_", " ")) == "a b_c"
    assert one(spark, "abc", lambda c: S.replace_first(c, "_", " ")) == "abc"
    assert one(spark, "x\n=1=", lambda c: S.replace_first(c, "=", "$")) == "x\n$1="
    assert one(spark, "", lambda c: S.replace_first(c, "_", " ")) == ""
    assert one(spark, "a,b,,c", lambda c: S.count_matches(c, ",")) == 3


def test_pad_after_last(spark):
    assert one(spark, "a,b", lambda c: S.pad_after_last(c, ",", 3)) == "a,,,b"
    assert one(spark, "a,b,c,d", lambda c: S.pad_after_last(c, ",", 3)) == "a,b,c,d"
    assert one(spark, "ab", lambda c: S.pad_after_last(c, ",", 2)) == ",,ab"
    assert one(spark, "a,", lambda c: S.pad_after_last(c, ",", 2)) == "a,,"


def test_up_to_second_and_parts(spark):
    assert one(spark, " a_b_c ", lambda c: S.up_to_second(c, "_")) == "a_b"
    assert one(spark, "a_b", lambda c: S.up_to_second(c, "_")) == "a_b"
    assert one(spark, "a b", lambda c: S.split_part_at(c, " ", 5)) is None
    assert one(spark, "/x/y.txt", S.last_segment) == "y.txt"
    assert one(spark, "Rain-Snow", lambda c: S.holds(c, "Rain")) == 1.0


def test_dates(spark):
    assert str(one(spark, "20130311172101557", D.parse_compact_millis)) == "2013-03-11 17:21:01.557000"
    stamp = one(spark, "[01/Aug/1995:00:00:01 -0400]", lambda c: D.parse_timestamp(c, D.LOG_FORMAT).cast("string"))
    assert stamp == "1995-08-01 04:00:01"
    assert one(spark, "09/02/1016:30", lambda c: D.parse_timestamp(c, "dd/MM/yyHH:mm").cast("string")) == "2010-02-09 16:30:00"
    assert one(spark, "nonsense", lambda c: D.parse_timestamp(c, "dd/MM/yyyy")) is None
    assert one(spark, "2024-01-01", lambda c: D.iso_day_number(F.to_date(c))) == 1
    assert one(spark, "2024-01-07", lambda c: D.day_name(F.to_date(c))) == "Sunday"


def test_recode(spark):
    assert one(spark, "zz", lambda c: C.recode(c, {"a": 1}, default=-1)) == -1
    assert one(spark, None, lambda c: C.recode(c, {"a": 1}, strict=True)) is None
    try:
        one(spark, "zz", lambda c: C.recode(c, {"a": 1}, strict=True))
        raise AssertionError("an unknown code must fail")
    except Exception as exc:  # noqa: BLE001
        assert "no code" in str(exc)
    df = spark.createDataFrame([(1.0,), (10.0,), (99.0,), (None,)], "x double")
    assert [r[0] for r in df.select(C.bin_by_bounds(F.col("x"), [10, 30], ["s", "m", "l"])).collect()] == ["s", "m", "l", None]


def test_missing_values(spark):
    df = spark.createDataFrame([("?", "", 1), ("a", "0", None), (None, "b", 3)], "k string, t string, n int")
    assert M.drop_rows_with_token(df, "?").count() == 2
    assert M.drop_empty(df, ["t"]).count() == 2
    assert values(M.empty_to_default(df, "0", ["t"]), "t") == [("NA",), ("NA",), ("b",)]
    assert values(M.missing_profile(df, "?")) == sorted([("k", 2, 66.6667), ("t", 0, 0.0), ("n", 1, 33.3333)], key=repr)
    assert M.missing_profile(df.limit(0)).count() == 3


def test_ragged_records(spark):
    lines = spark.createDataFrame([("d,L,a,avg",), ("d,S,avg",), ("d,L,a,b,avg",)], "line string")
    fixed = M.fixed_length_records(lines, "line", ["date", "ls", "s1", "s2", "avg"])
    assert values(fixed) == sorted([("d", "L", "a", "", "avg"), ("d", "S", "", "", "avg"), ("d", "L", "a", "b", "avg")], key=repr)
    assert M.separator_profile(lines, "line", ",").first()["max_separators"] == 4


def test_compound_columns(spark):
    df = spark.createDataFrame([("=AAPL/1.02 7",), ("bad",)], "s string")
    clean = df.withColumn("s", S.replace_first(S.replace_first(F.col("s"), "=", ""), "/", " "))
    out = M.split_compound(clean, "s", " ", {"ticker": (0, "string"), "ratio": (1, "double"), "n": (2, "int")})
    assert values(out, "ticker", "ratio", "n") == sorted([("AAPL", 1.02, 7), ("bad", None, None)], key=repr)
