"""Text, CSV, casts and whitespace on hand-made rows (edge cases of FIXTURES §3)."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.errors import PySparkException

from kestrel.functions.casts import parse_us_date, to_date, to_type
from kestrel.functions.strings import PY_WHITESPACE, strip_ws
from kestrel.sources.csv import read_csv, write_csv
from kestrel.sources.text import read_delimited, read_lines, split_lines


def _write(lines):
    d = tempfile.mkdtemp(prefix="kestrel-test-")
    p = os.path.join(d, "in.txt")
    with open(p, "w") as f:
        f.write("\n".join(lines) + "\n")
    return p


def test_split_keeps_empty_trailing_fields(spark):
    p = _write(["1,a,", "", "2,b,c,d"])
    rows = split_lines(read_lines(spark, p)).collect()
    assert [r.parts for r in rows] == [["1", "a", ""], [""], ["2", "b", "c", "d"]]


def test_arity_filter_drops_other_field_counts(spark):
    p = _write(["1,2,3,4,x", "", "1,2,3,4", "1,2,3,4,x,extra", "5,6,7,8,y", "1,2,3,4,"])
    df = read_delimited(spark, p, ["a", "b", "c", "d", "label"],
                        ["double"] * 4 + [None], arity=5)
    got = [tuple(r) for r in df.collect()]
    assert got == [(1.0, 2.0, 3.0, 4.0, "x"), (5.0, 6.0, 7.0, 8.0, "y"), (1.0, 2.0, 3.0, 4.0, "")]


def test_short_lines_give_null_and_bad_numbers_null_when_tolerant(spark):
    p = _write(["1,250,extra", "2", "x,7", " 3 ,2.7"])
    df = read_delimited(spark, p, ["cid", "total"], ["double", "int"])
    got = [tuple(r) for r in df.collect()]
    # ' 3 ' parses (Spark trims for numeric casts); '2.7' is not an INT text
    assert got == [(1.0, 250), (2.0, None), (None, 7), (3.0, None)]


def test_strict_cast_fails_on_bad_text(spark):
    p = _write(["x,7"])
    df = read_delimited(spark, p, ["cid", "total"], ["double", "int"], strict=True)
    with pytest.raises(PySparkException):
        df.collect()


def test_strip_removes_every_python_whitespace(spark):
    vals = ["  Bob\t ", "\t\tAnn", "only-right \t", " \t ", None, " x　", "a b"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r[0] for r in df.select(strip_ws("s")).collect()]
    assert got == [None if v is None else v.strip() for v in vals]
    assert set(PY_WHITESPACE) == {c for c in map(chr, range(0x3001)) if c.isspace()}


def test_date_casts(spark):
    vals = ["2010-07-01", "07/01/2010", "2010-13-01", "", None]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    iso = [r[0] for r in df.select(to_date("s")).collect()]
    us = [r[0] for r in df.select(parse_us_date("s")).collect()]
    assert iso == [dt.date(2010, 7, 1), None, None, None, None]
    assert us == [None, dt.date(2010, 7, 1), None, None, None]


def test_int_and_double_casts(spark):
    vals = ["", " 3 ", "2.7", "12", "1e3", None]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    ints = [r[0] for r in df.select(to_type("s", "int")).collect()]
    dbls = [r[0] for r in df.select(to_type("s", "double")).collect()]
    assert ints == [None, 3, None, 12, None, None]
    assert dbls == [None, 3.0, 2.7, 12.0, 1000.0, None]


def test_csv_roundtrip_and_modes(spark):
    d = tempfile.mkdtemp(prefix="kestrel-csv-")
    rows = [(5.1, 3.5, 1.4, 0.2, "class-a"), (4.9, 3.0, 1.4, 0.2, None)]
    schema = "x1 float, x2 float, x3 float, x4 float, label string"
    write_csv(spark.createDataFrame(rows, schema), d + "/out")
    back = read_csv(spark, d + "/out", schema)
    assert sorted(back.collect(), key=lambda r: r.x1) == sorted(
        spark.createDataFrame(rows, schema).collect(), key=lambda r: r.x1)
    bad = _write(["1.0,2.0,3.0,4.0,a", "oops,2.0,3.0,4.0,b", "1.0,2.0"])
    permissive = read_csv(spark, bad, schema).collect()
    assert len(permissive) == 3 and permissive[1].x1 is None and permissive[2].x3 is None
    dropped = read_csv(spark, bad, schema, mode="DROPMALFORMED").collect()
    assert [r.label for r in dropped] == ["a"]
    with pytest.raises(Exception, match="FAILED_READ_FILE|MALFORMED"):
        read_csv(spark, bad, schema, mode="FAILFAST").collect()


def test_csv_multichar_separator(spark):
    d = tempfile.mkdtemp(prefix="kestrel-csv-")
    df = spark.createDataFrame([(9.1, 10.4, 2)], "a double, b double, label int")
    write_csv(df, d + "/gen", sep=", ")
    text = spark.read.text(d + "/gen").collect()[0].value
    assert text == "9.1, 10.4, 2"
    assert read_csv(spark, d + "/gen", "a double, b double, label int", sep=", ").collect() == df.collect()


def test_csv_keeps_corrupt_lines_when_asked(spark):
    bad = _write(["1.0,2.0,a", "oops,2.0,b"])
    schema = "x double, y double, label string, _bad string"
    rows = read_csv(spark, bad, schema, corrupt_column="_bad").collect()
    assert rows[0]._bad is None and rows[1]._bad == "oops,2.0,b" and rows[1].x is None


def test_integral_guard_accepts_everything_try_cast_accepts(spark):
    import random
    from kestrel.functions.casts import text_to_type
    alpha = list("0123456789") * 3 + list("+-. \t\n\r\x0b\x0c\x00\x1f\xa0　 eExLd٣０_,")
    rnd = random.Random(5)
    vals = {"".join(rnd.choice(alpha) for _ in range(rnd.randint(0, 6))) for _ in range(20000)}
    vals |= {"3", " 3 ", "\t3\n", "3.0", "+3", "-0", "2147483648", "\x003\x00", "　3", None}
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    for t in ("int", "bigint", "smallint"):
        bad = df.filter(~F.col("s").try_cast(t).eqNullSafe(text_to_type("s", t))).count()
        assert bad == 0, t


def test_strip_matches_python_on_random_text(spark):
    from hypothesis import given, settings, strategies as st

    alphabet = st.sampled_from(list("ab Z\t\n\r\x0b\x0c\x1c\x1f\x85\xa0 ​　﻿é"))
    texts = st.lists(st.text(alphabet, max_size=8), min_size=1, max_size=40)

    @settings(max_examples=5, deadline=None)
    @given(texts)
    def check(vals):
        df = spark.createDataFrame([(v,) for v in vals], "s string")
        assert [r[0] for r in df.select(strip_ws("s")).collect()] == [v.strip() for v in vals]

    check()


def test_strict_casts_fail_even_with_ansi_off(spark):
    df = spark.createDataFrame([("12",), ("x",)], "s string")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception):
            df.select(to_type("s", "int", strict=True)).collect()
        with pytest.raises(Exception):
            df.select(to_date("s", "MM/dd/yyyy", strict=True)).collect()
        assert [r[0] for r in df.select(to_type("s", "int")).collect()] == [12, None]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    ok = spark.createDataFrame([("12",), (None,)], "s string")
    assert [r[0] for r in ok.select(to_type("s", "int", strict=True)).collect()] == [12, None]


def test_lines_left_out_are_counted_in_the_same_pass(spark):
    from pyspark.sql import Observation

    lines = spark.createDataFrame([("a,b",), ("a",), ("",), (None,), ("a,,",), ("c,d",)], "value string").repartition(3)
    seen = Observation()
    assert split_lines(lines, arity=2, observed=seen).count() == 2
    assert seen.get == {"lines": 6, "left_out": 4}
    every = Observation()
    split_lines(lines, observed=every).collect()
    assert every.get == {"lines": 6, "left_out": 0}
