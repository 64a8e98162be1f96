"""Edge rows for the scalar expressions (FIXTURES.md section 2)."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from civiclake.functions import keys, numbers, text


def _col(spark, values, dtype, expr):
    df = spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("v", dtype)]))
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_mun_code_text(spark):
    got = _col(spark, ["3550308", "355030", "3550308.0", " 35-50308 ", "12345", None, ""],
               T.StringType(), keys.mun_code)
    assert got == ["3550308", "0355030", None, "3550308", None, None, None]


def test_mun_code_numeric(spark):
    got = _col(spark, [3550308.0, 355030.0, None, 12345.0, float("nan")], T.DoubleType(),
               lambda c: keys.mun_code(c, numeric=True))
    assert got == ["3550308", "0355030", None, None, None]


def test_mun_code_prefix6(spark):
    got = _col(spark, ["355030", "3550308"], T.StringType(), lambda c: keys.mun_code(c, mode="prefix6"))
    assert got == ["355030", "3550308"]


def test_zfill_never_shortens(spark):
    assert _col(spark, ["12", "12345678", ""], T.StringType(), keys.zfill7) == ["0000012", "12345678", "0000000"]


def test_locale_population(spark):
    got = _col(spark, ["1.234", "1.234,9", "...", "-", "1.234.567"], T.StringType(), numbers.locale_count)
    assert got == [1234, 1234, 0, None, 1234567]


def test_locale_gdp(spark):
    got = _col(spark, ["1.234,5", "...", "-", "12"], T.StringType(), numbers.locale_double)
    assert got == [1234.5, None, None, 12.0]


def test_lenient_double(spark):
    got = _col(spark, ["12.5", "n/d", None, " 3 ", "1e3", "nan"], T.StringType(), numbers.lenient_double)
    assert got == [12.5, None, None, 3.0, 1000.0, None]


def test_round2_half_even_like_numpy(spark):
    import numpy as np
    vals = [2.675, 2.665, 0.125, 1.005, 0.375, -0.125, 32.585]
    got = _col(spark, vals, T.DoubleType(), numbers.round2)
    assert got == [float(np.round(v, 2)) for v in vals]


def test_rate_zero_and_null_population(spark):
    df = spark.createDataFrame([(5, 0), (5, None), (3, 1000)], "n long, p long")
    got = [r[0] for r in df.select(numbers.rate("n", "p", 100000)).collect()]
    assert got == [None, None, 300.0]


def test_year_value_fallback(spark):
    rows = [({"2024": "5"},), ({"2020": "1", "2021": "2"},), ({"2021": "7", "nota": "9"},),
            ({"2020": "1", "2021": None},), ({},)]
    df = spark.createDataFrame(rows, "m map<string,string>")
    got = df.select(text.year_value("m", 2024).alias("v"), text.year_used("m", 2024).alias("y")).collect()
    assert [r.v for r in got] == ["5", "2", "7", None, None]
    assert [r.y for r in got] == [2024, 2021, 2021, None, None]


def test_unwrap_envelope(spark):
    el = T.StructType([T.StructField("a", T.IntegerType())])
    pages = ['[{"a": 1}, {"a": 2}]', '{"data": [{"a": 3}]}', '{"items": [{"a": 4}]}',
             '{"data": null, "items": [{"a": 5}]}', '{"other": 1}']
    df = spark.createDataFrame([(p,) for p in pages], "j string")
    got = [None if r[0] is None else [x.a for x in r[0]]
           for r in df.select(text.unwrap_envelope("j", el, ["data", "items"])).collect()]
    assert got == [[1, 2], [3], [4], None, None]


def test_vaccination_results_envelope(spark):
    el = T.StructType([T.StructField("dose", T.StringType())])
    df = spark.createDataFrame([('{"results": [{"dose": "1a"}]}',), ('[{"dose": "2a"}]',), ('{"x": 1}',)], "j string")
    got = [None if r[0] is None else [x.dose for x in r[0]]
           for r in df.select(text.unwrap_envelope("j", el, ["results"])).collect()]
    assert got == [["1a"], ["2a"], None]


def test_upper_matches_facility_types(spark):
    from civiclake.plans.gold import BASIC_UNIT_PATTERN, HOSPITAL_PATTERN
    types = ["05", "Hospital Geral", "5", "UBS Centro", "Unidade Básica", "01", None]
    hosp = _col(spark, types, T.StringType(), lambda c: text.upper_matches(c, HOSPITAL_PATTERN))
    basic = _col(spark, types, T.StringType(), lambda c: text.upper_matches(c, BASIC_UNIT_PATTERN))
    assert sum(hosp) == 2
    # 'UNIDADE BÁSICA' has an accent, so only 'UBS' and '01' are basic units
    assert sum(basic) == 2


def test_value_text(spark):
    assert _col(spark, [1234.0, 12.345, 0.5], T.DoubleType(), numbers.value_text) == ["1,234", "12.35", "0.50"]


def test_stamps(spark):
    import datetime as dt
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 5, 60),)], "ts timestamp_ntz")
    r = df.select(text.run_stamp(F.col("ts")), text.iso_stamp(F.col("ts"))).first()
    assert r[0] == "20240102_030405" and r[1] == "2024-01-02T03:04:05.000060"


def test_discover_columns(spark):
    df = spark.createDataFrame([("3550308", 10.0, "x")], ["cod municipio", "total matr", "outro"])
    assert keys.discover_key_column(df) == "cod municipio"
    assert keys.discover_measure_column(df) == "total matr"
    df2 = spark.createDataFrame([("abc", 1.0)], ["cod municipio", "QT_MAT"])
    assert keys.discover_key_column(df2) is None
    assert keys.discover_measure_column(df2) == "QT_MAT"


def test_standardise_key_aliases(spark):
    df = spark.createDataFrame([(355030, "a"), (12, "b")], ["CODMUN", "n"])
    out = keys.standardise_key(df).collect()
    assert [(r.cod_mun_ibge_7, r.n) for r in out] == [("0355030", "a")]
    nokey = spark.createDataFrame([(1,)], ["x"])
    assert keys.standardise_key(nokey).columns == ["x"]


def test_short_keys_take_the_one_code_they_begin(spark):
    dim = spark.createDataFrame([("3550308",), ("3304557",), ("1111110",), ("1111111",), ("0000012",), ("0000129",), (None,)], "cod_mun_ibge_7 string")
    rows = [("0355030", 5), ("3550308", 1), ("0111111", 2), ("0000012", 3), ("0999999", 4), (None, 6)]
    got = keys.resolve_short_keys(spark.createDataFrame(rows, "cod_mun_ibge_7 string, n int"), dim)
    # a prefix of two codes, a code of the dimension, an unknown key and null stay
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == [
        ("3550308", 1), ("0111111", 2), ("0000012", 3), ("0999999", 4), ("3550308", 5), (None, 6)]
    assert keys.resolve_short_keys(got, dim.where("false")).count() == 6
