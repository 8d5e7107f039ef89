import math

from pyspark.sql import functions as F

from panelkit.functions import dates as D
from panelkit.functions import numeric as N
from panelkit.functions import text as X


def one(spark, col, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("o")).first()["o"]


def test_normalize_text_cases(spark):
    cases = {"  Málaga  Costa ": "MALAGA COSTA", "Tenerife - Norte": "TENERIFE - NORTE",
             "Alicante / Elche (**)": "ALICANTE / ELCHE (**)", None: "", "Straße ½": "STRASSE 12",
             "ﬁn\tde\x1cmes": "FIN DE MES", "ªº": "ao"}
    for raw, want in cases.items():
        assert one(spark, X.normalize_text("s"), raw) == want, raw


def test_normalize_text_nan_is_empty(spark):
    # Numeric cells go through null_nan first (Spark keeps NaN distinct from NULL).
    assert one(spark, X.normalize_text(N.null_nan("x")), float("nan"), "x double") == ""


def test_normalize_text_matches_python_on_latin(spark):
    import re
    import unicodedata
    samples = ["Château  d'Œil", "Ñandú   über", "Ærø — Ål", "São Tomé ½ ¾", "İstanbul"]
    for s in samples:
        t = unicodedata.normalize("NFKD", s.strip().upper()).encode("ascii", "ignore").decode()
        want = re.sub(r"\s+", " ", t).strip()
        assert one(spark, X.normalize_text("s"), s) == want, s


def test_normalize_entity_name_cases(spark):
    cases = {"  Málaga  Costa ": "MALAGA COSTA", "Tenerife - Norte": "TENERIFE-NORTE",
             "Alicante / Elche (**)": "ALICANTE-ELCHE", None: "", "A -- B": "A-B"}
    for raw, want in cases.items():
        assert one(spark, X.normalize_entity_name("s"), raw) == want, raw


def test_normalize_is_idempotent(spark):
    df = spark.createDataFrame([("Córdoba / Sur (*)",), ("x  y",)], "s string")
    once = df.select(X.normalize_entity_name("s").alias("s"))
    twice = once.select(X.normalize_entity_name("s").alias("s"))
    assert sorted(once.collect()) == sorted(twice.collect())


def test_title_case_is_python_title(spark):
    for s in ["BARCELONA-EL PRAT J.T.", "3RD O'NEIL-X", "a.b c"]:
        assert one(spark, X.title_case("s"), s) == s.title()


def test_slugify(spark):
    assert one(spark, X.slugify("s"), "__Hotel Occupancy (by) Province!__") == "hotel_occupancy_by_province"


def test_url_allowed(spark):
    df = spark.createDataFrame([("https://a.example.es/x",), ("https://evilexample.es/",),
                                ("http://example.es/",), ("not a url",)], "u string")
    strict = [r.o for r in df.select(X.url_allowed("u", ["example.es"]).alias("o")).collect()]
    loose = [r.o for r in df.select(X.url_allowed("u", ["example.es"], strict=False).alias("o")).collect()]
    assert strict == [True, False, False, False]
    assert loose == [True, True, False, False]


def test_buckets_right_closed(spark):
    temp = [10.0, 18.0, 25.0, 25.1, None]
    df = spark.createDataFrame([(t,) for t in temp], "t double")
    got = [r.b for r in df.select(N.bucket("t", [-math.inf, 10, 18, 25, math.inf],
                                           ["cold", "mild", "warm", "hot"]).alias("b")).collect()]
    assert got == ["cold", "mild", "warm", "hot", None]
    prec = [0.0, 20.0, 80.0, 80.1, -1.0]
    df = spark.createDataFrame([(p,) for p in prec], "p double")
    got = [r.b for r in df.select(N.bucket("p", [-0.001, 20, 80, math.inf],
                                           ["dry", "normal", "rainy"]).alias("b")).collect()]
    assert got == ["dry", "dry", "normal", "rainy", None]


def test_clean_number_and_truncating_cast(spark):
    df = spark.createDataFrame([(2.67505,), (float("nan"),), (None,), (-3.9,)], "x double")
    rows = df.select(N.clean_number("x").alias("c"), N.truncating_cast("x").alias("t")).collect()
    assert [r.c for r in rows] == [2.6751, None, None, -3.9]
    assert [r.t for r in rows] == [2, 0, 0, -3]


def test_calendar_columns_monday_zero(spark):
    df = spark.createDataFrame([("2024-01-01",), ("2024-01-06",), ("2024-01-07",)], "d string")
    rows = D.calendar_columns(df, "d").collect()
    assert [r.day_of_week for r in rows] == [0, 5, 6]
    assert [r.is_weekend for r in rows] == [False, True, True]
    assert rows[0].year_month == "2024-01"


def test_date_parts_and_season(spark):
    df = spark.createDataFrame([("2020-06",), ("2020-12",)], "ym string")
    rows = D.date_parts(df, "ym").withColumn("season", D.season("month")).collect()
    assert [(r.quarter, r.is_high_season, r.season) for r in rows] == [(2, 1, "summer"), (4, 0, "winter")]
    idx = df.select(D.month_index("ym").alias("i")).collect()
    assert idx[1].i - idx[0].i == 6


def test_year_month_format(spark):
    df = spark.createDataFrame([(2024, 3)], "y int, m int")
    assert df.select(D.year_month("y", "m").alias("o")).first().o == "2024-03"


def test_strip_ws_is_python_strip(spark):
    for s in [" Total ", "\tTotal\n", "\xa0Total　", "To tal", "\x1cTotal"]:
        assert one(spark, X.strip_ws("s"), s) == s.strip(), repr(s)
