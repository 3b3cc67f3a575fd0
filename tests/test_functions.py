import pytest
from pyspark.sql import functions as F

from clickweave.functions.strings import java_split, utf8_length
from clickweave.functions.time import epoch_seconds

CASES = [
    ("2017-09-29 00:00:00", "Asia/Shanghai", 1506614400),
    ("2024-01-01 00:00:00", "UTC", 1704067200),
    ("2024-07-01 12:00:00", "America/New_York", 1719849600),
    ("2024-13-01 00:00:00", "UTC", None),       # bad month
    ("2024-02-30 00:00:00", "UTC", None),       # no such day
    ("2024-1-1 0:0:0", "UTC", None),            # not the strict shape
    ("2024-01-01T00:00:00", "UTC", None),
    (" 2024-01-01 00:00:0", "UTC", None),
    (None, "UTC", None),
]


@pytest.mark.parametrize("session_tz", ["UTC", "America/New_York", "Asia/Shanghai"])
def test_epoch_seconds_independent_of_session_zone(spark, session_tz):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", session_tz)
    try:
        for text, tz, want in CASES:
            df = spark.createDataFrame([(text,)], "s string")
            got = df.select(epoch_seconds("s", tz).alias("e")).first().e
            assert got == want, (text, tz, session_tz, got)
            # a non-default pattern takes the general path
            got2 = df.select(epoch_seconds(F.regexp_replace("s", " ", "T"), tz, "yyyy-MM-dd'T'HH:mm:ss").alias("e"))
            if want is not None:
                assert got2.first().e == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_java_split_and_utf8(spark):
    df = spark.createDataFrame([("a\t\tb\t\t",), ("é\tx",)], "s string")
    rows = df.select(java_split("s", "\t").alias("p"), utf8_length("s").alias("n")).collect()
    assert rows[0].p == ["a", "", "b"] and rows[1].p == ["é", "x"] and rows[1].n == 4


def _java_split(s, sep):
    """Java String.split(literal) with limit 0."""
    if s == "":
        return [""]
    parts = s.split(sep)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def test_java_split_property(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    texts = []

    @settings(max_examples=300, deadline=None)
    @given(st.text(alphabet="ab\t-", max_size=8))
    def collect(s):
        texts.append(s)

    collect()
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = df.select("s", java_split("s", "\t").alias("t"), java_split("s", "-").alias("d")).collect()
    for r in got:
        assert list(r.t) == _java_split(r.s, "\t") and list(r.d) == _java_split(r.s, "-"), r.s


@pytest.mark.parametrize("session_tz", ["America/New_York", "Europe/Paris", "UTC"])
def test_patterns_at_a_clock_change_of_the_session_zone(spark, session_tz):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", session_tz)
    try:
        # these hours do not exist in New York and in Paris
        df = spark.createDataFrame([("2024-03-10-02",), ("2024-03-31-02",), ("x",)], "s string")
        got = [r.e for r in df.select(epoch_seconds("s", "Asia/Shanghai", "yyyy-MM-dd-HH").alias("e")).collect()]
        assert got == [1710007200, 1711821600, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_lenient_dates_roll_over(spark):
    import datetime

    from clickweave.functions.time import epoch_seconds, lenient_wall_clock

    def rolled(y, mo, d, h, mi, s):
        first = datetime.datetime(y + (mo - 1) // 12, (mo - 1) % 12 + 1, 1)
        return first + datetime.timedelta(days=d - 1, hours=h, minutes=mi, seconds=s)

    cases = {
        "2017-13-01 00:00:00": rolled(2017, 13, 1, 0, 0, 0),
        "2017-0-31 1:2:3": rolled(2017, 0, 31, 1, 2, 3),
        "2018-2-30 25:61:61": rolled(2018, 2, 30, 25, 61, 61),
        "2016-02-29 10:00:00 and more": rolled(2016, 2, 29, 10, 0, 0),
        " 2016-  3- 1  7:08:09.5": rolled(2016, 3, 1, 7, 8, 9),
        "2016-3-0 0:0:86400": rolled(2016, 3, 0, 0, 0, 86400),
        "2016-1-999 0:0:0": rolled(2016, 1, 999, 0, 0, 0),
        "2024-01-05 06:07:08": datetime.datetime(2024, 1, 5, 6, 7, 8),
    }
    bad = ["", "2016-03-01", "2016-03-01T00:00:00", "x2016-03-01 00:00:00", "2016-03-01 00:00:", "2016-03-01 00:00:1234567890",
           "99999-01-01 00:00:00", "0-01-01 00:00:00", "-2016-01-01 00:00:00", None]
    rows = spark.createDataFrame([(k,) for k in [*cases, *bad]], "s string")
    got = {r.s: r for r in rows.select("s", lenient_wall_clock("s").alias("w"), epoch_seconds("s", "Asia/Shanghai", lenient=True).alias("t")).collect()}
    for text, want in cases.items():
        assert got[text].w == want, text
        assert got[text].t == int((want - datetime.datetime(1970, 1, 1)).total_seconds()) - 8 * 3600, text
    assert all(got[b].w is None and got[b].t is None for b in bad)


def test_key_states(lines):
    from pyspark.sql import functions as F

    from clickweave.operators import has_key, key_states

    df = lines(['{"a":null,"b":{"c":null}}', '{"b":{"c":1}}', '{"a":0,"b":null}', '{"a":"","b":[1]}', "[1]", "{bad", '  {"a":false}'])
    got = [tuple(r)[1:] for r in key_states(df, "a", "b", "b.c").collect()]
    assert got == [("null", "value", "null"), ("absent", "value", "value"), ("value", "null", "absent"), ("value", "value", "absent"),
                   (None, None, None), (None, None, None), ("value", "absent", "absent")]
    states = key_states(df, "a").select(has_key(F.col("a")).alias("x"), has_key(F.col("a"), "present").alias("y"))
    assert [tuple(r) for r in states.collect()] == [(False, True), (False, False), (True, True), (True, True), (False, False), (False, False), (True, True)]
