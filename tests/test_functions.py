import datetime as dt

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from recordflow.functions import coerce, derive, flags, multivalue, text, urls


def test_flag_text_by_type(values):
    assert values(flags.flag_text, "true", "false", "1", "0", "True", None, "x") == ["Sim", "Não", "Sim", "Não", "", "", ""]
    assert values(flags.flag_text, True, False, None, kind="boolean") == ["Sim", "Não", ""]
    assert values(flags.flag_text, 1, 0, 2, None, kind="long") == ["Sim", "Não", "", ""]
    assert values(lambda c: flags.flag_text(c, ignore_case=True), "True", "FALSE") == ["Sim", "Não"]


def test_flag_round_trip(values):
    assert values(flags.flag_bool, "Sim", "Não", "", "1", "False", None) == [True, False, None, True, False, None]


def test_flag_repair(values):
    seen = ["True", "false", "1", "0", "x", "t", "", None]
    assert values(flags.repaired_flag, *seen) == [True, False, True, False, False, False, False, None]
    assert values(flags.is_invalid_flag, *seen) == [False] * 4 + [True] * 3 + [False]


def test_text_rendering(values):
    assert values(text.as_text, 2019110002851, None, kind="long") == ["2019110002851", ""]
    assert values(lambda c: text.first_non_blank(c, F.lit("b")), "a", "", None) == ["a", "b", "b"]
    assert values(lambda c: text.first_non_blank(c, F.lit(None)), "", None) == ["", ""]
    assert values(lambda c: text.first_non_null_text(c, F.lit(7)), "", None) == ["", "7"]


def test_protocol(values):
    got = values(text.protocol_text, "2019110002851.0", "12.9", "-12.9", " 5 ", "AB-1", "", None, "1e3", "1d", "nan", "9" * 25)
    assert got == ["'2019110002851", "'12", "'-12", "'5", "AB-1", None, None, "'1000", "1d", "nan", "9" * 25]


def test_control_characters(values):
    assert values(text.strip_control_chars, "a\x00b\x01\t\n\r\x0b\x1fc", None) == ["ab\t\n\rc", None]


def test_control_characters_of_a_row(spark):
    """All texts of a row are searched at once, and cleaned if one of them holds a control character."""
    rows = [("a\x01", 1, None, "b"), ("a", 2, "\x00", "\tb\x1f"), (None, None, None, None), ("", 4, "x", "y\n")]
    df = spark.createDataFrame(rows, "`a.b` string, n int, _texts string, c string")
    clean = text.strip_control_everywhere(df)
    assert clean.schema.simpleString() == df.schema.simpleString()
    assert sorted(map(tuple, clean.collect()), key=str) == sorted([("a", 1, None, "b"), ("a", 2, "", "\tb"), rows[2], rows[3]], key=str)
    assert clean._jdf.queryExecution().optimizedPlan().toString().lower().count("regexp_replace") == 1
    numbers = df.select("n")
    assert text.strip_control_everywhere(numbers).columns == ["n"]


def test_control_characters_of_packed_texts(spark):
    """The two steps together equal the one: NULL, empty and separators in the data, bytes that are no text."""
    rows = [("a\x01", 1, None, "b"), ("a\x1f", 2, "\x1e", "\tb\x1f\x1f"), (None, None, None, None), ("", 4, "", ""), ("\x1e", 5, "x", "y\n")]
    df = spark.createDataFrame(rows, "`a.b` string, n int, _texts string, c string").withColumn("raw", F.expr("cast(X'ff41' as string)"))
    expected = sorted(map(tuple, text.strip_control_everywhere(df).withColumn("raw", F.hex("raw")).collect()), key=str)
    for apart in ((), ("c",), ("a.b", "n", "c"), ("a.b", "_texts", "c", "raw")):
        packed, unpack = text.strip_control_packed(df, apart)
        assert len([c for c in packed.columns if c not in df.columns]) == 2 * (len(apart) < 4)
        assert unpack(packed).schema.simpleString() == df.schema.simpleString()
        assert sorted(map(tuple, unpack(packed).withColumn("raw", F.hex("raw")).collect()), key=str) == expected


def test_coerce_int(values):
    seen = ["3.0", "3.5", " 7 ", "x", "1d", "", None, "-4", "9007199254740993", "1e2", "1_000", "9" * 30, "9007199254740993.0"]
    assert values(coerce.coerce_int, *seen) == [3, None, 7, None, None, None, None, -4, 9007199254740993, 100, None, None, 9007199254740993]
    assert values(coerce.is_fractional, *seen)[:3] == [False, True, False]


def test_coerce_timestamp(values):
    got = values(coerce.coerce_timestamp, "2021-01-02", "2021-01-02 03:04:05", "2021-02-30", "", "x", "2021", "T12:30", None)
    assert got == [dt.datetime(2021, 1, 2), dt.datetime(2021, 1, 2, 3, 4, 5)] + [None] * 6


def test_null_tokens(values):
    assert values(coerce.null_tokens, "", "NULL", "None", "NaN", "NA", "n/a", "0", "none") == [None] * 6 + ["0", "none"]


def test_derived(values):
    assert values(derive.has_parent, "", None, "7") == [False, False, True]
    assert values(lambda c: derive.any_present(c, F.lit(None)), "a", None) == [True, False]
    assert values(lambda c: derive.all_present(c, F.lit("x")), "a", None) == [True, False]
    assert values(lambda c: derive.label_year(coerce.coerce_timestamp(c)), "2023-05-06", "x") == [2023, None]


def test_split_values(values):
    assert values(multivalue.split_values, "a||b", "||a", "nan", " a || a", None) == [["a", "b"], ["a"], [], ["a", "a"], None]


def test_has_member(values):
    cells = ["a||b", "ab", "b", "xa||b", None, "a|b"]
    assert values(lambda c: multivalue.has_member(c, "a"), *cells) == [True, False, False, False, None, False]
    assert values(lambda c: multivalue.has_member(c, "b"), *cells)[:4] == [True, False, True, True]
    assert values(lambda c: multivalue.has_member(c, "a.*"), "ab") == [False]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.lists(st.text("abcß|", min_size=1, max_size=4).filter(lambda s: "|" not in s), max_size=5), min_size=1, max_size=5))
def test_split_inverts_join(values, cells):
    joined = ["||".join(sorted(set(c))) for c in cells]
    assert values(multivalue.split_values, *joined) == [sorted(set(c)) for c in cells]


def test_urls(values):
    assert values(lambda c: urls.attachment_url("p/", c), "x", None) == ["p/x", None]
    assert values(lambda c: urls.build_url("http://h", F.lit("/b/"), c), "/f//", "", None) == ["http://h/b/f", None, None]


def test_url_pairs(values):
    seen = [
        "http://h/p?a=1&b=x%20y&a=2+3#a=9", "http://h/p", "http://h/p?a=&b&c==d", "h?a=%zz&%C3%A9=1", "http://h/p|q?x=1?2",
    ]
    got = values(lambda c: urls.url_pairs(c), *seen)
    assert [[(p["key"], p["value"]) for p in row] for row in got] == [
        [("a", "1"), ("b", "x y"), ("a", "2 3")], [], [("c", "=d")], [("a", "%zz"), ("é", "1")], [("x", "1?2")],
    ]
    assert values(urls.url_base, *seen)[:2] == ["http://h/p", "http://h/p"]
    grouped = values(lambda c: urls.grouped_pairs(urls.url_pairs(c)), seen[0])[0]
    assert [(g["key"], g["values"]) for g in grouped] == [("a", ["1", "2 3"]), ("b", ["x y"])]
