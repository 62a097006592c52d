"""Scalar rules: coercion, payload access, redaction, clock and keys."""

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from feedloom.functions import clock, coerce, keys, payload, redact


def column(spark, values, build, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["o"] for r in rows.select("i", build(F.col("v")).alias("o")).orderBy("i").collect()]


def python_float(text):
    if text is None or text == "":
        return None
    try:
        return float(text)
    except ValueError:
        return None


def python_int(text):
    """Truncated value; what does not fit 64 bits is null here."""
    try:
        value = int(Decimal(text))
    except Exception:
        return None
    return value if -(2**63) <= value < 2**63 else None


NUMBERS = [
    None, "", "abc", "12.7", "-12.7", "1e3", "-0.5", " 12 ", "0", "9007199254740993", "1.5d", "2f",
    "0x1p3", "1.", ".5", "+7", "1e-30", "--1", "1 2", "12345678901234567", "-9007199254740993",
]


def test_floats_follow_the_lenient_rule(spark):
    assert column(spark, NUMBERS, coerce.lenient_double) == [python_float(v) for v in NUMBERS]


def test_nan_and_infinities_are_kept_as_floats_only(spark):
    words = ["NaN", "inf", "-Infinity"]
    got = column(spark, words, coerce.lenient_double)
    assert str(got[0]) == "nan" and got[1:] == [float("inf"), float("-inf")]
    assert column(spark, words, coerce.lenient_long) == [None] * 3


def test_integers_truncate_and_stay_exact(spark):
    assert column(spark, NUMBERS, coerce.lenient_long) == [python_int(v) for v in NUMBERS]


def test_sequence_numbers_are_unsigned_64_bit(spark):
    texts = ["12.7", "18446744073709551615", "9007199254740993", "", None]
    got = column(spark, texts, coerce.lenient_sequence)
    assert got == [Decimal(12), Decimal(2**64 - 1), Decimal(9007199254740993), None, None]


@pytest.mark.parametrize(
    "side",
    [["1", "2.5", "3e2"], ["1", "x", None], ["", "4"], ["-1e999", "1"], ["1 2", "3"], [], None],
)
def test_levels_agree_with_the_element_rule(spark, side):
    floats = column(spark, [side], coerce.double_levels, "array<string>")[0]
    longs = column(spark, [side], coerce.long_levels, "array<string>")[0]
    if side is None:
        assert floats is None and longs is None
        return
    assert floats == [python_float(v) if python_float(v) is not None else 0.0 for v in side]
    assert longs == [python_int(v) or 0 for v in side]


def test_first_present_keeps_an_early_empty_string(spark):
    raw = ['{"ltp":"","last_price":5}', '{"ltp":null,"last_price":5}', '{"OI":1,"oi":2}', "[1]"]

    def build(v):
        return payload.first_present(payload.fields(v), "ltp", "last_price", "OI")

    assert column(spark, raw, build) == ["", "5", "1", None]


def test_canonical_json_sorts_every_level_and_keeps_broken_text(spark):
    raw = ['{"b":{"d":1,"c":"é"},"a":[2,1]}', "not json"]
    assert column(spark, raw, payload.canonical_json) == [
        '{"a":[2,1],"b":{"c":"é","d":1}}', "not json",
    ]


def test_type_label(spark):
    raw = ['{"type":"sf"}', '{"type":null}', '{"type":""}', "{}"]
    got = column(spark, raw, lambda v: payload.type_label(payload.fields(v)))
    assert got == ["sf", "None", None, None]


def test_server_error_in_either_field_and_any_case(spark):
    raw = ['{"s":"ERROR"}', '{"type":"Error"}', '{"s":"ok"}', "{}"]
    got = column(spark, raw, lambda v: payload.is_server_error(payload.fields(v)))
    assert got == [True, True, False, False]


def test_longest_secret_goes_first(spark):
    got = column(
        spark,
        ["opened by ID-7:hush-hush using store-key", "none"],
        lambda v: redact.redact_text(v, ["hush-hush", "ID-7:hush-hush", "", "store-key"]),
    )
    assert got == ["opened by <redacted> using <redacted>", "none"]


def test_details_are_redacted_in_values_at_any_depth_only(spark):
    secrets = ["tok", 'q"x', "nab", "100"]
    details = {
        "tok": "a tok b", "n": 100, "deep": [{"k": 'q"x'}, ["tok,"], "\nabc", "\\nabc"],
        "empty": "", "tail": "x\\",
    }

    def clean(value):
        if isinstance(value, dict):
            return {key: clean(item) for key, item in value.items()}
        if isinstance(value, list):
            return [clean(item) for item in value]
        if isinstance(value, str):
            for secret in sorted(secrets, key=len, reverse=True):
                value = value.replace(secret, "<redacted>")
        return value

    text = json.dumps(details, ensure_ascii=False)
    got = column(spark, [text], lambda v: redact.redact_details(v, secrets))[0]
    assert json.loads(got) == clean(details)


def test_settings_hide_secrets():
    shown = redact.redacted_settings({"a": "1", "token": "t"}, ["token"])
    assert shown == {"a": "1", "token": "<redacted>"}


def test_local_receipt_columns(spark):
    ns = [1784259900123456789]
    utc = lambda v: clock.utc_time(v)
    assert column(spark, ns, lambda v: clock.iso_local(utc(v)), "long") == [
        "2026-07-17T09:15:00.123456+05:30"
    ]
    assert column(spark, ns, lambda v: clock.trading_date(utc(v)), "long") == ["2026-07-17"]
    assert column(spark, ns, lambda v: clock.iso_local(utc(v), "America/New_York"), "long") == [
        "2026-07-16T23:45:00.123456-04:00"
    ]


def test_session_bounds(spark):
    # Friday 09:14:59, 09:15:00, 15:30:59, 15:31:00 and Saturday noon, all Asia/Kolkata.
    texts = [
        "2026-07-17 03:44:59", "2026-07-17 03:45:00", "2026-07-17 10:00:59", "2026-07-17 10:01:00",
        "2026-07-18 06:30:00",
    ]
    got = column(spark, texts, lambda v: clock.in_session(v.cast("timestamp")))
    assert got == [False, True, True, False, False]


def test_dates(spark):
    texts = ["20260717", "20260230", "2026-07-17", "../20260717", "", None]
    assert column(spark, texts, clock.is_compact_date) == [True, True, False, False, False, False]
    assert column(spark, texts, clock.is_calendar_date) == [True, False, False, False, False, False]


def test_object_keys(spark):
    rows = spark.createDataFrame(
        [("bk", "/bk/path/", "20260717"), ("bk", "", "20260717"), ("", "p//q", "20260717")],
        "b string, p string, d string",
    )
    got = [
        r["k"]
        for r in rows.select(keys.object_key(F.col("b"), F.col("p"), F.col("d")).alias("k"))
        .collect()
    ]
    tail = "20260717/20260717_trade_ticks.tar.gz"
    assert got == [f"path/{tail}", tail, f"p//q/{tail}"]
    assert column(spark, ["/bk/path/to/object"],
                  lambda v: keys.without_bucket(F.lit("bk"), v)) == ["path/to/object"]


def test_long_fractions_are_cut_not_rounded(spark):
    texts = ["0.9999999999999999999", "-3.99999999999999999999999", "7.00000000000000000001",
             " 5.9999999999999999999 ", "1.5e3", ".99999999999999999999999", "9.999999999999999999"]
    assert column(spark, texts, coerce.lenient_long) == [0, -3, 7, 5, 1500, 0, 9]
    assert column(spark, texts[:1], coerce.lenient_sequence) == [0]
