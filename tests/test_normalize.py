"""Messages to typed rows: aliases, sanitising, full books, exact sequence numbers."""

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from feedloom import schemas
from feedloom.operators import normalize, route, universe

ARRIVED = ("run", 1, "connection", 1, 1784259900000000000, 2)


def quotes(spark, *messages):
    rows = [
        (*ARRIVED[:1], i + 1, *ARRIVED[2:], m if isinstance(m, str) else json.dumps(m))
        for i, m in enumerate(messages)
    ]
    return spark.createDataFrame(rows, schemas.QUOTE_MESSAGES)


# Each side of a book as a function of the level, as text on arrival and as stored.
LEVELS = {
    "bidprice": ("bid_prices", lambda i: 72.5 - i / 8),
    "askprice": ("ask_prices", lambda i: 73.0 + i / 4),
    "bidqty": ("bid_quantities", lambda i: 600 - 7 * i),
    "askqty": ("ask_quantities", lambda i: 40 + i * i),
    "bidordn": ("bid_order_counts", lambda i: 1 + i % 6),
    "askordn": ("ask_order_counts", lambda i: 1 + i % 9),
}


def depth(spark, **changes):
    sides = {name: [str(at(i)) for i in range(50)] for name, (_, at) in LEVELS.items()}
    book = {
        "tbq": "81250", "tsq": "7310", **sides,
        "snapshot": "true", "timestamp": "5150", "sendtime": "5153", "seqNo": "90017", **changes,
    }
    row = (*ARRIVED, "BSE:PLUM", "7", tuple(book.values()))
    return spark.createDataFrame([row], schemas.DEPTH_MESSAGES)


def test_quote_keeps_unknown_fields(spark):
    extras = {"venue_note": ["a", {"b": None}], "zz": False}
    known = {"symbol": "BSE:PLUM", "ltp": "72.25", "bid_price": 72, "vol_traded_today": "41e1"}
    frame = normalize.normalize_quotes(quotes(spark, {**extras, **known}, known))
    wanted = [(f.name, f.dataType) for f in schemas.QUOTES]
    assert [(f.name, f.dataType) for f in frame.schema] == wanted
    more, plain = frame.orderBy("event_id").collect()
    typed = ("symbol", "ltp", "bid_price", "volume_traded_today", "ask_price", "update_type")
    assert [more[c] for c in typed] == [plain[c] for c in typed]
    assert [plain[c] for c in typed[:5]] == ["BSE:PLUM", 72.25, 72.0, 410, None]
    assert set(more["present_fields"]) - set(plain["present_fields"]) == set(extras)
    kept = json.loads(more["raw_json"])
    assert {name: kept[name] for name in extras} == extras


def test_zero_pair_is_nulled_and_named(spark):
    pairs = [(0, 0), ("0", 0.0), (0, 9.5), (4, 0), (None, 0)]
    sent = [{"symbol": "P", "lower_ckt": low, "upper_ckt": high} for low, high in pairs]
    rows = normalize.normalize_quotes(quotes(spark, *sent)).orderBy("event_id").collect()
    limits = [(r["lower_circuit"], r["upper_circuit"]) for r in rows]
    assert limits == [(None, None), (None, None), (0.0, 9.5), (4.0, 0.0), (None, 0.0)]
    named = [r["sanitized_fields"] for r in rows]
    assert named == [["lower_circuit", "upper_circuit"]] * 2 + [[]] * 3
    assert json.loads(rows[0]["raw_json"])["upper_ckt"] == 0


def test_full_book(spark):
    row = normalize.normalize_depth(depth(spark), include_raw_json=True).first()
    raw = json.loads(row["raw_json"])
    for name, (stored, at) in LEVELS.items():
        levels = [at(i) for i in range(50)]
        assert row[stored] == levels and raw[name] == levels
    numbers = {"sequence_no": 90017, "feed_time": 5150, "send_time": 5153, "total_sell_qty": 7310}
    assert {name: int(row[name]) for name in numbers} == numbers
    assert (row["symbol"], row["channel"], row["is_snapshot"]) == ("BSE:PLUM", "7", True)
    assert row["payload_semantics"] == normalize.PAYLOAD_SEMANTICS


@pytest.mark.parametrize("side", [["1"] * 49, ["1"] * 51, [], None])
def test_wrong_length_is_quarantined_or_raised(spark, side):
    wrong = depth(spark, bidprice=side)
    kept, refused = normalize.split_books(wrong)
    assert (kept.count(), refused.count()) == (0, 1)
    with pytest.raises(Exception, match="wrong length"):
        normalize.normalize_depth(wrong, strict=True).collect()


def test_bad_levels_become_zero(spark):
    side = ["x", None, "2.9"] + ["1"] * 47
    row = normalize.normalize_depth(depth(spark, bidprice=side, bidqty=side), strict=True).first()
    assert row["bid_prices"][:3] == [0.0, 0.0, 2.9]
    assert row["bid_quantities"][:3] == [0, 0, 2]


def test_large_sequence_numbers_are_exact(spark):
    row = normalize.normalize_depth(depth(spark, seqNo=str(2**64 - 1))).first()
    assert row["sequence_no"] == Decimal(2**64 - 1)


def test_control_event_is_redacted(spark):
    base = quotes(spark, "x").drop("payload")
    row = normalize.control_events(
        base, component=F.lit("data"), event_type=F.lit("socket_open"), severity=F.lit("INFO"),
        message=F.lit("with s3cret"), details=F.lit('{"s3cret":"s3cret"}'), secrets=("s3cret",),
    ).first()
    assert row["message"] == "with <redacted>"
    assert row["details_json"] == '{"s3cret":"<redacted>"}'
    assert row["source"] == "control"


def listed(spark, text, **options):
    frame = spark.createDataFrame([(1, text)], "id int, raw string")
    return universe.universe(frame, "raw", ["id"], **options).orderBy("position").collect()


def test_symbols_keep_first_spelling_and_order(spark):
    rows = listed(spark, "NSE:ONE-EQ, NSE:TWO-EQ,nse:one-eq,,  B ")
    assert [r["symbol"] for r in rows] == ["NSE:ONE-EQ", "NSE:TWO-EQ", "B"]
    assert [r["symbol"] for r in listed(spark, '[" b", "a", "B"]')] == ["b", "a"]
    for text, problem in (("[broken", "not valid JSON"), (" , ", "no usable symbols")):
        assert listed(spark, text, max_symbols=None) == []
        with pytest.raises(Exception, match=problem):
            listed(spark, text)


def test_groups_of_five_and_the_limit(spark):
    rows = listed(spark, ",".join(f"S{i}" for i in range(10)))
    assert [r["connection_key"] for r in rows] == ["tbt:1"] * 5 + ["tbt:2"] * 5
    assert len(listed(spark, ",".join(f"S{i}" for i in range(15)))) == 15
    with pytest.raises(Exception, match="more than 15 symbols"):
        listed(spark, ",".join(f"S{i}" for i in range(16)))


def test_routes(spark):
    configured = spark.createDataFrame([("NSE:A", "tbt:1")], "symbol_upper string, connection_key string")
    messages = quotes(
        spark, {"symbol": "nse:a"}, {"symbol": "NSE:B"}, {"s": "ok"}, "[1]", {"symbol": ""}, "junk",
    )
    rows = route.route_quotes(messages, configured).orderBy("event_id").collect()
    assert [r["route"] for r in rows] == [
        "data", "unexpected_symbol", "service_message", "unrecognized_message", "service_message",
        "unrecognized_message",
    ]
