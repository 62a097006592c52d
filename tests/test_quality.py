"""Verdicts, reasons, manifests and completion markers."""

import pytest

from feedloom.operators import manifest, quality
from feedloom.sources import lake

SCHEMA = (
    "run_id string, event_id long, component string, event_type string, severity string, "
    "connection_epoch int, details_json string"
)


def effects(spark, *rows):
    return quality.with_effects(spark.createDataFrame(list(rows), SCHEMA))


READY = ("r", 1, "process", "streams_ready", "INFO", 0, "{}")


@pytest.mark.parametrize(
    "row, degraded, fatal",
    [
        (("data", "socket_open", "INFO", 2, "{}"), "data_reconnected", None),
        (("data", "socket_open", "INFO", 1, "{}"), None, None),
        (("tbt", "socket_close", "WARNING", 1, "{}"), "tbt_socket_closed", None),
        (("tbt", "socket_close", "INFO", 1, "{}"), None, None),
        (("data", "socket_error", "ERROR", 1, '{"payload":"text"}'), "data_socket_error", None),
        (("data", "socket_error", "ERROR", 1, '{"payload":"{\\"s\\":\\"Error\\"}"}'),
         "data_socket_error", "data_server_error"),
        (("tbt", "server_error", "ERROR", 1, "{}"), "tbt_server_error", "tbt_server_error"),
        (("data", "disconnect_detected", "WARNING", 1, "{}"), "data_connection_interrupted", None),
        (("data", "data_disconnect_timeout", "ERROR", 1, "{}"), None, "data_disconnect_timeout"),
        (("tbt", "tbt_callback_failure", "ERROR", 1, "{}"), None, "tbt_callback_failure"),
        (("tbt", "tbt_reconnect_exhausted", "ERROR", 1, "{}"), None, "tbt_reconnect_exhausted"),
        (("tbt", "feed_stale_retry", "WARNING", 1, "{}"), "tbt_feed_stale", None),
        (("tbt", "feed_stale", "ERROR", 1, "{}"), "tbt_feed_stale", "tbt_feed_stale"),
        (("data", "feed_stale_retry_failure", "ERROR", 1, "{}"), None,
         "data_feed_stale_retry_failure"),
        (("data", "connect_timeout", "ERROR", 1, "{}"), None, "data_connect_timeout"),
        (("process", "first_event_timeout", "ERROR", 1, "{}"), None, "first_event_timeout"),
        (("tbt", "sequence_gap", "WARNING", 1, "{}"), "tbt_sequence_gap", None),
        (("tbt", "sequence_regression", "WARNING", 1, "{}"), "tbt_sequence_regression", None),
        (("tbt", "sequence_duplicate", "WARNING", 1, "{}"), None, None),
        (("tbt", "sequence_reset", "INFO", 1, "{}"), None, None),
        (("tbt", "sequence_after_reconnect", "WARNING", 2,
          '{"sequence_status":"first_after_reconnect_gap"}'), "tbt_sequence_gap", None),
        (("tbt", "sequence_after_reconnect", "WARNING", 2,
          '{"sequence_status":"first_after_reconnect_ok"}'), None, None),
        (("process", "socket_shutdown", "ERROR", 0, "{}"), None, "socket_shutdown_failure"),
    ],
)
def test_effect_of_a_control_row(spark, row, degraded, fatal):
    got = effects(spark, ("r", 2, *row)).first()
    assert (got["degraded_reason"], got["fatal_reason"]) == (degraded, fatal)


def test_verdicts(spark):
    gap = ("tbt", "sequence_gap", "WARNING", 1, "{}")
    rows = [
        ("ok", 1, "process", "streams_ready", "INFO", 0, "{}"),
        ("worse", 1, "process", "streams_ready", "INFO", 0, "{}"), ("worse", 5, *gap),
        ("worse", 6, *gap),
        ("dead", 1, "process", "streams_ready", "INFO", 0, "{}"), ("dead", 2, *gap),
        ("dead", 9, "tbt", "feed_stale", "ERROR", 1, "{}"),
        ("dead", 7, "data", "connect_timeout", "ERROR", 1, "{}"),
        ("early", 1, "process", "process_start", "INFO", 0, "{}"),
    ]
    got = {r["run_id"]: tuple(r)[1:] for r in quality.run_status(effects(spark, *rows)).collect()}
    assert got == {
        "ok": ("complete", "_SUCCESS", None),
        "worse": ("degraded", "_DEGRADED", None),
        "dead": ("failed", "_FAILED", "data_connect_timeout"),
        "early": ("failed", "_FAILED", "streams_not_ready"),
    }
    reasons = quality.degraded_reasons(effects(spark, *rows)).collect()
    assert {r["run_id"]: r["degraded_reasons"] for r in reasons} == {
        "worse": ["tbt_sequence_gap"], "dead": ["tbt_feed_stale", "tbt_sequence_gap"],
    }


def test_manifest_round_trip_and_single_marker(spark, tmp_path):
    root = str(tmp_path)
    events = spark.createDataFrame(
        [("r", "tbt_depth", "tbt", "S", 1, 1, 100), ("r", "symbol_update", "data", "S", 1, 2, 200)],
        "run_id string, source string, component string, symbol string, connection_epoch int, "
        "event_id long, received_at_unix_ns long",
    )
    parts = spark.createDataFrame([("r", "tbt_depth", 1), ("r", "tbt_depth", 4)],
                                  "run_id string, source string, rows long")
    built = manifest.manifests(
        events, effects(spark, READY), parts=parts, settings={"token": "t", "zone": "z"},
        secret_names=("token",),
    )
    for _ in range(2):  # A run is written once.
        manifest.write_manifests(built, root)
    assert lake.scan_manifests(spark, root).count() == 1
    row = lake.scan_manifests(spark, root).first()
    assert (row["run_id"], row["status"], row["clean_shutdown"]) == ("r", "complete", True)
    assert row["configuration"] == {"token": "<redacted>", "zone": "z"}
    assert row["received_events"] == {"tbt_depth": 1, "symbol_update": 1}
    assert row["rows_written"] == {"tbt_depth": 5} and row["files_written"] == {"tbt_depth": 2}
    assert (row["started_at_unix_ns"], row["ended_at_unix_ns"]) == (100, 200)
    manifest.write_marker(spark, root, "r", row["status"])
    assert (tmp_path / "_runs" / "run=r" / "_SUCCESS").exists()
    with pytest.raises(FileExistsError):
        manifest.write_marker(spark, root, "r", "failed")
