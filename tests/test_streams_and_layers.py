from datetime import datetime

import pytest
from conftest import SF, rows
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from freshet.catalog.base import EVENTS, events
from freshet.operators import counters as C
from freshet.operators import state as St
from freshet.plans.layers import gold_by, growth, name_history, silver_videos
from freshet.plans.quality import rule_report, unstable_names
from freshet.sinks.writers import write_table
from freshet.streaming import feed
from freshet.streaming.feed import drain, drain_new, file_stream, known_keys


def test_stream_never_repeats_an_id(spark, tmp_path):
    """What was written is gone before the keys come again: the state alone knows them."""
    df, keys, known = events(spark, SF), ["user_id", "event_id"], set()
    for n, kinds in enumerate((["click"], ["click", "view"], ["view"])):
        write_table(df.where(F.col("event_type").isin(kinds)).repartition(3), str(tmp_path / "in" / f"feed{n}"))
        out = tmp_path / f"out{n}"
        drain_new(file_stream(spark, str(tmp_path / "in" / "*"), EVENTS, files_per_batch=2), str(out), str(tmp_path / "c"), keys)
        wanted = set(rows(df.where(F.col("event_type").isin(kinds)), "event_id")) - known
        taken = rows(spark.read.schema(EVENTS).parquet(str(out)), "event_id") if out.exists() else []
        assert taken == sorted(wanted)
        known |= wanted
    assert rows(known_keys(spark, str(tmp_path / "c")), "event_id") == sorted(known)


def test_repeated_batch_replaces_its_rows(spark, tmp_path, monkeypatch):
    """The driver dies after the rows were written and before the batch counts as done."""
    write_table(spark.range(20).repartition(2), str(tmp_path / "in"))
    stream = file_stream(spark, str(tmp_path / "in"), spark.range(1).schema)
    args = (stream, str(tmp_path / "out"), str(tmp_path / "c"), ["id"])
    with monkeypatch.context() as patch:

        def dying(*written):
            write_table(*written)
            raise RuntimeError("lost driver")

        patch.setattr(feed, "write_table", dying)
        with pytest.raises(StreamingQueryException, match="lost driver"):
            drain_new(*args)
    write_table(spark.range(15, 25), str(tmp_path / "in"))
    drain_new(*args)
    assert rows(spark.read.parquet(str(tmp_path / "out")), "id") == [(i,) for i in range(25)]


def test_stream_drops_copies_within_a_batch(spark, tmp_path):
    write_table(spark.sql("select 1 as id, 'x' as v union all select 1, 'x' union all select 2, 'y' union all select null, 'z'"), str(tmp_path / "in"))
    stream = file_stream(spark, str(tmp_path / "in"), spark.read.parquet(str(tmp_path / "in")).schema)
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    drain_new(stream, str(tmp_path / "out"), str(tmp_path / "c"), ["id"])
    assert rows(spark.read.parquet(str(tmp_path / "out")), "id") == [(1,), (2,)]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before


def test_drain_takes_only_new_files(spark, tmp_path):
    for _ in range(2):
        write_table(spark.range(5), str(tmp_path / "in"))
        drain(file_stream(spark, str(tmp_path / "in"), spark.range(1).schema), str(tmp_path / "out"), str(tmp_path / "c"))
    drain(file_stream(spark, str(tmp_path / "in"), spark.range(1).schema), str(tmp_path / "out"), str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 10


SNAPSHOTS = [("A", datetime(2026, 1, d), name, subs) for d, name, subs in [(15, "!x", 10), (16, "x", 12), (17, "x", 11), (18, "!x", 11)]]


def snapshots(spark):
    return spark.createDataFrame(SNAPSHOTS, "channel_id string, run_ts timestamp, channel_name string, subscribers bigint")


def test_rename_history(spark):
    history = name_history(snapshots(spark), "channel_id", "channel_name", "run_ts")
    assert rows(history, "version", "channel_name", "valid_from", "valid_to") == [
        (1, "!x", datetime(2026, 1, 15), datetime(2026, 1, 16)),
        (2, "x", datetime(2026, 1, 16), datetime(2026, 1, 18)),
        (3, "!x", datetime(2026, 1, 18), None),
    ]
    assert rows(unstable_names(snapshots(spark), "channel_id", "channel_name")) == [("A",)]


def test_growth(spark):
    changes = growth(snapshots(spark), "channel_id", [F.col("run_ts").asc()], ["subscribers"])
    assert [r["subscribers_delta"] for r in changes.orderBy("run_ts").collect()] == [None, 2, -1, 0]


def test_gold_without_views(spark):
    df = spark.createDataFrame([("c", 0, 1, 1, 10), ("d", 10, 1, 1, 20)], "k string, v bigint, l bigint, c bigint, d bigint")
    assert rows(gold_by(df, ["k"], "v", "l", "c", "d")) == [("c", 1, 0, 10.0, 0.0), ("d", 1, 10, 20.0, 0.2)]


def test_silver_normalises(spark):
    row = ("v", None, "2026-01-01T00:00:00Z", None, 1, None, 2, None, None, None, "A", "a", "r1")
    names = "video_id title published_date view_count like_count comment_count duration tags category_id language channel_id channel_name run"
    kinds = ["string"] * 3 + ["bigint"] * 4 + ["string"] * 6
    df = spark.createDataFrame([row], ", ".join(f"{n} {k}" for n, k in zip(names.split(), kinds)))
    got = silver_videos(df).first()
    assert (got["title"], got["published_ts"], got["view_count"], got["tags"], got["language"]) == ("", datetime(2026, 1, 1), 0, [], "")


def test_rules(spark):
    df = spark.createDataFrame([(1, 5), (1, None), (2, -1)], "id int, n int")
    report = rule_report(df, {"not negative": F.col("n") >= 0}, unique="id")
    assert rows(report) == [("not negative", 2), ("unique key", 1)]


def test_ledger_status_only_moves_forward(spark):
    schema = "channel_id string, video_id string, published_ts timestamp, first_seen_run timestamp, status string, attempts bigint"
    d1, d2 = datetime(2026, 1, 1), datetime(2026, 1, 2)
    old = spark.createDataFrame([("A", "v1", d1, d1, "fetched", 1), ("A", "v2", d1, d1, "pending", 0)], schema)
    new = spark.createDataFrame([("A", "v1", None, d2, "missing", 2), ("A", "v2", None, d2, "missing", 1), ("A", "v3", d2, d2, "pending", 0)], schema)
    merged = St.upsert_ledger(old, new, ["channel_id", "video_id"])
    assert rows(merged, "video_id", "status", "first_seen_run", "attempts") == [
        ("v1", "fetched", d1, 2), ("v2", "missing", d1, 1), ("v3", "pending", d2, 0)
    ]
    again = St.upsert_ledger(merged, new, ["channel_id", "video_id"])
    assert rows(again, "video_id", "status") == rows(merged, "video_id", "status")


def test_watermark_upsert(spark):
    schema = "channel_id string, last_fetch_ts timestamp, updated_at timestamp"
    d1, d2 = datetime(2026, 1, 1), datetime(2026, 1, 2)
    merged = St.upsert_watermark(
        spark.createDataFrame([("A", d1, d1), ("B", d1, d1)], schema), spark.createDataFrame([("A", d2, d2)], schema), "channel_id"
    )
    assert rows(merged) == [("A", d2, d2), ("B", d1, d1)]


def test_outcome_report(spark):
    outcomes = spark.createDataFrame([(True,), (False,)], "ok boolean")
    assert C.all_success(outcomes, "ok").first()[0] is False
    assert C.all_success(outcomes.where("ok"), "ok").first()[0] is True
    assert [C.upload_status(*a) for a in [(False, "x"), (True, None), (True, "x"), (True, "x", False)]] == ["skipped", "skipped", "ok", "failed"]
