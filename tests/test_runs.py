"""Run scenarios over small landed folders, one test per behaviour."""

import gzip
import json
from datetime import datetime, timedelta
from pathlib import Path
from urllib.parse import unquote

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import AnalysisException

from freshet.operators.counters import summary_metrics
from freshet.plans.ingest import RunConf, run_job
from freshet.plans.layers import silver_videos
from freshet.plans.migrate import import_state
from freshet.plans.publish import publish
from freshet.plans.store import RunStore
from freshet.schemas import CHANNEL_STATS, VIDEO_DETAILS
from freshet.sources import isolation
from freshet.sources.files import read_bronze

T0 = datetime(2026, 1, 1)
R1, R2, R3, R4 = (datetime(2026, 1, 2) + timedelta(hours=3 * i) for i in range(4))


class World:
    """Channels and their videos as a remote service would answer them."""

    def __init__(self, spark, tmp_path):
        self.spark, self.base, self.step = spark, tmp_path, 0
        self.videos, self.names, self.broken, self.hidden = {}, {}, set(), set()

    def publish(self, channel, ids, start=T0, minutes=1):
        self.names.setdefault(channel, f"name of {channel}")
        for n, video in enumerate(ids):
            self.videos.setdefault(channel, {})[video] = start + timedelta(minutes=minutes * n)

    def land(self):
        self.step += 1
        root = self.base / f"landing{self.step}"
        for kind in ("channels", "search", "videos"):
            (root / kind).mkdir(parents=True)
        for channel, name in self.names.items():
            stats = {"subscriberCount": "7", "viewCount": "8"}
            self._put(root, "channels", channel, 0, [{"id": channel, "snippet": {"title": name}, "statistics": stats}])
            newest = sorted(self.videos.get(channel, {}).items(), key=lambda v: (v[1], v[0]), reverse=True)
            for page in range(0, max(1, len(newest)), 50):  # a channel without videos answers an empty page
                found = [
                    {"id": {"kind": "s#video", "videoId": v}, "publishedAt": f"{t.isoformat()}Z"} for v, t in newest[page : page + 50]
                ]
                self._put(root, "search", channel, page // 50, found)
                details = [
                    {"id": v, "snippet": {"title": v, "publishedAt": f"{t.isoformat()}Z"}, "statistics": {"viewCount": "1"},
                     "contentDetails": {"duration": f"PT{n}S"}}
                    for n, (v, t) in enumerate(newest[page : page + 50]) if v not in self.hidden
                ]
                self._put(root, "videos", channel, page // 50, details)
            if channel in self.broken:
                (root / "search" / f"s__{channel}__p99.json").write_text("{oops")
        return str(root)

    def _put(self, root, kind, channel, page, items):
        (root / kind / f"{kind}__{channel}__p{page}.json").write_text(json.dumps({"items": items}, indent=1))

    def conf(self, landing, run_ts, **options):
        listing = self.base / "list.csv"
        listing.write_text("channel_name,channel_id\n" + "\n".join(f"x,{c}" for c in self.names))
        return RunConf(landing, str(self.base / "store"), str(listing), run_ts, multi_line=True, **options)

    def run(self, run_ts, refresh=None, landing=None, **options):
        return run_job(self.spark, self.conf(landing or self.land(), run_ts, **options), refresh)

    @property
    def store(self):
        return RunStore(str(self.base / "store"))


@pytest.fixture
def world(spark, tmp_path):
    return World(spark, tmp_path)


def ids(result):
    return [v for (v,) in rows(result.videos, "video_id")]


def audit(result, channel="A"):
    return result.audit.where(f"channel_id = '{channel}'").first().asDict()


def state_after(world, run_ts):
    return world.store.load(world.spark, run_ts + timedelta(seconds=1))


def open_rows(world, run_ts):
    return rows(state_after(world, run_ts).open, "video_id", "status", "attempts")


def marks(world, run_ts, *columns):
    return rows(state_after(world, run_ts).watermark, *columns)


def test_first_and_second_run(world):
    world.publish("A", [f"v{i:03}" for i in range(120)])
    first = world.run(R1)
    assert len(ids(first)) == 120 and first.videos.select("channel_name").distinct().first()[0] == "name of A"
    assert first.videos.select("duration").distinct().count() == 50  # one per position on a page, not one per batch
    assert first.videos.columns == VIDEO_DETAILS.names and first.channels.columns == CHANNEL_STATS.names
    assert (audit(first)["found"], audit(first)["new"], audit(first)["retrieved"]) == (120, 120, 120)
    second = world.run(R2)
    assert ids(second) == [] and second.videos.columns == VIDEO_DETAILS.names
    assert rows(second.channels, "channel_id", "subscribers", "total_views", "video_count") == [("A", 7, 8, 0)]
    assert marks(world, R2, "channel_id", "last_fetch_ts") == [("A", R2)]


def test_time_boundary(world):
    world.publish("A", ["old"])
    world.publish("A", ["seen"], start=R1 - timedelta(minutes=5))
    world.run(R1)
    world.publish("A", ["boundary"], start=R1 - timedelta(minutes=5))
    world.publish("A", ["late"], start=R1 - timedelta(hours=2))
    second = world.run(R2)
    assert ids(second) == ["boundary"]
    assert rows(second.late, "video_id") == [("late",)]
    assert (audit(second)["found"], audit(second)["cached"], audit(second)["new"]) == (2, 1, 1)


def test_burst_beyond_one_page(world):
    world.publish("A", ["old"])
    world.run(R1)
    world.publish("A", [f"n{i}" for i in range(70)], start=R1)
    assert len(ids(world.run(R2))) == 70


def test_cap_is_worked_off(world):
    world.publish("A", [f"v{i:03}" for i in range(25)])
    first = world.run(R1, cap=10)
    assert ids(first) == [f"v{i:03}" for i in range(15, 25)]
    assert len(open_rows(world, R1)) == 15
    world.publish("A", ["new"], start=R1)
    assert ids(world.run(R2, cap=10)) == [f"v{i:03}" for i in range(5, 15)]
    assert ids(world.run(R3, cap=10)) == ["new", *[f"v{i:03}" for i in range(5)]]
    assert open_rows(world, R3) == []


def test_vanished_details_are_retried_then_given_up(world):
    world.publish("A", ["v1", "gone"])
    world.hidden.add("gone")
    assert ids(world.run(R1, max_attempts=2)) == ["v1"]
    assert open_rows(world, R1) == [("gone", "missing", 1)]
    assert ids(world.run(R2, max_attempts=2)) == []
    assert open_rows(world, R2) == []
    done = world.store.load(world.spark, R3).done
    assert rows(done, "video_id", "status", "attempts") == [("gone", "missing", 2), ("v1", "fetched", 1)]


def test_vanished_details_come_back(world):
    world.publish("A", ["v1", "gone"])
    world.hidden.add("gone")
    world.run(R1)
    world.hidden.clear()
    assert ids(world.run(R2)) == ["gone"]


def test_bad_channel_is_isolated(world):
    for channel in "ABC":
        world.publish(channel, [f"{channel}1"])
    world.broken.add("B")
    first = world.run(R1)
    assert ids(first) == ["A1", "C1"]
    assert rows(first.channels, "channel_id") == [("A",), ("C",)]
    assert (audit(first, "B")["status"], audit(first, "B")["error"]) == ("failed", "corrupt response")
    assert audit(first, "A")["status"] == "ok"
    assert rows(first.quarantine, "channel_id", "source") == [("B", "search")]
    assert marks(world, R1, "channel_id") == [("A",), ("C",)]
    world.broken.clear()
    assert ids(world.run(R2)) == ["B1"]


@pytest.mark.parametrize("kind", ["channels", "search", "videos"])
def test_unreadable_file_costs_its_channel_and_no_other(world, kind):
    for channel in "ABCD":
        world.publish(channel, [f"{channel}1"])
    landing = world.land()
    for channel in "BD":
        whole = Path(landing) / kind / f"{kind}__{channel}__p0.json"
        packed = gzip.compress(whole.read_bytes())
        whole.with_name(f"a b%{whole.name}.gz").write_bytes(packed[: len(packed) // 2])
        whole.unlink()
    first = world.run(R1, landing=landing)
    assert ids(first) == ["A1", "C1"]
    assert (audit(first, "B")["status"], audit(first, "B")["error"]) == ("failed", "unreadable file")
    assert rows(first.quarantine, "channel_id", "source", "reason") == [(c, kind, "unreadable file") for c in "BD"]
    assert marks(world, R1, "channel_id") == [("A",), ("C",)]
    assert ids(world.run(R2)) == ["B1", "D1"]


def test_unreadable_file_of_nobody_blocks_who_lacks_an_answer(world):
    for channel in "AB":
        world.publish(channel, [f"{channel}1"])
    landing = world.land()
    lost = Path(landing) / "search" / "search__B__p0.json"
    lost.with_name("many.json.gz").write_bytes(b"no archive")
    lost.unlink()
    first = world.run(R1, landing=landing)
    assert ids(first) == ["A1"] and audit(first, "B")["error"] == "incomplete answer"
    assert rows(first.quarantine, "channel_id", "reason", "detail") == [(None, "unreadable file", "many.json.gz")]


def test_unreadable_files_are_all_found_and_other_errors_raised(spark, tmp_path, monkeypatch):
    bad = set()
    for i in range(30):
        file = tmp_path / "in" / str(i % 3) / f"f {i}.json.gz"
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_bytes(gzip.compress(b"{}\n" * 50)[: None if i % 4 else 12])
        if i % 4 == 0:
            bad.add(file.name)
    folder = str(tmp_path / "in")
    assert {Path(unquote(p)).name for p in isolation.unreadable_files(spark, folder)} == bad
    read = lambda without: spark.read.schema("a int").option("recursiveFileLookup", "true").json(folder).where(isolation.not_among(without)).collect()
    assert len(isolation.isolated(spark, folder, read)) == 22 * 50
    monkeypatch.setattr(isolation, "MOST_UNREADABLE", 3)
    with pytest.raises(RuntimeError, match="more than 3"):
        isolation.unreadable_files(spark, folder)
    with pytest.raises(AnalysisException):
        isolation.isolated(spark, folder, lambda _: spark.range(1).select("nothing"))


def test_failed_channel_keeps_its_state(world):
    world.publish("A", [f"v{i}" for i in range(3)])
    world.run(R1, cap=2)
    world.broken.add("A")
    assert ids(world.run(R2, cap=2)) == []
    assert open_rows(world, R2) == [("v0", "pending", 0)]
    assert marks(world, R2, "last_fetch_ts") == [(R1,)]
    world.broken.clear()
    assert ids(world.run(R3, cap=2)) == ["v0"]


def test_crash_and_repeat(world, monkeypatch):
    world.publish("A", [f"v{i}" for i in range(5)])
    world.run(R1, cap=2)
    landing = world.land()

    def crash(*args):
        raise RuntimeError("lost driver")

    with monkeypatch.context() as patch:
        patch.setattr(RunStore, "commit", crash)
        with pytest.raises(RuntimeError):
            world.run(R2, landing=landing, cap=2)
    # The uncommitted run is invisible, whether the same stamp is repeated or a later one runs.
    assert len(rows(world.store.table(world.spark, "video_details"))) == 2
    assert ids(world.run(R3, landing=landing, cap=2)) == ["v1", "v2"]
    assert ids(world.run(R3, landing=landing, cap=2)) == ["v1", "v2"]
    assert ids(world.run(R4, landing=landing, cap=2)) == ["v0"]
    assert len(rows(world.store.table(world.spark, "video_details"))) == 5
    assert rows(world.store.load(world.spark, datetime(2027, 1, 1)).done, "video_id") == [(f"v{i}",) for i in range(5)]


def test_full_mode_takes_everything_again(world):
    world.publish("A", [f"v{i}" for i in range(5)])
    world.run(R1)
    assert len(ids(world.run(R2, incremental=False))) == 5
    assert len(ids(world.run(R2, incremental=False))) == 5
    assert len(rows(world.store.load(world.spark, R3).done)) == 5
    assert ids(world.run(R3)) == []


def test_refresh_takes_listed_ids_again(world):
    world.publish("A", ["v1", "v2"])
    world.run(R1)
    asked = world.spark.createDataFrame([("A", "v1"), ("other", "v2")], "channel_id string, video_id string")
    assert ids(world.run(R2, refresh=asked)) == ["v1"]
    silver = silver_videos(world.store.table(world.spark, "video_details"))
    assert rows(silver, "video_id", "run") == [("v1", "20260102_030000"), ("v2", "20260102_000000")]


def test_clear_state(world):
    for channel in "AB":
        world.publish(channel, [f"{channel}{i}" for i in range(2)])
    assert world.store.clear(world.spark, R1 - timedelta(hours=1)) is False
    world.run(R1)
    only_a = world.spark.createDataFrame([("A",)], "channel_id string")
    assert world.store.clear(world.spark, R2, only_a) is True
    assert ids(world.run(R3)) == ["A0", "A1"]
    assert world.store.clear(world.spark, R4) is True
    assert ids(world.run(R4 + timedelta(hours=3))) == ["A0", "A1", "B0", "B1"]


def test_compacted_state_is_the_same_state(world):
    world.publish("A", [f"v{i}" for i in range(4)])
    world.run(R1, cap=2)
    world.run(R2, cap=1)
    before = world.store.load(world.spark, R3)
    expected = [rows(before.done, "video_id"), rows(before.open, "video_id"), rows(before.watermark, "last_fetch_ts")]
    assert world.store.compact(world.spark, R3) is True
    after = world.store.load(world.spark, R4)
    assert after.epoch == before.epoch + 1
    assert [rows(after.done, "video_id"), rows(after.open, "video_id"), rows(after.watermark, "last_fetch_ts")] == expected
    with pytest.raises(ValueError):
        world.store.clear(world.spark, R3)
    assert ids(world.run(R4)) == ["v0"]


def written(world, table, run_ts):
    return world.store.run(world.spark, table, run_ts).count()


@pytest.mark.parametrize("base_runs", [1, 2, 100])
def test_a_run_writes_what_it_changes(world, base_runs):
    world.publish("A", [f"v{i:03}" for i in range(30)])
    world.publish("B", ["w"])
    world.hidden.add("v029")
    options = {"cap": 10, "base_runs": base_runs}
    world.run(R1, **options)
    assert written(world, "open", R1) == 21  # 20 that wait and the one without details
    world.broken.add("A")
    world.run(R2, **options)
    assert (written(world, "open", R2), written(world, "watermark", R2)) == (0, 1)
    assert len(open_rows(world, R2)) == 21
    world.broken.clear()
    world.run(R3, **options)
    assert written(world, "open", R3) == 10  # nine leave the backlog, one is tried again
    assert len(open_rows(world, R3)) == 12 and ("v029", "missing", 2) in open_rows(world, R3)
    snapshots = [r for r in (R1, R2, R3) if written(world, "open_base", r)]
    assert snapshots == {1: [R1, R2, R3], 2: [R2], 100: []}[base_runs]
    assert state_after(world, R3).since == {1: 0, 2: 1, 100: 3}[base_runs]
    # A repeated run builds on the state before it, whichever snapshot that has.
    before = open_rows(world, R3)
    world.run(R3, **options)
    assert open_rows(world, R3) == before and marks(world, R3, "channel_id", "last_fetch_ts") == [("A", R3), ("B", R3)]


def test_clearing_writes_a_row_a_channel_and_compacting_drops_what_it_hides(world):
    for channel in "ABC":
        world.publish(channel, [f"{channel}{i}" for i in range(4)])
    world.run(R1, cap=2)
    folders = sorted(p.name for p in (world.base / "store" / "done").rglob("run=*"))
    named = world.spark.createDataFrame([("A",), ("A",), ("C",), (None,)], "channel_id string")
    assert world.store.clear(world.spark, R2, named) is True
    assert rows(world.store.run(world.spark, "cleared", R2)) == [("A",), ("C",)]
    assert sorted(p.name for p in (world.base / "store" / "done").rglob("run=*")) == folders
    left = state_after(world, R2)
    assert rows(left.done, "video_id") == [("B2",), ("B3",)] and rows(left.open, "video_id") == [("B0",), ("B1",)]
    assert rows(left.watermark, "channel_id") == [("B",)]
    world.publish("C", ["C9"], start=R1)
    assert ids(world.run(R3, cap=2)) == ["A2", "A3", "B0", "B1", "C3", "C9"]
    assert world.store.compact(world.spark, R4) is True
    kept = state_after(world, R4)
    assert [v for (v,) in rows(kept.done, "video_id")] == ["A2", "A3", "B0", "B1", "B2", "B3", "C3", "C9"]
    assert kept.since == 0 and rows(kept.open, "video_id") == [("A0",), ("A1",), ("C0",), ("C1",), ("C2",)]
    assert world.store.clear(world.spark, R4 + timedelta(hours=1)) is True
    empty = state_after(world, R4 + timedelta(hours=1))
    assert [rows(empty.done), rows(empty.open), rows(empty.watermark)] == [[], [], []]


def test_summary_of_a_run(world):
    """The totals observed while the audit is written are those of the audit, and stay with the commit."""
    world.publish("A", [f"v{i}" for i in range(60)])
    for channel in "BC":
        world.publish(channel, [channel])
    world.broken.add("C")
    first = world.run(R1, cap=50)
    assert first.summary == {
        "channels": 2, "failed_channels": 1, "found": 61, "cached": 0, "selected": 51, "videos": 51, "alerts": 1, "calls_saved": 0, "quota_units": 257,
    }
    second = world.run(R2, cap=50, min_videos=5, lookback_minutes=10**6)
    assert (second.summary["cached"], second.summary["videos"], second.summary["alerts"], second.summary["calls_saved"]) == (61, 10, 2, 3)
    assert world.store.clear(world.spark, R3) is True
    kept = world.store.summaries(world.spark)
    assert rows(kept, "run_ts", "videos", "alerts") == [(R1, 51, 1), (R2, 10, 2)]
    from_audit = second.audit.agg(*[c.alias(n) for n, c in summary_metrics(5).items()]).first().asDict()
    assert from_audit == second.summary


def test_imported_documents(world, tmp_path):
    world.publish("A", ["v1"])
    world.publish("A", ["v2"], start=R1 + timedelta(minutes=1))
    folder = tmp_path / "cache"
    folder.mkdir()
    state = {"last_fetch_time": "2026-01-02T00:00:00.000001+00:00Z", "video_ids": ["v1"], "updated_at": "x"}
    (folder / "channel_A_cache.json").write_text(json.dumps(state, indent=2))
    (folder / "channel_B_cache.json").write_text("{oops")
    assert rows(import_state(world.spark, str(folder), world.store, R1)) == [("B",)]
    assert ids(world.run(R2)) == ["v2"]


def test_published_tables(world, tmp_path):
    world.publish("A", ["v1", "v2"])
    world.publish("B", ["w1"])
    world.run(R1)
    world.names["A"] = "renamed"
    world.publish("A", ["v3"], start=R1 + timedelta(days=1))
    world.run(R2)
    publish(world.spark, world.store, str(tmp_path / "out"))

    def table(name):
        return world.spark.read.parquet(str(tmp_path / "out" / name))

    assert rows(table("silver_videos"), "video_id", "channel_name") == [
        ("v1", "name of A"), ("v2", "name of A"), ("v3", "renamed"), ("w1", "name of B")
    ]
    assert rows(table("gold_by_channel"), "channel_id", "videos", "views") == [("A", 3, 3), ("B", 1, 1)]
    assert rows(table("gold_by_day"), "videos") == [(1,), (3,)]
    assert rows(table("channel_growth"), "channel_id", "run", "subscribers") == [
        (c, r, 7) for c in "AB" for r in ("20260102_000000", "20260102_030000")
    ]
    assert rows(table("channel_names"), "channel_id", "version", "channel_name") == [
        ("A", 1, "name of A"), ("A", 2, "renamed"), ("B", 1, "name of B")
    ]
    assert {r["violations"] for r in table("dq_report").collect()} == {0}


def test_imported_state(world):
    world.publish("A", ["v1"])
    world.publish("A", ["v2"], start=R1 + timedelta(minutes=1))
    taken = world.spark.createDataFrame([("A", "v1")], "channel_id string, video_id string")
    marks = world.spark.createDataFrame([("A", R1, R1)], "channel_id string, last_fetch_ts timestamp, updated_at timestamp")
    world.store.seed(world.spark, R1, taken, marks)
    assert ids(world.run(R2)) == ["v2"]


def test_unusable_import_timestamp_means_first_run(world):
    world.publish("A", ["v1", "v2"])
    taken = world.spark.createDataFrame([("A", "v1")], "channel_id string, video_id string")
    marks = world.spark.createDataFrame([("A", None, None)], "channel_id string, last_fetch_ts timestamp, updated_at timestamp")
    world.store.seed(world.spark, R1, taken, marks)
    assert ids(world.run(R2)) == ["v2"]


def test_missing_channel_list_runs_nothing(world, spark, tmp_path):
    conf = RunConf(str(tmp_path), str(tmp_path / "store"), str(tmp_path / "no.csv"), R1)
    result = run_job(spark, conf)
    assert not result.ran and result.videos.count() == 0 and result.videos.columns == VIDEO_DETAILS.names
    assert not (tmp_path / "store").exists()


def test_export(world, tmp_path):
    world.publish("A", ["v1"])
    export = tmp_path / "export"
    for _ in range(2):
        assert world.run(R1, save="both", export=str(export)).export == "ok"
    hour = export / "video_details/year=2026/month=01/day=02/hour=00"
    assert [p.name for p in hour.iterdir() if p.suffix != ".crc"] == ["video_details_20260102_000000.csv"]
    exported = read_bronze(world.spark, str(export), VIDEO_DETAILS, "video_details_*.csv")
    assert rows(exported, "video_id", "run_ts") == [("v1", R1)]
    assert rows(world.store.table(world.spark, "video_details"), "video_id") == [("v1",)]
    assert world.run(R2, save="both").export == "skipped"
    assert world.run(R3, save="csv", upload=False, export=str(export)).export == "skipped"
    for wrong in ({"save": "delta"}, {"catalog_mode": "merge"}):
        with pytest.raises(ValueError):
            world.conf("x", R1, **wrong)


def test_csv_alone_leaves_no_table(world, tmp_path):
    world.publish("A", ["v1", "v2"])
    export = str(tmp_path / "export")
    for _ in range(2):
        first = world.run(R1, save="csv", export=export)
        assert ids(first) == ["v1", "v2"] and rows(first.channels, "channel_id", "subscribers") == [("A", 7)]
        assert first.videos.schema == VIDEO_DETAILS and first.summary["videos"] == 2
    for table in ("video_details", "channel_stats"):
        assert rows(world.store.table(world.spark, table)) == []
    world.publish("A", ["v3"], start=R1)
    # Without a place for the files the tables are kept.
    assert ids(world.run(R2, save="csv")) == ["v3"]
    assert rows(world.store.table(world.spark, "video_details"), "video_id") == [("v3",)]


def test_tables_of_the_catalog(world):
    world.publish("A", ["v1"])
    world.run(R1, catalog="of_runs_")
    world.publish("A", ["v2"], start=R1)
    for _ in range(2):
        world.run(R2, catalog="of_runs_")
    table = world.spark.table("of_runs_video_details")
    assert rows(table, "video_id", "run") == [("v1", "20260102_000000"), ("v2", "20260102_030000")]
    assert len(rows(world.spark.table("of_runs_channel_stats"))) == 2
    world.run(R3, catalog="newest_", catalog_mode="overwrite")
    assert world.spark.table("newest_channel_stats").columns == CHANNEL_STATS.names
    with pytest.raises(AnalysisException):
        world.run(R4, catalog="newest_", catalog_mode="error")
    assert marks(world, R4, "last_fetch_ts") == [(R3,)]


def test_duplicate_results_count_once(world):
    world.publish("A", ["v1", "v2"])
    landing = world.land()
    page = Path(landing) / "search" / "search__A__p0.json"
    (page.parent / "search__A__p1.json").write_text(page.read_text())
    result = world.run(R1, landing=landing)
    assert ids(result) == ["v1", "v2"] and audit(result)["found"] == 2


@settings(max_examples=3, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.sampled_from("AB"), st.integers(0, 2), st.integers(-20, 150), st.booleans()), min_size=3, max_size=12),
    st.integers(1, 4),
)
def test_no_id_is_lost_or_taken_twice(spark, tmp_path_factory, plan, cap):
    """Videos appear before random runs at random publish times, some without details."""
    world = World(spark, tmp_path_factory.mktemp("world"))
    world.names = {"A": "a", "B": "b"}
    runs, fetched, offered = (R1, R2, R3), set(), set()
    for step, run_ts in enumerate(runs):
        for n, (channel, appears, minutes, hidden) in enumerate(plan):
            if appears == step:
                published = R1 + timedelta(hours=3 * (step - 1), minutes=minutes)
                world.videos.setdefault(channel, {})[f"{channel}{n}"] = published
                offered |= {f"{channel}{n}"} if step == 0 or published > runs[step - 1] - timedelta(minutes=10) else set()
                if hidden:
                    world.hidden.add(f"{channel}{n}")
        result = world.run(run_ts, cap=cap)
        got = ids(result)
        assert len(got) == len(set(got)) and not fetched & set(got) and not world.hidden & set(got)
        fetched |= set(got)
        for row in result.audit.collect():
            assert row["found"] == row["cached"] + row["new"] and row["retrieved"] <= row["selected"] <= cap
        state = world.store.load(spark, datetime(2027, 1, 1))
        done, waiting = ([v for (v,) in rows(part, "video_id")] for part in (state.done, state.open))
        assert len(done + waiting) == len(set(done + waiting))
        # Everything ever offered inside its bound is either taken or waiting; nothing else is.
        assert set(done + waiting) == offered and fetched == set(done) - world.hidden


def _page(landing, channel, page):
    return Path(landing) / "search" / f"search__{channel}__p{page}.json"


def test_no_search_answer_moves_nothing(world):
    world.publish("A", ["v1", "v2"])
    landing = world.land()
    _page(landing, "A", 0).unlink()
    first = world.run(R1, landing=landing)
    assert ids(first) == [] and (audit(first)["status"], audit(first)["error"]) == ("failed", "incomplete answer")
    second = world.run(R2)
    assert ids(second) == ["v1", "v2"] and rows(second.late) == []


def test_missing_page_moves_nothing(world):
    world.publish("A", [f"v{i:02}" for i in range(70)])
    landing = world.land()
    _page(landing, "A", 1).unlink()
    first = _page(landing, "A", 0)
    first.write_text(json.dumps(json.loads(first.read_text()) | {"nextPageToken": "x"}))
    assert ids(world.run(R1, landing=landing)) == []
    assert len(ids(world.run(R2))) == 70


def test_gap_in_pages_moves_nothing_unless_the_first_is_all(world):
    world.publish("A", [f"v{i:03}" for i in range(120)])
    landing = world.land()
    _page(landing, "A", 1).unlink()
    assert ids(world.run(R1, landing=landing)) == []
    assert len(ids(world.run(R2, landing=landing, first_page_only=True))) == 70  # two pages are there


def test_response_of_nobody_blocks_who_lacks_an_answer(world):
    world.publish("A", ["v1"])
    world.publish("B", ["w1"])
    landing = world.land()
    page = _page(landing, "B", 0)
    page.unlink()
    (page.parent / "nobody.json").write_text('{"items": [{"id"')
    first = world.run(R1, landing=landing)
    assert ids(first) == ["v1"] and audit(first, "A")["status"] == "ok" and audit(first, "B")["status"] == "failed"
    assert ids(world.run(R2)) == ["w1"]


def test_runs_come_in_order(world):
    world.publish("A", [f"v{i}" for i in range(4)])
    world.run(R1, cap=2)
    world.run(R2, cap=1)
    with pytest.raises(ValueError, match="comes before"):
        world.run(R1, cap=2)
    with pytest.raises(ValueError, match="within the second"):
        world.run(R2 + timedelta(microseconds=5))
    assert ids(world.run(R2, cap=1)) == ["v1"]
    assert ids(world.run(R3)) == ["v0"]


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata"])
def test_run_time_is_utc_wherever_the_driver_runs(world, monkeypatch, zone):
    import time

    monkeypatch.setenv("TZ", zone)
    time.tzset()
    try:
        world.publish("A", ["v1"])
        world.run(R1)
        marks = state_after(world, R1).watermark
        assert [r[0] for r in marks.selectExpr("date_format(last_fetch_ts, 'yyyyMMdd_HHmmss')").collect()] == ["20260102_000000"]
        world.publish("A", ["v2"], start=R1 + timedelta(hours=1))
        assert ids(world.run(R2)) == ["v2"]
    finally:
        monkeypatch.undo()
        time.tzset()


def test_seeding_needs_an_empty_store(world):
    world.publish("A", ["v1"])
    world.run(R1)
    taken = world.spark.createDataFrame([("A", "v1")], "channel_id string, video_id string")
    marks = state_after(world, R1).watermark
    with pytest.raises(ValueError, match="state of its own"):
        world.store.seed(world.spark, R2, taken, marks)


def test_given_up_ids_are_reported_and_can_be_asked_for(world):
    world.publish("A", ["v1", "gone"])
    world.hidden.add("gone")
    world.run(R1, max_attempts=2)
    assert rows(world.run(R2, max_attempts=2).given_up, "video_id", "attempts") == [("gone", 2)]
    world.hidden.clear()
    asked = world.spark.createDataFrame([("A", "gone")], "channel_id string, video_id string")
    assert ids(world.run(R3, refresh=asked)) == ["gone"]


def test_full_run_with_a_cap_leaves_no_duplicates(world):
    world.publish("A", [f"v{i}" for i in range(4)])
    world.run(R1)
    world.run(R2, incremental=False, cap=2)
    world.run(R3)
    done = [v for (v,) in rows(world.store.load(world.spark, R4).done, "video_id")]
    assert done == [f"v{i}" for i in range(4)]


def test_export_without_upload_and_failed_export(world, tmp_path):
    world.publish("A", ["v1"])
    export = tmp_path / "export"
    assert world.run(R1, save="csv", upload=False, export=str(export)).export == "skipped"
    assert list(export.rglob("video_details_20260102_000000.csv"))
    (tmp_path / "file").write_text("x")
    with pytest.warns(UserWarning):
        assert world.run(R2, save="csv", export=str(tmp_path / "file" / "below")).export == "failed"
    assert marks(world, R2, "last_fetch_ts") == [(R2,)]
    assert not list((tmp_path / "store" / "staging").glob("*/*"))
