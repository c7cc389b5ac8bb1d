"""Published tables, carried forward, against tables built anew."""

import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from conftest import rows

from freshet.plans import publish as P
from freshet.plans.store import RunStore, stamp_of
from freshet.schemas import CHANNEL_STATS, VIDEO_DETAILS

START = datetime(2026, 3, 1)
COLUMNS = {
    "silver_videos": ("video_id", "title", "view_count", "like_count", "category_id", "channel_name", "run"),
    "gold_by_channel": ("channel_id", "videos", "views", "avg_duration", "engagement"),
    "gold_by_category": ("category_id", "videos", "views", "avg_duration", "engagement"),
    "gold_by_language": ("language", "videos", "views", "avg_duration", "engagement"),
    "gold_by_day": ("published_day", "videos", "views", "avg_duration", "engagement"),
    "channel_growth": ("channel_id", "run", "subscribers", "subscribers_delta", "total_views_delta", "video_count_delta"),
    "channel_names": ("channel_id", "version", "channel_name", "valid_from", "valid_to"),
    "dq_report": ("rule", "violations"),
}


class Runs:
    """Committed runs written straight into a store."""

    def __init__(self, spark, base, seed=0):
        self.spark, self.base, self.draw, self.n = spark, base, random.Random(seed), 0
        self.store = RunStore(str(base / "store"))

    def commit(self, videos, stats, run_ts=None):
        self.n += run_ts is None
        run_ts = run_ts or START + timedelta(hours=self.n)
        self.store.write(self.spark.createDataFrame(videos, VIDEO_DETAILS), "video_details", run_ts)
        self.store.write(self.spark.createDataFrame(stats, CHANNEL_STATS), "channel_stats", run_ts)
        self.store.commit(self.spark, 0, run_ts)
        return run_ts

    def video(self, i):
        pick = self.draw.choice
        day = (START - timedelta(days=self.draw.randrange(3))).isoformat() if self.draw.random() < 0.9 else "never"
        channel = f"c{i % 5}"
        return (f"v{i}", pick(["t", None]), day, pick([0, 5, 9, None]), pick([1, -1, None]), 2, self.draw.randrange(100), pick(["a,b", "", None]), pick(["x", "y", None]), pick(["en", "fr", ""]), channel, f"name of {channel}")

    def random(self, run_ts=None):
        ids = self.draw.sample(range(60), self.draw.randrange(0, 15))
        stats = [(f"c{c}", self.draw.choice(["old", "new", None]), self.draw.randrange(9), 3, 4) for c in range(5) if self.draw.random() < 0.7]
        return self.commit([self.video(i) for i in ids], stats, run_ts)

    def published(self, target):
        return {name: rows_of(self.spark.read.parquet(str(self.base / target / name)).select(*columns)) for name, columns in COLUMNS.items()}

    def publish(self, target="out", buckets=8):
        return P.publish(self.spark, self.store, str(self.base / target), buckets)


def rows_of(df):
    return sorted((tuple(str(v) for v in r) for r in df.collect()))


@pytest.fixture
def runs(spark, tmp_path):
    return Runs(spark, tmp_path)


def test_equal_to_a_full_build_over_random_runs(runs):
    for n in range(20):
        runs.random()
        if n in (0, 1, 7, 19):
            (step,) = runs.publish()
            assert (step.base == 0) == (n == 0)
    assert runs.publish() == []
    runs.publish("anew")
    assert runs.published("out") == runs.published("anew")
    names = {r for r in runs.published("out")["channel_names"]}
    assert any(v[4] != "None" for v in names)


def files(base):
    return {str(p.relative_to(base)): p.stat().st_mtime_ns for p in base.rglob("part-*")}


def test_only_touched_buckets_are_rewritten_and_new_runs_read(runs, monkeypatch):
    runs.commit([runs.video(i) for i in range(40)], [("c0", "one", 1, 1, 1)])
    runs.publish()
    silver = runs.base / "out" / "silver_videos"
    before = files(silver)
    second = runs.commit([runs.video(3), runs.video(100)], [("c0", "two", 2, 2, 2)])
    plans = {}
    for name in ("fresh", "replaced"):

        def kept(self, *args, original=getattr(P.Published, name), name=name):
            out = original(self, *args)
            plans[name] = out
            return out

        monkeypatch.setattr(P.Published, name, kept)
    runs.publish()
    bucket = {r["video_id"]: r["bucket"] for r in runs.spark.read.parquet(str(silver)).select("video_id", "bucket").collect()}
    after = files(silver)
    gone = {name for name in before if after.get(name) != before[name]}
    assert gone and {name.split("/")[0] for name in gone} == {f"bucket={bucket['v3']}"}
    assert len(bucket) == 41
    text = plans["fresh"]._jdf.queryExecution().executedPlan().toString()
    assert "(run#" in text and stamp_of(START + timedelta(hours=1)) in text and stamp_of(second) in text
    text = plans["replaced"]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket#" in text.replace("isnotnull", "") or "bucket#" in text.split("PartitionFilters")[1]


@pytest.mark.parametrize("crash", ["_note", "_apply_silver", "_apply_names"])
def test_lost_on_the_way(runs, monkeypatch, crash):
    """Whatever was done when the driver died, the next publish ends where one without a loss ends."""
    runs.random()
    runs.publish()
    runs.random()
    runs.random()
    with monkeypatch.context() as patch:
        original = getattr(P.Published, crash)

        def dying(self, *args):
            original(self, *args)
            raise RuntimeError("lost driver")

        patch.setattr(P.Published, crash, dying)
        with pytest.raises(RuntimeError, match="lost driver"):
            runs.publish()
    runs.random()
    runs.publish()
    assert runs.publish() == []
    runs.publish("anew")
    assert runs.published("out") == runs.published("anew")


@pytest.mark.parametrize("crash", [None, "_undo_appended", "_apply_silver"])
def test_repeated_run_undoes_its_publish(runs, monkeypatch, crash):
    runs.random()
    runs.random()
    runs.publish()
    last = runs.random()
    runs.publish()
    runs.store.withdraw(runs.spark, last)
    (step,) = runs.publish()
    assert (step.base, step.undo) == (1, 2)
    runs.publish("without")
    assert runs.published("out") == runs.published("without")
    runs.random(run_ts=last)
    runs.publish()
    runs.random(run_ts=last)
    if crash:
        with monkeypatch.context() as patch:
            original = getattr(P.Published, crash)

            def dying(self, *args):
                original(self, *args)
                raise RuntimeError("lost driver")

            patch.setattr(P.Published, crash, dying)
            with pytest.raises(RuntimeError, match="lost driver"):
                runs.publish()
    runs.publish()
    runs.publish("anew")
    assert runs.published("out") == runs.published("anew")


def test_nothing_committed(runs):
    assert runs.publish() == []
