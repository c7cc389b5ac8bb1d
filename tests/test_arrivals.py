"""Runs that arriving deliveries start: once each, whenever the driver dies."""

from datetime import timedelta
from pathlib import Path

import pytest
from conftest import rows
from test_runs import R1, R2, World, audit

from freshet.plans.store import RunStore
from freshet.streaming import arrivals as feed


class Arrivals(World):
    def deliver(self, fetched=None):
        folder = Path(self.land())
        folder.joinpath(feed.READY).write_text("{}" if fetched is None else f'{{"fetched_at": "{fetched.isoformat()}Z"}}')

    def drain(self, checkpoint="checkpoint", **options):
        return list(feed.run_arrivals(self.spark, str(self.base), str(self.base / checkpoint), self.conf("", R1, **options)))

    def taken(self):
        return rows(self.store.table(self.spark, "video_details"), "video_id", "run")


@pytest.fixture
def world(spark, tmp_path):
    return Arrivals(spark, tmp_path)


def stamps(world):
    return rows(feed.arrivals(world.spark, world.store), "run")


def test_each_delivery_is_one_run(world):
    world.publish("A", ["v1"])
    assert world.drain() == []
    world.deliver(R1)
    world.publish("A", ["v2"], start=R1)
    world.deliver(R2)
    assert world.drain() == [R1, R2]
    assert [v for v, _ in world.taken()] == ["v1", "v2"]
    assert world.drain() == [] and len(stamps(world)) == 2


def test_lost_between_rows_and_commit(world, monkeypatch):
    world.publish("A", ["v1", "v2"])
    world.deliver(R1)

    def lost(*_):
        raise RuntimeError("lost driver")

    with monkeypatch.context() as patch:
        patch.setattr(RunStore, "commit", lost)
        with pytest.raises(Exception, match="lost driver"):
            world.drain()
    assert world.taken() == [] and len(stamps(world)) == 1
    world.publish("A", ["v3"], start=R1)
    world.deliver(R2)
    assert world.drain() == [R1, R2]
    assert [v for v, _ in world.taken()] == ["v1", "v2", "v3"]
    assert len(stamps(world)) == 2


def test_lost_between_commit_and_the_streams_own(world, monkeypatch):
    world.publish("A", ["v1"])
    world.deliver(R1)
    with monkeypatch.context() as patch:
        run = feed.run_job

        def dying(*args):
            run(*args)
            raise RuntimeError("lost driver")

        patch.setattr(feed, "run_job", dying)
        with pytest.raises(Exception, match="lost driver"):
            world.drain()
    before = world.taken()
    assert world.drain() == [] and world.taken() == before != []


def test_lost_checkpoint_repeats_no_run(world):
    world.publish("A", ["v1"])
    world.deliver(R1)
    world.drain()
    world.publish("A", ["v2"], start=R1)
    world.deliver(R2)
    # The first delivery comes again, before the second: its run is committed.
    assert world.drain("another") == [R2]
    assert world.drain("a third") == []
    assert len(world.taken()) == 2


def test_run_in_between_moves_an_unfinished_delivery_behind_it(world, monkeypatch):
    world.publish("A", ["v1"])
    world.deliver(R1)
    with monkeypatch.context() as patch:
        patch.setattr(RunStore, "commit", lambda *_: 1 / 0)
        with pytest.raises(Exception, match="division"):
            world.drain()
    world.publish("A", ["v2"])
    world.run(R2)
    assert world.drain() == [R2 + timedelta(seconds=1)]
    assert [v for v, _ in world.taken()] == ["v1", "v2"] and world.drain("another") == []


def test_times_that_clash_or_run_backwards_are_moved_behind(world):
    for n, fetched in enumerate((R2, R2, R1)):
        world.publish("A", [f"v{n}"], start=R2)
        world.deliver(fetched)
    assert world.drain() == [R2, R2 + timedelta(seconds=1), R2 + timedelta(seconds=2)]
    assert [v for v, _ in world.taken()] == ["v0", "v1", "v2"]


def test_without_a_time_the_files_own_counts(world):
    world.publish("A", ["v1"])
    world.deliver()
    (run_ts,) = world.drain()
    assert run_ts.year >= 2024
    assert audit(world.run(run_ts + timedelta(hours=1)))["new"] == 0
