"""What sweeping removes and what it must not."""

from datetime import datetime, timedelta

import pytest
from conftest import rows
from test_runs import R1, R2, World

from freshet.plans.publish import publish
from freshet.plans.retention import sweep, sweepable
from freshet.plans.store import RunStore


@pytest.fixture(scope="module")
def swept(spark, tmp_path_factory):
    """Six runs, a clearing, a compaction and two runs more; then one that died, and a sweep."""
    world = World(spark, tmp_path_factory.mktemp("retention"))
    hours = [R1 + timedelta(hours=n) for n in range(9)]
    for channel in "AB":
        world.publish(channel, [f"{channel}{i}" for i in range(6)])
    for n in range(4):
        world.run(hours[n], cap=1, base_runs=2)
    world.store.clear(spark, hours[4], spark.createDataFrame([("B",)], "channel_id string"))
    publish(spark, world.store, str(world.base / "out"))
    world.store.compact(spark, hours[5])
    reader = world.store.load(spark, hours[5] + timedelta(seconds=1))
    dead = hours[5] + timedelta(minutes=1)
    world.store.write(reader.open.selectExpr("*", "false as closed"), "open", dead)
    world.store.stage(reader.done, "rows", dead)
    world.run(hours[6], cap=1, base_runs=2)
    publish(spark, world.store, str(world.base / "out"))
    before = facts(world.store.load(spark, datetime(2027, 1, 1)))
    in_flight = world.store.load(spark, hours[5] + timedelta(seconds=1))
    untouched = sweepable(spark, world.store, keep=100)
    gone = sweep(spark, world.store, before=hours[8], keep=2, targets=[str(world.base / "out")])
    return world, hours, before, in_flight, untouched, {g.split("/store/")[1] for g in gone}


def facts(state):
    return [rows(state.done, "video_id"), rows(state.open, "video_id", "attempts"), rows(state.watermark, "channel_id", "last_fetch_ts")]


def names(hours, table):
    return [f"{table}/run={h:%Y%m%d_%H%M%S}" for h in hours]


def test_state_is_the_same(swept):
    world, _, before, in_flight, _, _ = swept
    assert facts(world.store.load(world.spark, datetime(2027, 1, 1))) == before
    assert len(rows(in_flight.done, "video_id")) == 4 and len(rows(in_flight.open)) == 2


def test_everything_unreachable_goes(swept):
    _, hours, _, _, untouched, gone = swept
    dead = hours[5] + timedelta(minutes=1)
    wanted = {"done/epoch=0", *names([dead], "staging"), *names([dead], "open"), *names(hours[:4], "open"), *names(hours[:4], "watermark")}
    assert wanted <= gone
    assert not [g for g in gone if "_base" in g and g.endswith(f"{hours[5]:%Y%m%d_%H%M%S}")]
    assert {g for g in gone if g.startswith("open_base")} == set(names([hours[1], hours[3]], "open_base"))
    # What died goes whatever is kept.
    assert {u.split("/store/")[1] for u in untouched} == {*names([dead], "staging"), *names([dead], "open")}


def test_rows_of_runs_go_by_age_unless_a_target_may_read_them(swept):
    world, hours, _, _, _, gone = swept
    # The last publish took the last run; it builds on the publish of the first four.
    assert {g for g in gone if g.startswith("video_details")} == set(names(hours[:4], "video_details"))
    assert rows(world.store.table(world.spark, "video_details"), "run") != []
    assert publish(world.spark, world.store, str(world.base / "out")) == []
    silver = world.spark.read.parquet(str(world.base / "out" / "silver_videos"))
    assert len({v for (v,) in rows(silver, "video_id")}) >= 9


def test_sweeping_again_removes_nothing(swept):
    world, hours, *_ = swept
    assert sweep(world.spark, world.store, before=hours[8], keep=2, targets=[str(world.base / "out")]) == []


def test_no_commit_no_sweep(spark, tmp_path):
    assert sweep(spark, RunStore(str(tmp_path / "store")), before=R2) == []
    with pytest.raises(ValueError, match="last commit"):
        sweep(spark, RunStore(str(tmp_path / "store")), keep=0)
