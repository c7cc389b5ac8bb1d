"""What a run's plan costs as its tables grow."""

from datetime import datetime
from types import SimpleNamespace

from conftest import plan_of

from freshet.plans.ingest import RunConf, _offered, run_job
from freshet.plans.store import RunStore
from freshet.schemas import LEDGER, WATERMARK

ITEMS = "channel_id string, video_id string, published_ts timestamp, page_no bigint, pos bigint"


def test_search_results_and_ledger_meet_without_sorting(spark):
    old, new = datetime(2024, 1, 1), datetime(2024, 1, 3)
    items = spark.createDataFrame(
        [("c", "taken", new, 1, 3), ("c", "open", new, 0, 2), ("c", "late", old, 2, 0), ("c", "new", new, 3, 0), ("c", "new", old, 2, 49), ("d", "taken", None, -2, 1)],
        ITEMS,
    )
    row = lambda video: ("c", video, None, None, "pending", 0)
    done, backlog = spark.createDataFrame([row("taken"), row("taken"), row("gone")], LEDGER), spark.createDataFrame([row("open")], LEDGER)
    marks = spark.createDataFrame([("c", datetime(2024, 1, 2), None)], WATERMARK)
    store = SimpleNamespace(stage=lambda df, name, run_ts: df)
    state = SimpleNamespace(watermark=marks, done=done)
    conf = RunConf("", "", "", datetime(2024, 2, 1))
    for small in (False, True):
        offered = _offered(store, items, small, state, backlog, conf)
        found = {(r.channel_id, r.video_id): (r.published_ts, tuple(r.place), r.inside, r.cached, r.waiting) for r in offered.collect()}
        assert found == {
            ("c", "taken"): (new, (1, 3), True, True, False),
            ("c", "open"): (new, (0, 2), True, False, True),
            ("c", "late"): (old, (2, 0), False, False, False),
            ("c", "new"): (old, (2, 49), True, False, False),
            ("d", "taken"): (None, (-2, 1), True, False, False),
        }
        plan = plan_of(offered)
        assert "SortAggregate" not in plan


def test_steps_that_several_tables_need_are_written_once(spark, tmp_path, monkeypatch):
    """The list, what blocks channels, the open backlog and what became of the selected ids."""
    landing = tmp_path / "landing"
    for kind in ("channels", "search", "videos"):
        (landing / kind).mkdir(parents=True)
    (landing / "channels" / "a.json").write_text('{"channel_id":"c","items":[{"id":"c","snippet":{"title":"C"},"statistics":{}}]}\n')
    (landing / "search" / "a.json").write_text('{"channel_id":"c","items":[{"id":{"kind":"x#video","videoId":"v"},"publishedAt":"2024-01-01T00:00:00"}]}\n')
    video = '{"id":"v","snippet":{"title":"%s","publishedAt":"2024-01-01T00:00:00"},"statistics":{"viewCount":"1"}}'
    (landing / "videos" / "a.json").write_text('{"channel_id":"c","items":[' + ",".join(video % t for t in ("A", "B")) + "]}\n")
    (tmp_path / "list.csv").write_text("channel_name,channel_id\nC,c\nC,c\nD,d\n")
    staged, stage = [], RunStore.stage
    monkeypatch.setattr(RunStore, "stage", lambda self, df, name, run_ts: (staged.append(name), stage(self, df, name, run_ts))[1])
    result = run_job(spark, RunConf(str(landing), str(tmp_path / "store"), str(tmp_path / "list.csv"), datetime(2024, 2, 1)))
    assert {"listed", "blocked", "backlog", "outcome"} <= set(staged) and len(staged) == len(set(staged))
    assert [(r.video_id, r.channel_id, r.channel_name, r.title) for r in result.videos.collect()] == [("v", "c", "C", "B")]
    assert sorted((r.channel_id, r.found, r.retrieved, r.status) for r in result.audit.collect()) == [("c", 1, 1, "ok"), ("d", 0, 0, "failed")]
