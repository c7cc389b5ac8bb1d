from datetime import datetime
from pathlib import Path

import pytest
from conftest import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.operators.state import ids_of_documents, state_documents, watermark_of_documents
from freshet.plans.layers import in_hours, since_month
from freshet.plans.migrate import migrate_snapshots
from freshet.schemas import CHANNEL_STATS, VIDEO_DETAILS
from freshet.sinks.writers import overwrite_partitions, save_table, write_csv, write_lake, write_snapshot, write_table
from freshet.sources.files import read_bronze, read_channel_list, read_csv, read_lake, read_state_documents
from freshet.sources.landing import (
    ITEMS,
    blocking,
    channel_rows,
    channel_stats,
    read_envelopes,
    rejected,
    search_items,
    search_rows,
    video_details,
    video_rows,
)

TEXTS = T.StructType([T.StructField(n, T.StringType()) for n in ("video_id", "title", "tags")])


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode())
    return str(path)


def test_channel_list(spark, tmp_path):
    path = put(tmp_path / "list.csv", "channel_name,channel_id\nÀ b,UC_1-x\n!c,UC2")
    assert rows(read_channel_list(spark, path)) == [("!c", "UC2"), ("À b", "UC_1-x")]


def test_channel_list_goes_by_header(spark, tmp_path):
    path = put(tmp_path / "list.csv", "extra,channel_id,channel_name\n1,UC1,n\n")
    assert rows(read_channel_list(spark, path)) == [("n", "UC1")]
    assert rows(read_channel_list(spark, put(tmp_path / "ids.csv", "channel_id\nUC1\n"))) == [(None, "UC1")]
    with pytest.raises(AnalysisException):
        read_channel_list(spark, put(tmp_path / "other.csv", "name\nUC1\n"))


def test_missing_channel_list(spark, tmp_path):
    assert read_channel_list(spark, str(tmp_path / "none.csv")) is None


def test_legacy_csv(spark, tmp_path):
    put(tmp_path / "2026/01/19/21/video_details_20260119_213221.csv", 'video_id,title,tags\nv1,"x, ""q""\nnl",\nv2,\\,"a,b"\n')
    put(tmp_path / "2026/01/19/22/video_details_20260119_220000.csv", "\n")
    put(tmp_path / "2026/01/19/22/channel_stats_20260119_220000.csv", "other\nfile\n")
    read = read_bronze(spark, str(tmp_path), TEXTS, "video_details_*.csv")
    assert rows(read) == [
        ("v1", 'x, "q"\nnl', "", "video_details_20260119_213221.csv", datetime(2026, 1, 19, 21, 32, 21)),
        ("v2", "\\", "a,b", "video_details_20260119_213221.csv", datetime(2026, 1, 19, 21, 32, 21)),
    ]


def test_migrate_snapshots(spark, tmp_path):
    text = "channel_id,channel_name,subscribers,total_views,video_count\nUC1,n,{},3000000000,3\n"
    for name, value in {"20260115": 1, "20260119_213221": 2, "20260119_215755": 3, "20269999_999999": 4}.items():
        put(tmp_path / "in" / f"channel_stats_{name}.csv", text.format(value))
    parts = ("year", "month", "day", "hour", "run")
    for _ in range(2):
        rejected_files = migrate_snapshots(spark, str(tmp_path / "in"), str(tmp_path / "lake"), "channel_stats", CHANNEL_STATS)
        assert rows(rejected_files) == [("channel_stats_20260115.csv", 1), ("channel_stats_20269999_999999.csv", 1)]
        lake = read_lake(spark, str(tmp_path / "lake/channel_stats"), CHANNEL_STATS, parts)
        assert rows(lake, "subscribers", "day", "hour", "run") == [(2, "19", "21", "20260119_213221"), (3, "19", "21", "20260119_215755")]
    migrate_snapshots(spark, str(tmp_path / "in"), str(tmp_path / "lake"), "channel_stats", CHANNEL_STATS, admit_dates=True)
    lake = read_lake(spark, str(tmp_path / "lake/channel_stats"), CHANNEL_STATS, parts)
    assert rows(lake, "subscribers") == [(1,), (2,), (3,)]


def test_snapshot_without_stamp_is_kept_apart(spark, tmp_path):
    text = "channel_id,channel_name,subscribers,total_views,video_count\nUC1,n,1,3000000000,3\n"
    put(tmp_path / "channel_stats_20260115.csv", text)
    put(tmp_path / "channel_stats_20260119_213221.csv", text)
    read = read_bronze(spark, str(tmp_path), CHANNEL_STATS, "channel_stats_*.csv")
    assert rows(read.where("run_ts is null"), "file_name", "total_views") == [("channel_stats_20260115.csv", 3000000000)]


NASTY = [
    ("v1", 'a "quoted", text', "x"), ("v2", "line\nbreak", "y"), ("v3", " padded ", "z"), ("v4", "back\\slash\\", "w"),
    ("v5", 'ends with "', "ü"), ("v6", ",", '"'), ("v7", "plain", "tab\there"),
]


def test_csv_roundtrip(spark, tmp_path):
    df = spark.createDataFrame(NASTY, TEXTS)
    write_csv(df, str(tmp_path / "out"))
    assert rows(read_csv(spark, str(tmp_path / "out"), TEXTS)) == NASTY


def test_csv_text_form(spark, tmp_path):
    df = spark.createDataFrame([("v1", 'a "q", b', ""), ("v2", None, "plain")], TEXTS).coalesce(1)
    write_csv(df, str(tmp_path / "out"))
    part = next((tmp_path / "out").glob("part-*.csv"))
    assert part.read_text() == 'video_id,title,tags\nv1,"a ""q"", b",\nv2,,plain\n'


def test_empty_csv_keeps_header(spark, tmp_path):
    write_csv(spark.createDataFrame([], VIDEO_DETAILS), str(tmp_path / "out"))
    assert read_csv(spark, str(tmp_path / "out"), VIDEO_DETAILS).count() == 0
    assert ",".join(VIDEO_DETAILS.names) in next((tmp_path / "out").glob("part-*.csv")).read_text()


def test_modes(spark, tmp_path):
    path, df = str(tmp_path / "t"), spark.range(3)
    write_table(df, path, "error")
    with pytest.raises(AnalysisException):
        write_table(df, path, "error")
    write_table(df, path, "ignore")
    write_table(df, path, "append")
    assert spark.read.parquet(path).count() == 6
    write_table(df, path, "overwrite")
    assert spark.read.parquet(path).count() == 3
    with pytest.raises(ValueError):
        write_table(df, path, "replace")


def test_catalog_table_modes(spark):
    df = spark.range(3)
    save_table(df, "modes_under_test", "overwrite")
    save_table(df, "modes_under_test")
    save_table(df, "modes_under_test", "ignore")
    assert spark.table("modes_under_test").count() == 6
    with pytest.raises(AnalysisException):
        save_table(df, "modes_under_test", "error")
    spark.sql("drop table modes_under_test")


def test_hour_lake_prunes(spark, tmp_path):
    path = str(tmp_path / "lake")
    df = spark.range(50).select("id", F.expr("timestamp '2026-01-19 00:00:00' + make_interval(0, 0, 0, 0, cast(id as int))").alias("ts"))
    write_lake(df, path, F.col("ts"))
    schema = T.StructType([T.StructField("id", T.LongType())])
    lake = read_lake(spark, path, schema, ("year", "month", "day", "hour"))
    assert lake.select("month").first()[0] == "01"
    ranged = in_hours(lake, datetime(2026, 1, 19, 5), datetime(2026, 1, 19, 8))
    assert rows(ranged, "id") == [(5,), (6,), (7,)]
    plan = ranged._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    assert since_month(lake, datetime(2026, 2, 1)).count() == 0
    assert "PartitionFilters: []" not in since_month(lake, datetime(2026, 2, 1))._jdf.queryExecution().executedPlan().toString()


def test_partition_overwrite_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(10).select("id", F.when(F.col("id") < 5, "a").otherwise("b").alias("run"))
    for frame in (df, df, df.where("run = 'b' and id = 9")):
        overwrite_partitions(frame, path, ["run"])
    assert rows(spark.read.parquet(path), "id") == [(0,), (1,), (2,), (3,), (4,), (9,)]


def test_state_documents(spark, tmp_path):
    good = '{\n  "last_fetch_time": "2026-01-29T17:24:58.336039+00:00Z",\n  "video_ids": ["a", "b_-", "a"],\n  "updated_at": "2026-01-29T22:54:58"\n}'
    put(tmp_path / "channel_UC_a-b_c_cache.json", good)
    put(tmp_path / "channel_UCbad_cache.json", "{oops")
    put(tmp_path / "channel_UCjunk_cache.json", '{"last_fetch_time": "junk", "video_ids": []}')
    documents = read_state_documents(spark, str(tmp_path))
    assert rows(ids_of_documents(documents)) == [("UC_a-b_c", "a"), ("UC_a-b_c", "b_-")]
    bounds = {r["channel_id"]: r["last_fetch_ts"] for r in watermark_of_documents(documents).collect()}
    assert bounds == {"UC_a-b_c": datetime(2026, 1, 29, 17, 24, 58, 336039), "UCbad": None, "UCjunk": None}
    assert rows(documents.where("corrupt"), "channel_id") == [("UCbad",)]
    assert read_state_documents(spark, str(tmp_path / "none")).count() == 0


def test_state_export_roundtrip(spark, tmp_path):
    ledger = spark.createDataFrame([("c1", f"v{i}") for i in range(25)] + [("c2", "w")], "channel_id string, video_id string")
    marks = spark.createDataFrame([("c1", datetime(2026, 1, 1), datetime(2026, 1, 2))], "channel_id string, last_fetch_ts timestamp, updated_at timestamp")
    state_documents(ledger, marks, "channel_id", "video_id", size=10).select("value").write.text(str(tmp_path / "s"))
    documents = read_state_documents(spark, str(tmp_path / "s"), multi_line=False)
    assert documents.count() == 4
    assert rows(ids_of_documents(documents)) == rows(ledger)
    assert {r[0]: r[1] for r in watermark_of_documents(documents).collect()} == {"c1": datetime(2026, 1, 1), "c2": None}


ENVELOPE = """{"items":[
 {"id":"v1","snippet":{"title":"a, \\"q\\"\\nnl","publishedAt":"2026-01-19T21:00:00Z","tags":["x","y"],"categoryId":"24","defaultAudioLanguage":"en","defaultLanguage":"fr"},
  "statistics":{"viewCount":"10","likeCount":"2","commentCount":"1"},"contentDetails":{"duration":"PT4M13S"}},
 {"id":"v2","snippet":{"title":"b","publishedAt":"2026-01-19T20:55:00Z","defaultLanguage":"fr"},"statistics":{},"contentDetails":{}},
 {"id":"v3","snippet":{"title":"no publish time"},"statistics":{}}],
 "nextPageToken":"T2"}"""


def test_video_flattening(spark, tmp_path):
    put(tmp_path / "videos__UC_1__p0.json", ENVELOPE)
    put(tmp_path / "videos__UC_2__p0.json", '{"items": [')
    put(tmp_path / "videos__UC_3__p0.json", '{"error": {"code": 403, "message": "quota"}}')
    flat = video_rows(read_envelopes(spark, str(tmp_path), ITEMS["videos"], multi_line=True))
    assert rows(video_details(flat)) == [
        ("v1", 'a, "q"\nnl', "2026-01-19T21:00:00Z", 10, 2, 1, 253, "x,y", "24", "en"),
        ("v2", "b", "2026-01-19T20:55:00Z", 0, 0, 0, 0, "", "", "fr"),
    ]
    rejects = rejected(flat, "videos")
    assert rows(rejects) == [
        ("UC_1", "videos", "incomplete item", "v3"),
        ("UC_2", "videos", "corrupt response", ""),
        ("UC_3", "videos", "error response", "403 quota"),
    ]
    assert rows(blocking(rejects)) == [("UC_2", "corrupt response"), ("UC_3", "error response")]


def test_channel_flattening(spark, tmp_path):
    put(
        tmp_path / "channels__UC1__p0.json",
        '{"items":[{"id":"UC1","snippet":{"title":"old"},"statistics":{"viewCount":"5"}},'
        '{"id":"UC1","snippet":{"title":"!new"},"statistics":{"viewCount":"3000000000"}}]}',
    )
    put(tmp_path / "channels__UC2__p0.json", '{"items":[]}')
    flat = channel_rows(read_envelopes(spark, str(tmp_path), ITEMS["channels"], multi_line=True))
    assert rows(channel_stats(flat)) == [("UC1", "!new", 0, 3000000000, 0)]
    assert rows(rejected(flat, "channels")) == [("UC2", "channels", "no usable item", "")]


def test_search_pages(spark, tmp_path):
    put(
        tmp_path / "search__UC1__p2.json",
        '{"items":[{"id":{"kind":"s#video","videoId":"v3"}},{"id":{"kind":"s#playlist","playlistId":"p"}},{"id":{"kind":"s#video"}}]}',
    )
    put(tmp_path / "search__UC1__p1.json", '{"items":[{"id":{"videoId":"v1"},"publishedAt":"2026-01-01T00:00:00Z"}],"nextPageToken":"T"}')
    put(tmp_path / "2026/01/search__UC2__p1.json", '{"items":[]}')
    flat = search_rows(read_envelopes(spark, str(tmp_path), ITEMS["search"], multi_line=True))
    assert rows(search_items(flat), "channel_id", "page_no", "pos", "video_id") == [("UC1", 1, 0, "v1"), ("UC1", 2, 0, "v3")]
    assert rows(rejected(flat, "search"), "channel_id", "reason") == [("UC1", "incomplete item")]


def test_snapshot_of_many_rows_is_numbered(spark, tmp_path):
    df = spark.range(25).select(F.col("id").cast("string").alias("video_id"))
    for n, last in ((10, 3), (100, 1)):
        names = [Path(p).name for p in write_snapshot(df, str(tmp_path / "x"), "video_details", "20260102_030405", n)]
        assert len(names) == last == len(list((tmp_path / "x").glob("video_details_*.csv")))
    read = read_bronze(spark, str(tmp_path), df.schema, "video_details_*.csv")
    assert sorted(int(r["video_id"]) for r in read.collect()) == list(range(25))
    assert rows(read.select("run_ts").distinct()) == [(datetime(2026, 1, 2, 3, 4, 5),)]
