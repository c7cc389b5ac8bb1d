"""Explicit schemas; nothing in this package infers one."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _TS = T.StringType(), T.LongType(), T.TimestampType()


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


def extended(schema: T.StructType, *fields: tuple) -> T.StructType:
    """``schema`` with further columns; the original is left alone."""
    return T.StructType([*schema.fields, *_struct(*fields).fields])


# Names and order of the flat tables' columns.
CHANNEL_LIST = _struct(("channel_name", _S), ("channel_id", _S))

CHANNEL_STATS = _struct(
    ("channel_id", _S),
    ("channel_name", _S),
    ("subscribers", _L),
    ("total_views", _L),
    ("video_count", _L),
)

VIDEO_DETAILS = _struct(
    ("video_id", _S),
    ("title", _S),
    ("published_date", _S),
    ("view_count", _L),
    ("like_count", _L),
    ("comment_count", _L),
    ("duration", _L),
    ("tags", _S),
    ("category_id", _S),
    ("language", _S),
    ("channel_id", _S),
    ("channel_name", _S),
)

# Field names inside the landed responses.
CHANNEL_ITEM = _struct(
    ("id", _S),
    ("snippet", _struct(("title", _S))),
    ("statistics", _struct(("subscriberCount", _S), ("viewCount", _S), ("videoCount", _S))),
)

SEARCH_ITEM = _struct(
    ("id", _struct(("kind", _S), ("videoId", _S))),
    ("publishedAt", _S),
    ("snippet", _struct(("publishedAt", _S))),
)

VIDEO_ITEM = _struct(
    ("id", _S),
    (
        "snippet",
        _struct(
            ("title", _S),
            ("publishedAt", _S),
            ("tags", T.ArrayType(_S)),
            ("categoryId", _S),
            ("defaultAudioLanguage", _S),
            ("defaultLanguage", _S),
        ),
    ),
    ("statistics", _struct(("viewCount", _S), ("likeCount", _S), ("commentCount", _S))),
    ("contentDetails", _struct(("duration", _S))),
)

CORRUPT = "_corrupt_record"


def envelope(item: T.StructType) -> T.StructType:
    """One landed response: its items, who it was for, and what went wrong."""
    return _struct(
        ("channel_id", _S),
        ("page_no", _L),
        ("items", T.ArrayType(item)),
        ("nextPageToken", _S),
        ("error", _struct(("code", _L), ("message", _S))),
        (CORRUPT, _S),
    )


STATE_DOCUMENT = _struct(
    ("channel_id", _S),
    ("last_fetch_time", _S),
    ("video_ids", T.ArrayType(_S)),
    ("updated_at", _S),
    (CORRUPT, _S),
)

LEDGER = _struct(
    ("channel_id", _S),
    ("video_id", _S),
    ("published_ts", _TS),
    ("first_seen_run", _TS),
    ("status", _S),
    ("attempts", _L),
)

WATERMARK = _struct(("channel_id", _S), ("last_fetch_ts", _TS), ("updated_at", _TS))

RUN_AUDIT = _struct(
    ("run_ts", _TS),
    ("channel_id", _S),
    ("found", _L),
    ("cached", _L),
    ("new", _L),
    ("selected", _L),
    ("retrieved", _L),
    ("status", _S),
    ("error", _S),
)

# Totals of one run; ``calls_saved`` and ``quota_units`` in the units of the remote service.
RUN_SUMMARY = _struct(
    ("channels", _L),
    ("failed_channels", _L),
    ("found", _L),
    ("cached", _L),
    ("selected", _L),
    ("videos", _L),
    ("alerts", _L),
    ("calls_saved", _L),
    ("quota_units", _L),
)

# ``base``: the run whose snapshots the changes of later runs build on, ``since``: how many runs these are;
# ``cleared``: the last run that cleared channels. Stamps, '' for none. ``summary`` is NULL where nothing ran.
COMMIT = _struct(("run_ts", _TS), ("epoch", _L), ("base", _S), ("since", _L), ("cleared", _S), ("summary", RUN_SUMMARY))

OPEN_CHANGE = extended(LEDGER, ("closed", T.BooleanType()))

CLEARED = _struct(("channel_id", _S))

PUBLISHED = _struct(("version", _L), ("base", _L), ("after", _S), ("until", _S), ("commit", _L), ("buckets", _L), ("undo", _L))

SILVER_VIDEOS = _struct(
    ("video_id", _S),
    ("title", _S),
    ("published_ts", _TS),
    ("view_count", _L),
    ("like_count", _L),
    ("comment_count", _L),
    ("duration", _L),
    ("tags", T.ArrayType(_S)),
    ("category_id", _S),
    ("language", _S),
    ("channel_id", _S),
    ("channel_name", _S),
    ("run", _S),
)

ARRIVAL = _struct(("delivery", _S), ("batch", _L), ("run_ts", _TS))

QUARANTINE = _struct(("channel_id", _S), ("source", _S), ("reason", _S), ("detail", _S))
