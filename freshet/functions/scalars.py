"""Scalar operators: every one maps Column to Column and stays inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Defaults and limits the outputs must agree with.
LAKE_PREFIX = "youtube-raw-data"
LOOKBACK_MINUTES = 10
BATCH_SIZE = 50
DURATION_PATTERN = (
    r"^P(?=.)(?:\d+W)?(?:\d+D)?(?:T(?=\d)(?:\d+H)?(?:\d+M)?(?:\d+(?:[.,]\d+)?S)?)?\z"
)
DURATION_WEIGHTS = (604800, 86400, 3600, 60, 1)
STAMP_PATTERN = r"^.*_(\d{8}_\d{6})\.csv\z"
STAMP_FORMAT = "yyyyMMdd_HHmmss"
DATE_STAMP_PATTERN = r"^.*_(\d{8})\.csv\z"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def zero_if_missing(value: Column | str) -> Column:
    return F.coalesce(_col(value), F.lit(0))


def empty_if_missing(value: Column | str) -> Column:
    return F.coalesce(_col(value), F.lit(""))


def first_present(*values: Column | str) -> Column:
    """First non-NULL value; the empty string ends the chain."""
    return F.coalesce(*[_col(v) for v in values], F.lit(""))


def tags_joined(tags: Column | str) -> Column:
    return F.array_join(F.coalesce(_col(tags), F.array().cast("array<string>")), ",")


def _amount(text: Column, unit: str) -> Column:
    """Whole number in front of ``unit``, 0 where the unit is absent."""
    number = F.substring_index(text, unit, 1).try_cast("bigint")
    return F.when(F.contains(text, F.lit(unit)), number).otherwise(F.lit(0).cast("bigint"))


def is_iso_duration(value: Column | str) -> Column:
    """True for the accepted forms; NULL and '' are not durations."""
    return F.coalesce(_col(value).rlike(DURATION_PATTERN), F.lit(False))


def iso_duration_seconds(value: Column | str) -> Column:
    """ISO-8601 duration to whole seconds; missing or unusable text is 0.

    The pattern only decides; the amounts are then cut out by cheap string functions, because one
    regex group extraction per unit costs several times the whole expression.
    """
    text = _col(value)
    date = F.substring_index(F.substr(text, F.lit(2)), "T", 1)
    clock = F.when(F.contains(text, F.lit("T")), F.substring_index(text, "T", -1)).otherwise(F.lit(""))
    after_hours = F.substring_index(clock, "H", -1)
    after_minutes = F.substring_index(after_hours, "M", -1)
    whole_seconds = F.regexp_replace(after_minutes, r"[.,]\d+", "")
    amounts = (
        _amount(date, "W"),
        _amount(F.substring_index(date, "W", -1), "D"),
        _amount(clock, "H"),
        _amount(after_hours, "M"),
        _amount(whole_seconds, "S"),
    )
    total = F.lit(0).cast("bigint")
    for amount, weight in zip(amounts, DURATION_WEIGHTS):
        total = F.try_add(total, F.try_multiply(amount, F.lit(weight)))
    return F.coalesce(F.when(is_iso_duration(text), total), F.lit(0).cast("bigint"))


def _exact_bigint(value: Column | str) -> Column:
    # By way of DECIMAL(38,18), which holds every BIGINT. Casting text to BIGINT directly would
    # reject decimals, and builds an exception per unusable value.
    return _col(value).cast("string").try_cast("decimal(38,18)").try_cast("bigint")


def coerce_bigint(value: Column | str) -> Column:
    """Lenient text to BIGINT: missing or unusable is 0, decimals truncate toward zero, blanks are trimmed."""
    return F.coalesce(_exact_bigint(value), F.lit(0).cast("bigint"))


def is_bigint_text(value: Column | str) -> Column:
    """True when ``coerce_bigint`` keeps a value rather than falling back to 0."""
    return _exact_bigint(value).isNotNull()


def basename(path: Column | str) -> Column:
    return F.element_at(F.split(_col(path), "/"), -1)


def stamp_text(filename: Column | str) -> Column:
    """The last ``YYYYMMDD_HHMMSS`` before ``.csv``, or NULL."""
    return F.nullif(F.regexp_extract(_col(filename), STAMP_PATTERN, 1), F.lit(""))


def stamp_ts(filename: Column | str) -> Column:
    """Timestamp in a file name; NULL for other names and for impossible dates."""
    return F.try_to_timestamp(stamp_text(filename), F.lit(STAMP_FORMAT))


def date_stamp_ts(filename: Column | str) -> Column:
    """Midnight of a name that carries only a date; such names are otherwise rejected."""
    text = F.nullif(F.regexp_extract(_col(filename), DATE_STAMP_PATTERN, 1), F.lit(""))
    return F.try_to_timestamp(text, F.lit("yyyyMMdd"))


def stamp_parts(filename: Column | str) -> dict[str, Column]:
    """The six zero-padded parts of a file-name stamp, NULL when the name is rejected."""
    text = F.when(stamp_ts(filename).isNotNull(), stamp_text(filename))
    places = {"year": (1, 4), "month": (5, 2), "day": (7, 2), "hour": (10, 2), "minute": (12, 2), "second": (14, 2)}
    return {part: F.substring(text, start, length) for part, (start, length) in places.items()}


def lake_key(ts: Column | str, filename: Column | str, prefix: str = LAKE_PREFIX) -> Column:
    """``prefix/YYYY/MM/DD/HH/filename`` for any clock the caller passes."""
    return F.concat(F.lit(prefix), F.date_format(_col(ts), "/yyyy/MM/dd/HH/"), _col(filename))


def lake_path(filename: Column | str, prefix: str = LAKE_PREFIX) -> Column:
    """Lake key by the file name's own stamp; NULL when the name is rejected."""
    return lake_key(stamp_ts(filename), filename, prefix)


def object_uri(bucket: str, key: Column | str, scheme: str = "s3") -> Column:
    return F.concat(F.lit(f"{scheme}://{bucket}/"), _col(key))


def run_stamp(run_ts: Column | str) -> Column:
    return F.date_format(_col(run_ts), STAMP_FORMAT)


def run_file_name(table: str, run_ts: Column | str) -> Column:
    return F.concat(F.lit(f"{table}_"), run_stamp(run_ts), F.lit(".csv"))


def parse_iso_lenient(text: Column | str) -> Column:
    """ISO timestamp, also with the legacy ``+00:00Z`` ending; NULL when unusable."""
    whole = F.when(_col(text).rlike(r"\A\d{4}-\d{2}-\d{2}"), _col(text))
    return F.try_to_timestamp(F.regexp_replace(whole, r"([+-]\d\d:\d\d)Z$", "$1"))


def lookback(ts: Column | str, minutes: int = LOOKBACK_MINUTES) -> Column:
    return _col(ts) - F.expr(f"INTERVAL {int(minutes)} MINUTES")


def calls_saved(cached: Column | str, size: int = BATCH_SIZE) -> Column:
    """Requests a non-empty cache avoided."""
    n = _col(cached)
    return F.when(n > 0, F.floor(n / size) + 1).otherwise(0).cast("bigint")


def quota_units(channels: Column | str, videos: Column | str) -> Column:
    """Documented estimate: 3 units and one 100-unit search per channel, 1 per video."""
    return (_col(channels) * 103 + _col(videos)).cast("bigint")
