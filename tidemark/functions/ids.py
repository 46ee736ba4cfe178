"""Ids, local time and normalised host names."""

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schema import REPLAY_PREFIX

DAY_MICROS = 86_400_000_000


def parse_day(day: str) -> date:
    return datetime.strptime(day, "%Y%m%d").date()


def shift_day(day: str, days: int) -> str:
    return (parse_day(day) + timedelta(days=days)).strftime("%Y%m%d")


def local_timestamp(micros: Column, tz: str) -> Column:
    """Wall-clock time of epoch microseconds (the session time zone must be UTC)."""
    instant = F.timestamp_micros(micros).cast("timestamp_ntz")
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), instant)


def local_date(micros: Column, tz: str) -> Column:
    return local_timestamp(micros, tz).cast("date")


def in_local_window(
    micros: Column, start: str, end: str, tz: str, exclusive_end: bool = False
) -> Column:
    """Local time from start 00:00:00 to end 23:59:59.

    The last second's fraction is outside by default; ``exclusive_end`` takes whole days.
    The first two conditions are implied by the others; as comparisons of the raw column
    with literals they reach the parquet scan.
    """
    first, last = parse_day(start), parse_day(end)
    epoch = datetime(1970, 1, 1, tzinfo=timezone.utc)

    def day_micros(day: date) -> int:
        at = datetime(day.year, day.month, day.day, tzinfo=timezone.utc)
        return (at - epoch) // timedelta(microseconds=1)

    local = local_timestamp(micros, tz)
    opens = F.lit(datetime(first.year, first.month, first.day)).cast("timestamp_ntz")
    if exclusive_end:
        following = last + timedelta(days=1)
        closes = F.lit(datetime(following.year, following.month, following.day))
        inside = local < closes.cast("timestamp_ntz")
    else:
        closes = F.lit(datetime(last.year, last.month, last.day, 23, 59, 59))
        inside = local <= closes.cast("timestamp_ntz")
    return (
        (micros >= day_micros(first) - DAY_MICROS)
        & (micros <= day_micros(last) + 2 * DAY_MICROS)
        & (local >= opens)
        & inside
    )


def pseudonymous_session_id(user: Column, session: Column) -> Column:
    return F.concat(user, F.lit("_"), session.cast("string"))


def page_view_id(user: Column, session: Column, page_number: Column) -> Column:
    page = F.greatest(page_number, F.lit(1))
    return F.concat(
        user, F.lit("_"), session.cast("string"), F.lit("_"), page.cast("string")
    )


def event_id(user: Column, micros: Column, event_name: Column, session: Column) -> Column:
    bar = F.lit("|")
    number = F.coalesce(session, F.lit(-1).cast("bigint")).cast("string")
    return F.sha2(
        F.concat(user, bar, micros.cast("string"), bar, event_name, bar, number), 256
    )


def hostname_norm(hostname: Column) -> Column:
    return F.lower(F.regexp_replace(hostname, r"^www\.", ""))


def event_key_flag(event_name: Column) -> Column:
    """1 for a purchase or an event whose name starts with CV_ (case-sensitive)."""
    hit = (event_name == "purchase") | event_name.startswith("CV_")
    return F.when(hit, 1).otherwise(0).cast("bigint")


def is_key_event_name(event_name: Column) -> Column:
    """Events that make their session a key session (case-insensitive)."""
    name = F.lower(event_name)
    return name.startswith("cv_") | (name == "purchase")


def replay_url(project: Column, user: Column, session: Column) -> Column:
    """Session replay address; NULL unless all three ids are present."""
    slash = F.lit("/")
    return F.concat(F.lit(REPLAY_PREFIX), project, slash, user, slash, session)
