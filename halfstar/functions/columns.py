"""Scalar expressions: time, titles, segments and bins."""

from pyspark.sql import Column, functions as F

# Patterns, labels and the placeholder genre of the data set.
YEAR_AT_END = r"\((\d{4})\)\s*$"
YEAR_SUFFIX = r"\s*\(\d{4}\)\s*$"
GENRE_SEPARATOR = r"\|"
NO_GENRE = "(no genres listed)"
LABELS_LEFT_CLOSED = ("Generous (≥4.0)", "Moderate (3–4)", "Harsh (<3.0)")
LABELS_RIGHT_CLOSED = ("Generous (≥4)", "Moderate (3–4)", "Harsh (<3)")


# Seconds either side of 1970 that fit a timestamp, which counts microseconds in 64 bits.
EPOCH_LIMIT = (2**63 - 1) // 1_000_000


def storable(seconds: Column) -> Column:
    """Whether a timestamp can hold these seconds; time, day and hour are NULL where none can."""
    return seconds.between(-EPOCH_LIMIT, EPOCH_LIMIT)


def utc_from_epoch(seconds: Column) -> Column:
    """Epoch seconds as a UTC timestamp without zone, whatever the session zone is.

    NULL where no timestamp could hold them: a stray value in microseconds must
    not fail a job over all the others.
    """
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.when(storable(seconds), F.timestamp_add("SECOND", seconds, epoch))


def utc_date(seconds: Column) -> Column:
    """UTC calendar day of epoch seconds, by integer arithmetic; NULL beyond all timestamps."""
    day = F.date_from_unix_date(F.floor(seconds / 86400).try_cast("int"))
    return F.when(storable(seconds), day)


def utc_hour(seconds: Column) -> Column:
    """UTC hour of the day, 0 to 23, of epoch seconds."""
    hour = F.floor(F.pmod(seconds, F.lit(86400)) / 3600).cast("int")
    return F.when(storable(seconds), hour)


def year_in_title(title: Column) -> Column:
    """The four digits in parentheses that end a title, or NULL; never an ANSI error."""
    return F.regexp_extract(title, YEAR_AT_END, 1).try_cast("int")


def title_without_year(title: Column) -> Column:
    return F.trim(F.regexp_replace(title, YEAR_SUFFIX, ""))


def decade_of(year: Column) -> Column:
    return year - year % 10


def segment_left_closed(average: Column) -> Column:
    """Segment of a user by average rating, the edges 3 and 4 counted upwards."""
    generous, moderate, harsh = LABELS_LEFT_CLOSED
    return F.when(average >= 4, generous).when(average >= 3, moderate).otherwise(harsh)


def segment_right_closed(average: Column) -> Column:
    """Segment by the bins (0,3], (3,4] and (4,5.1]; NULL outside of them."""
    generous, moderate, harsh = LABELS_RIGHT_CLOSED
    return (
        F.when((average > 0) & (average <= 3), harsh)
        .when((average > 3) & (average <= 4), moderate)
        .when((average > 4) & (average <= 5.1), generous)
    )


def equal_width_bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Bin 1 to ``bins`` of a value in [low, high]; ``high`` itself is in the last bin."""
    bucket = F.width_bucket(value, low.cast("double"), high.cast("double"), F.lit(bins))
    one_point = F.lit(1)  # low = high has no width
    return F.least(F.coalesce(bucket, one_point), F.lit(bins)).cast("int")
