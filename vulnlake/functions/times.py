"""Date and timestamp expressions. All parsing is tolerant: bad text gives null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vulnlake.functions.nested import let, strip

# Shape of an accepted timestamp: ISO-8601 with seconds, no, three or six fraction digits, and an optional zone.
_ISO_SECONDS = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{3}(\d{3})?)?(Z|[+-]\d{2}:\d{2})?$"
MILLISECOND_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSS"
DATE_PATTERN = "yyyy-MM-dd"

_RFC3339 = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:\d{2})?)?$"
_HAS_ZONE = r"(Z|[+-]\d{2}:\d{2})$"
_HAS_TIME = r"\d{2}:\d{2}"


def parse_ts(text: Column) -> Column:
    """Timestamp from text of the accepted shape, else null; without a zone it is in the session's, UTC."""
    return F.when(text.rlike(_ISO_SECONDS), text.try_cast("timestamp"))


def parse_rfc3339(text: Column) -> Column:
    """RFC-3339 text with up to nine fraction digits; text without a zone is UTC."""

    def parse(clean: Column) -> Column:
        # Only text longer than microseconds with an offset or Z can carry more than six digits.
        short = F.when(F.length(clean) > 26, F.regexp_replace(clean, r"(\.\d{6})\d+", "$1")).otherwise(clean)
        zoneless = ~clean.endswith("Z") & clean.rlike(_HAS_TIME) & ~clean.rlike(_HAS_ZONE)
        zoned = F.when(zoneless, F.concat(short, F.lit("Z"))).otherwise(short)
        return F.when(clean.rlike(_RFC3339), zoned.try_cast("timestamp"))

    return let(strip(text), parse)


def millisecond_text(ts: Column) -> Column:
    """Zone-less text with millisecond precision (session zone is UTC)."""
    return F.date_format(ts, MILLISECOND_TEXT)


def parse_date(text: Column) -> Column:
    """Date from the first ten characters, null when they are not an ISO date."""
    head = F.substring(text, 1, 10)
    return F.when(head.rlike(r"^\d{4}-\d{2}-\d{2}$"), head.try_cast("date"))


def day_number(date: Column) -> Column:
    """Days since 1970-01-01, as the ordering key of range frames."""
    return F.unix_date(date)


def age_days(date: Column, since: Column) -> Column:
    return F.datediff(date, since)
