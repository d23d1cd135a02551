"""Spanish dates as Column expressions; invalid dates are null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names.
MONTHS = {"enero": 1, "febrero": 2, "marzo": 3, "abril": 4, "mayo": 5, "junio": 6, "julio": 7, "agosto": 8, "septiembre": 9, "setiembre": 9, "octubre": 10, "noviembre": 11, "diciembre": 12}
LONG = r"(?iu)(\d{1,2})\s+de\s+(" + "|".join(MONTHS) + r")\s+de\s+(\d{4})"


def _try_date(year: Column, month: Column, day: Column) -> Column:
    text = F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))
    return F.when(F.length(text) == 10, F.try_to_timestamp(text, F.lit("yyyy-MM-dd")).cast("date"))


def long_es(c: Column) -> Column:
    """First "3 de marzo de 2020" in the text."""
    month = F.create_map(*[F.lit(x) for k, v in MONTHS.items() for x in (k, str(v))])
    part = [F.regexp_extract(c, LONG, i) for i in (1, 2, 3)]
    return F.when(part[0] != "", _try_date(part[2], F.element_at(month, F.lower(part[1])), part[0]))


def slash_es(c: Column) -> Column:
    part = [F.regexp_extract(c, r"(\d{2})/(\d{2})/(\d{4})", i) for i in (1, 2, 3)]
    return F.when(part[0] != "", _try_date(part[2], part[1], part[0]))


def compact(c: Column) -> Column:
    """Leading yyyymmdd."""
    part = [F.regexp_extract(c, r"^\s*(\d{4})(\d{2})(\d{2})", i) for i in (1, 2, 3)]
    return F.when(part[0] != "", _try_date(*part))


def any_es(c: Column) -> Column:
    return F.coalesce(long_es(c), slash_es(c), compact(c))


def known_at(text: str):
    """The instant a ``known_at`` argument stands for, as a naive UTC datetime: a bare date means its end."""
    from datetime import UTC, datetime

    try:
        value = datetime.fromisoformat(text)
    except ValueError:
        raise ValueError(f"known_at is neither a date nor a timestamp: {text!r}") from None
    if len(text) == 10:
        value = value.replace(hour=23, minute=59, second=59, microsecond=999_999)
    return value.astimezone(UTC).replace(tzinfo=None) if value.tzinfo else value
