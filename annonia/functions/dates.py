"""Dates in text. "Now" is always the argument ``as_of``, a date or timestamp column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .base import choose, let, plain_spaces, take, text

#: Month names by number, as the sites write them.
MONTHS = {
    1: ["janvier", "january", "janv", "jan"],
    2: ["février", "fevrier", "february", "févr", "fév", "feb"],
    3: ["mars", "march", "mar"],
    4: ["avril", "april", "avr", "apr"],
    5: ["mai", "may"],
    6: ["juin", "june", "jun"],
    7: ["juillet", "july", "juil", "jul"],
    8: ["août", "aout", "august", "aoû", "aug"],
    9: ["septembre", "september", "sept", "sep"],
    10: ["octobre", "october", "oct"],
    11: ["novembre", "november", "nov"],
    12: ["décembre", "decembre", "december", "déc", "dec"],
}


def _any_name() -> str:
    """Any month name, the longest first; parted by their first letters, so that elsewhere a few tries are enough."""
    by_letter: dict[str, list[str]] = {}
    for n in sorted((n for names in MONTHS.values() for n in names), key=lambda n: (-len(n), n)):
        by_letter.setdefault(n[0], []).append(n[1:])
    return "|".join(f"{letter}(?:{'|'.join(rest)})" for letter, rest in by_letter.items())


_NAMES = _any_name()


def month_number(name: Column) -> Column:
    """1 to 12, null for other text."""
    pairs = [F.lit(x) for m, names in MONTHS.items() for n in names for x in (n, m)]
    return F.try_element_at(F.create_map(*pairs), F.lower(name))


def _named(low: Column, pattern: str, day: int, month: int, year: int, else_year: Column | None = None) -> Column:
    """The date whose parts are those groups of a pattern; the text is searched once, the groups read from what was found."""

    def read(found: Column) -> Column:
        given = take(found, pattern, year)
        return _date(take(found, pattern, day), month_number(take(found, pattern, month)), given if else_year is None else F.coalesce(given.try_cast("int"), else_year))

    return let(take(low, pattern, 0), lambda found: F.when(found.isNotNull(), read(found)))


def _date(day: Column, month: Column, year: Column) -> Column:
    """Null if a part is missing or no such day exists. Cast, as the reader with a pattern throws for each text that it can't read."""
    parts = [year.try_cast("int"), month.try_cast("int"), day.try_cast("int")]
    return F.concat(F.lpad(parts[0].cast("string"), 4, "0"), F.lit("-"), F.lpad(parts[1].cast("string"), 2, "0"), F.lit("-"), F.lpad(parts[2].cast("string"), 2, "0")).try_cast("date")


def _iso(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM-dd")


#: Each spelling and its pattern; the pattern must fit exactly, as lenient readers take parts.
_FORMATS = [
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{1,2}:\d{1,2}$", "d/M/yyyy H:m:s"),
    (r"^\d{1,2}-\d{1,2}-\d{4} \d{1,2}:\d{1,2}:\d{1,2}$", "d-M-yyyy H:m:s"),
    (r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$", "yyyy-M-d H:m:s"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy"),
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
]


def _timestamp(col: Column, formats=None) -> Column:
    return F.coalesce(*(F.when(col.rlike(p), F.try_to_timestamp(col, F.lit(f))) for p, f in formats or _FORMATS))


def parse_date(col: Column) -> Column:
    """One of five formats as an ISO timestamp, else empty."""
    return F.coalesce(F.date_format(_timestamp(text(col)), "yyyy-MM-dd'T'HH:mm:ss"), F.lit(""))


def parse_date_or_input(col: Column) -> Column:
    """'dd/MM/yyyy HH:mm:ss' as an ISO timestamp, else the input."""
    return F.coalesce(F.date_format(_timestamp(text(col), _FORMATS[:1]), "yyyy-MM-dd'T'HH:mm:ss"), text(col))


def _ago(low: Column, as_of: Column, units: dict[str, int]) -> Column:
    """'il y a N unit' as a date; a month is 30 days, a year 365."""
    out = [F.date_sub(as_of, take(low, rf"il y a (?:environ )?(\d+) {u}").try_cast("int") * days) for u, days in units.items()]
    return F.coalesce(*out)


_DAYS = {"jour": 1, "semaine": 7, "mois": 30, "an": 365}


def normalize_date(col: Column, as_of: Column) -> Column:
    """ISO date of ISO text, 'd Mon [yyyy]', relative text, today, yesterday; else the input."""
    raw = text(col)
    low = F.regexp_replace(F.lower(F.trim(plain_spaces(col))), r"\s+", " ")
    iso = take(raw, r"^(\d{4}-\d{2}-\d{2})(?:$|[T ])").try_cast("date")
    pattern = rf"(?:^|\D)(\d{{1,2}}) ({_NAMES})\b\.?(?: (\d{{4}}))?"

    def read(low: Column) -> Column:
        return F.coalesce(_named(low, pattern, 1, 2, 3, F.year(as_of)), _ago(low, as_of, _DAYS), F.when(F.contains(low, F.lit("aujourd")), F.to_date(as_of)), F.when(F.contains(low, F.lit("hier")), F.date_sub(as_of, 1)))

    return F.coalesce(_iso(F.coalesce(iso, let(low, read))), raw)


def relative_date(col: Column, as_of: Column, default: str = "N/A") -> Column:
    """'il y a [environ] N heures/jours/...' as a date, else ``default``; hours may cross midnight."""

    def read(low: Column) -> Column:
        hours = take(low, r"il y a (?:environ )?(\d+) heure").try_cast("int")
        return F.coalesce(_iso(F.timestamp_seconds(F.unix_timestamp(as_of.cast("timestamp")) - hours * 3600)), _iso(_ago(low, as_of, _DAYS)), F.lit(default))

    return let(F.lower(plain_spaces(col)), read)


def month_name_date(col: Column, as_of: Column) -> Column:
    """'DD Month [YYYY] HH:MM', the year maybe glued to the time; a date ahead of ``as_of`` is last year's."""
    low = F.regexp_replace(F.lower(F.trim(F.replace(text(col), F.lit("Publiée le:"), F.lit("")))), r"[-–—]", " ")
    low = F.regexp_replace(F.regexp_replace(low, r"(\d{4})(\d{2}:\d{2})", "$1 $2"), r"\s+", " ")
    pattern = rf"^(\d{{1,2}}) ({_NAMES}) (?:(\d{{4}}) )?(\d{{1,2}}:\d{{2}})"

    def past(found: Column) -> Column:
        minutes = F.split(take(found["text"], pattern, 4), ":")
        at = F.unix_timestamp(found["day"].cast("timestamp")) + minutes[0].try_cast("int") * 3600 + minutes[1].try_cast("int") * 60
        return let(at, lambda at: F.when(at.isNotNull(), _iso(F.when(at > F.unix_timestamp(as_of.cast("timestamp")), F.add_months(found["day"], -12)).otherwise(found["day"]))))

    found = let(take(low, pattern, 0), lambda t: F.struct(t.alias("text"), _named(t, pattern, 1, 2, 3, F.year(as_of)).alias("day")))
    return F.coalesce(let(found, past), F.lit(""))


def french_day_month(col: Column, as_of: Column) -> Column:
    """Aujourd'hui, Hier, 'd mois [yyyy]', 'dd.mm.yyyy'; else empty."""
    low = F.regexp_replace(F.lower(F.trim(plain_spaces(col))), r"\s+", " ")
    pattern = rf"(\d{{1,2}}) ({_NAMES})\b\.?(?: (\d{{4}}))?"

    def read(low: Column) -> Column:
        dots = F.when(low.rlike(r"^\d{2}\.\d{2}\.\d{4}$"), F.try_to_date(low, "dd.MM.yyyy"))
        return choose([(F.contains(low, F.lit("aujourd")), F.to_date(as_of)), (F.contains(low, F.lit("hier")), F.date_sub(as_of, 1))], F.coalesce(dots, _named(low, pattern, 1, 2, 3, F.year(as_of))))

    return F.coalesce(_iso(let(low, read)), F.lit(""))


def updated_on_date(col: Column) -> Column:
    """'Mis à jour le mars 3, 2025 : 4:05 PM' -> date, else empty."""
    low = F.lower(plain_spaces(col))
    pattern = rf"({_NAMES})\s+(\d{{1,2}}),\s*(\d{{4}})"
    return F.coalesce(_iso(_named(low, pattern, 2, 1, 3)), F.lit(""))


def glued_date(col: Column, as_of: Column) -> Column:
    """Aujourd'hui, Hier or '13 Jan 202511:02', else null."""
    low = F.lower(plain_spaces(col))
    pattern = rf"(\d{{1,2}}) ({_NAMES})\.? (\d{{4}})"
    return _iso(let(low, lambda low: choose([(F.contains(low, F.lit("aujourd")), F.to_date(as_of)), (F.contains(low, F.lit("hier")), F.date_sub(as_of, 1))], _named(low, pattern, 1, 2, 3))))


def format_display_date(col: Column) -> Column:
    """ISO text as 'dd/MM/yyyy HH:mm:ss', else the input."""
    at = F.coalesce(*(F.when(text(col).rlike(p), F.try_to_timestamp(col, F.lit(f))) for p, f in ((r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}$", "yyyy-MM-dd'T'HH:mm:ss"), (r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$", "yyyy-MM-dd HH:mm:ss"), (r"^\d{4}-\d{2}-\d{2}$", "yyyy-MM-dd"))))
    return F.coalesce(F.date_format(at, "dd/MM/yyyy HH:mm:ss"), col)


def dmy_or_now(col: Column, as_of: Column) -> Column:
    """'dd-MM-yyyy' as a date, else ``as_of``."""
    return F.coalesce(F.when(text(col).rlike(r"^\d{2}-\d{2}-\d{4}$"), F.try_to_date(col, "dd-MM-yyyy")), F.to_date(as_of))


