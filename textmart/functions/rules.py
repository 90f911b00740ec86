"""Rule-based attributes as column expressions.

Each rule is an ordered ``CASE WHEN`` or a regex extraction, so tagging a
record costs a few codegen'd string scans and no Python.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from textmart import dictionaries as D


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lower(c: str | Column) -> Column:
    return F.lower(F.coalesce(_col(c), F.lit("")))


def contains_any(text: Column, needles: Sequence[str]) -> Column:
    """True when any literal needle is a substring of ``text`` (short-circuit OR)."""
    cond = F.lit(False)
    for n in needles:
        cond = cond | text.contains(n)
    return cond


def part_of_day(ts: str | Column, names: Sequence[str] = D.PERIODS) -> Column:
    """F8: hour in [0,12) -> first name, [12,18) -> second, else third (wall-clock hour)."""
    h = F.hour(_col(ts))
    return F.when(h < 12, F.lit(names[0])).when(h < 18, F.lit(names[1])).otherwise(F.lit(names[2]))


def period_order(period: str | Column, names: Sequence[str] = D.PERIODS) -> Column:
    """Display order of a part of day (0, 1, 2)."""
    p = _col(period)
    return F.when(p == names[0], 0).when(p == names[1], 1).otherwise(2)


def experience_years(content: str | Column, *, pattern: str = D.EXPERIENCE_PATTERN,
                     cap: int | None = None) -> Column:
    """number before "years"/"років"... (first match); 0 when absent or not a 64-bit number.

    ``cap`` (``D.EXPERIENCE_CAP`` in the original) limits the value; without it values are kept as written.
    """
    m = F.regexp_extract(_lower(content), "(?U)" + pattern, 1)
    years = F.coalesce(m.try_cast("long"), F.lit(0))
    return years if cap is None else F.least(years, F.lit(cap))


def technologies(content: str | Column, keywords: Mapping[str, Sequence[str]] = D.TECH_KEYWORDS) -> Column:
    """tags (dictionary order, each once) with any alias inside lower(content)."""
    t = _lower(content)
    return F.array_compact(F.array(*[
        F.when(contains_any(t, aliases), F.lit(tag)) for tag, aliases in keywords.items()]))


def job_level(title: str | Column, content: str | Column,
              rules: Sequence[tuple[str, Sequence[str]]] = D.LEVEL_RULES,
              default: str = "Not Specified") -> Column:
    """first rule whose substrings occur in lower(title + ' ' + content)."""
    t = F.lower(F.concat_ws(" ", F.coalesce(_col(title), F.lit("")), F.coalesce(_col(content), F.lit(""))))
    expr = None
    for level, needles in rules:
        cond = contains_any(t, needles)
        expr = F.when(cond, F.lit(level)) if expr is None else expr.when(cond, F.lit(level))
    return expr.otherwise(F.lit(default))


def experience_band(years: str | Column) -> Column:
    """0 -> 0, 1-2 -> 1, 3-4 -> 2, 5+ -> 3."""
    y = _col(years)
    return F.when(y == 0, 0).when(y <= 2, 1).when(y <= 4, 2).otherwise(3)


def experience_band_label(years: str | Column, labels: Sequence[str] = D.EXPERIENCE_BANDS) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in labels]), experience_band(years) + 1)


def date_part(time_str: str | Column) -> Column:
    """second whitespace-separated token when the value contains a blank, else the value."""
    t = F.coalesce(_col(time_str), F.lit(""))
    second = F.get(F.split(F.trim(t), r"\s+"), 1)
    return F.when(t.contains(" "), F.coalesce(second, t)).otherwise(t)


def day_string(ts: str | Column) -> Column:
    """``dd.MM.yyyy`` of a timestamp or date."""
    return F.date_format(_col(ts), D.DAY_FORMAT)


def parse_iso_minutes(time_str: str | Column) -> Column:
    """``yyyy-MM-ddTHH:mm[:ss][+hh:mm]`` -> wall-clock TIMESTAMP_NTZ (offset ignored, no UTC shift)."""
    t = F.coalesce(_col(time_str), F.lit(""))
    return F.coalesce(
        F.try_to_timestamp(F.substring(t, 1, 19), F.lit("yyyy-MM-dd'T'HH:mm:ss")).cast("timestamp_ntz"),
        F.try_to_timestamp(F.substring(t, 1, 16), F.lit("yyyy-MM-dd'T'HH:mm")).cast("timestamp_ntz"),
    )


def iso_from_clock_date(text: str | Column, *, offset: str = "+02:00") -> Column:
    """``HH:mm dd.MM.yyyy ...`` -> ``yyyy-MM-ddTHH:mm+02:00`` (null when the date does not parse)."""
    parts = F.split(F.trim(F.coalesce(_col(text), F.lit(""))), r"\s+")
    day = F.try_to_timestamp(F.get(parts, 1), F.lit(D.DAY_FORMAT))
    return F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T"), F.get(parts, 0), F.lit(offset))


def iso_from_date_and_clock(date: str | Column, clock: str | Column, *, offset: str = "+02:00") -> Column:
    """Listing date + ``HH:mm`` text -> ``yyyy-MM-ddTHH:mm+02:00``."""
    return F.concat(F.date_format(_col(date), "yyyy-MM-dd"), F.lit("T"), F.trim(_col(clock)), F.lit(offset))


def analyst_job(title: str | Column, content: str | Column, *,
                title_keywords: Sequence[str] = D.ANALYST_KEYWORDS,
                content_phrase: str = "data analyst", prefix_chars: int | None = None) -> Column:
    """A title keyword, or the phrase anywhere in the content (in its first ``prefix_chars`` characters, if given)."""
    t = _lower(title)
    text = F.coalesce(_col(content), F.lit(""))
    if prefix_chars is not None:
        text = F.left(text, F.lit(prefix_chars))
    return contains_any(t, title_keywords) | F.lower(text).contains(content_phrase)


def keyword_job(title: str | Column, content: str | Column, *,
                keywords: Sequence[str] = D.ANALYST_FILTER_KEYWORDS) -> Column:
    """Any keyword in lower(title) or lower(content)."""
    return contains_any(_lower(title), keywords) | contains_any(_lower(content), keywords)
