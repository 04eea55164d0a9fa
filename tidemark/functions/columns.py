"""Column expressions shared by the operators. All are built-in functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# A character that is part of a word, in any script; ``\b`` differs between Java versions and engines.
WORD_CHAR = r"\p{L}\p{N}_"
_SPECIAL = str.maketrans({c: "\\" + c for c in "\\.^$*+?()[]{}|"})


def field(path: str, inside: str | None = None) -> Column:
    """A nested field, below ``inside`` when given."""
    return F.col(f"{inside}.{path}" if inside else path)


def text_of(inside: str | None = None, text_fields: Sequence[str] = ("full_text", "text")) -> Column:
    """The first filled text field of a post."""
    return F.coalesce(*[field(name, inside) for name in text_fields])


def any_case(pattern: str) -> str:
    return f"(?i){pattern}"


def whole_words(words: Sequence[str]) -> str:
    """A pattern that finds any of ``words`` standing alone; meant for lower-cased text.

    Each word comes first in its branch and is looked back over, so that most places of a text are
    passed at the first character; measured twice as fast as testing the place before the word.
    """
    plain = [word.translate(_SPECIAL) for word in words]
    branches = "|".join(f"{word}(?<![{WORD_CHAR}]{word})" for word in plain)
    return f"({branches})(?![{WORD_CHAR}])"


def post_day(created_at: Column) -> Column:
    """Date of 'Sat Aug 26 21:39:07 +0000 2017'; NULL when the text is malformed."""
    day_text = F.concat(F.substring(created_at, 5, 7), F.substring(created_at, 27, 4))
    return F.try_to_timestamp(day_text, F.lit("MMM dd yyyy")).cast("date")


def post_minute(created_at: Column) -> Column:
    """'21:39' of 'Sat Aug 26 21:39:07 +0000 2017'."""
    return F.concat(F.substring(created_at, 12, 2), F.lit(":"), F.substring(created_at, 15, 2))


def post_time(created_at: Column) -> Column:
    """The instant of 'Sat Aug 26 21:39:07 +0000 2017'; the day name cannot be parsed and is cut."""
    return F.try_to_timestamp(F.substring(created_at, 5, 26), F.lit("MMM dd HH:mm:ss Z yyyy"))


def point_axis(coordinates: Column, axis: int) -> Column:
    """Axis 0 (longitude) or 1 (latitude) of the text '[lon, lat]'."""
    return F.get(F.from_json(coordinates, "array<double>"), F.lit(axis))


def box_centre_axis(box: Column, axis: int) -> Column:
    """Centre of the text '[[[lon, lat], ...]]' along one axis."""
    ring = F.get(F.from_json(box, "array<array<array<double>>>"), F.lit(0))
    values = F.transform(ring, lambda corner: F.get(corner, F.lit(axis)))
    return (F.array_min(values) + F.array_max(values)) / 2


def hash_text(key: Column, seed: int) -> Column:
    """A draw for each key that any engine can repeat: MD5, in hexadecimal, of the key as text and the seed."""
    return F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f":{seed}")).cast("binary"))


def hash_limit(share: float) -> str:
    """The text below which that share of the draws lies."""
    return f"{min(round(share * 2**32), 2**32 - 1):08x}"


def unused_name(taken: Sequence[str], wanted: str) -> str:
    """A column name that is not taken in any case: ``wanted``, with underscores as needed."""
    names = {name.lower() for name in taken}
    while wanted.lower() in names:
        wanted += "_"
    return wanted


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as double, NULL unless ``whole`` is above zero."""
    return F.when(whole > 0, part.cast("double") / whole.cast("double"))


def utc_day(when: Column) -> Column:
    """The date of a point in time in UTC, whatever the session's time zone."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(when) / 86_400).cast("int"))


def found_keywords(text: Column, keywords: Sequence[str]) -> Column:
    """The keywords contained in ``text`` in any case, comma separated, in the order given."""
    lowered = F.lower(text)
    return F.concat_ws(", ", *[F.when(lowered.contains(word.lower()), F.lit(word)) for word in keywords])
