"""Scalar column functions: rounding, time, text, hashes, lookups."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .vectors import ColumnLike, col

NS = 1_000_000_000


def half_even(x: ColumnLike) -> Column:
    """Rounding to the even neighbour on ties, as Python's round."""
    return F.rint(col(x))


def to_ns(seconds: float) -> int:
    """A threshold in seconds as nanoseconds, rounded half to even."""
    return round(seconds * NS)


def stamp_ns(sec: ColumnLike, nanosec: ColumnLike) -> Column:
    return col(sec).cast("long") * NS + col(nanosec).cast("long")


def chosen_time(header_ns: ColumnLike, bag_ns: ColumnLike, source: str = "header") -> Column:
    """Header time unless it is zero or missing, else bag time; or bag time always."""
    if source == "bag":
        return col(bag_ns)
    return F.coalesce(F.nullif(col(header_ns), F.lit(0).cast("long")), col(bag_ns))


def logical_time(frame: ColumnLike, fps: float) -> Column:
    """frame / fps in single precision."""
    return (col(frame).cast("float") / F.lit(fps).cast("float")).cast("float")


def clamp_to_video(seconds: ColumnLike, n_frames: ColumnLike, fps: float) -> Column:
    """A time within a video's last frame at most."""
    return F.least(col(seconds), (col(n_frames) - 0.5) / F.lit(fps))


def frame_at(seconds: ColumnLike, fps: float) -> Column:
    return F.rint(col(seconds) * fps).cast("long")


def instruction(text: ColumnLike) -> Column:
    """Lower case without punctuation, by Unicode's word characters."""
    return F.regexp_replace(F.lower(col(text)), r"(?U)[^\w\s]", "")


def episode_file(index: ColumnLike) -> Column:
    return F.format_string("episode_%06d", col(index))


def trailing_number(name: ColumnLike) -> Column:
    return F.regexp_extract(col(name), r"(\d+)(?!.*\d)", 1).cast("long")


def env_prefix(name: ColumnLike) -> Column:
    return F.split_part(col(name), F.lit("/"), F.lit(1))


def digest(payload: ColumnLike) -> Column:
    return F.sha2(col(payload), 256)


def resolve(name: ColumnLike, known: Mapping[str, str]) -> Column:
    """Case-insensitive lookup by name, then by value; null if unknown."""
    pairs = {k.lower(): v for k, v in known.items()}
    pairs |= {v.lower(): v for v in known.values() if v.lower() not in pairs}
    table = F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])
    return F.element_at(table, F.lower(col(name)))


def no_mismatch(names: ColumnLike, expected: ColumnLike) -> Column:
    """Names hold every expected one once and no other."""
    a, b = col(names), col(expected)
    return (F.size(F.array_except(b, a)) == 0) & (F.size(F.array_except(a, b)) == 0) & (F.size(F.array_distinct(a)) == F.size(a))


def first_field(*fields: ColumnLike) -> Column:
    """The first of several alternative fields that is there."""
    return F.coalesce(*[col(f) for f in fields])


def sorted_reasons(reasons: ColumnLike) -> Column:
    return F.array_sort(F.array_distinct(F.array_compact(col(reasons))))


def status(reasons: ColumnLike, warnings: ColumnLike) -> Column:
    return F.when(F.size(col(reasons)) > 0, "REJECT").when(F.size(col(warnings)) > 0, "PASS_WITH_WARNING").otherwise("PASS")
