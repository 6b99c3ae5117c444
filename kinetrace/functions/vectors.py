"""Column functions on numeric vectors (ARRAY of FLOAT or DOUBLE): layout, padding, normalisation.

Python's half-open [start, end) is used for ranges throughout.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def col(x: ColumnLike) -> Column:
    return F.col(x) if isinstance(x, str) else x


def doubles(v: ColumnLike) -> Column:
    return col(v).cast("array<double>")


def let(f, *args: ColumnLike) -> Column:
    """f of the arguments, each computed once however often f mentions it: an expression that names
    another several times repeats it, and nested ones would grow with the power of their depth."""
    whole = F.struct(*[col(a).alias(f"_{i}") for i, a in enumerate(args)])
    return F.get(F.transform(F.array(whole), lambda s: f(*[s[f"_{i}"] for i in range(len(args))])), F.lit(0))


def part(v: ColumnLike, start: int, end: int) -> Column:
    """v[start:end]."""
    return F.slice(col(v), start + 1, max(0, end - start))


def groups(v: ColumnLike, layout: Mapping[str, tuple[int, int]]) -> list[Column]:
    """One column per named range of a layout."""
    return [part(v, a, b).alias(name) for name, (a, b) in layout.items()]


def joined(*vs: ColumnLike) -> Column:
    """Vectors one after the other."""
    return F.concat(*[col(v) for v in vs])


def gather(v: ColumnLike, ids: Sequence[int]) -> Column:
    """[v[i] for i in ids]."""
    return F.array(*[F.get(col(v), F.lit(i)) for i in ids])


def reordered(names: ColumnLike, values: ColumnLike, target: Sequence[str]) -> Column:
    """Values put into the order of `target` by name; null where a name is missing."""
    pairs = F.map_from_arrays(col(names), col(values))
    return F.transform(F.array(*[F.lit(t) for t in target]), lambda n: F.element_at(pairs, n))


def ranges(sizes: Mapping[str, int]) -> dict[str, tuple[int, int]]:
    """Name -> [start, end) of groups laid one after the other."""
    out, at = {}, 0
    for name, n in sizes.items():
        out[name] = (at, at + n)
        at += n
    return out


def decoded_groups(chunk: ColumnLike, sizes: Mapping[str, int], horizon: int) -> list[Column]:
    """A flat chunk of actions as one column per group: the first `horizon` steps, each cut to the
    group's dimensions, which follow one another in the order given."""
    steps = F.slice(col(chunk), 1, horizon)

    def group(a: int, b: int) -> Column:
        return F.transform(steps, lambda v: part(v, a, b))

    return [group(a, b).alias(name) for name, (a, b) in ranges(sizes).items()]


def element_names(sizes: Mapping[str, int]) -> list[str]:
    return [f"{name}_{i}" for name, n in sizes.items() for i in range(n)]


def padded(v: ColumnLike, size: int) -> Column:
    """v with zeros up to `size` elements."""
    return F.concat(col(v), F.array_repeat(F.lit(0.0), F.greatest(F.lit(0), F.lit(size) - F.size(col(v)))))


def pad_mask(v: ColumnLike, size: int) -> Column:
    """1 where padded(v, size) holds a value of v, 0 elsewhere."""
    return F.transform(F.sequence(F.lit(1), F.lit(size)), lambda i: F.when(i <= F.size(col(v)), 1).otherwise(0))


def padded_chunk(chunk: ColumnLike, horizon: int, size: int) -> Column:
    """A chunk (array of vectors) with zeros up to horizon x size."""
    rows = F.transform(col(chunk), lambda v: padded(v, size))
    blank = F.array_repeat(F.array_repeat(F.lit(0.0), size), F.greatest(F.lit(0), F.lit(horizon) - F.size(col(chunk))))
    return F.concat(rows, blank)


def chunk_mask(chunk: ColumnLike, horizon: int, size: int) -> Column:
    rows = F.transform(col(chunk), lambda v: pad_mask(v, size))
    blank = F.array_repeat(F.array_repeat(F.lit(0), size), F.greatest(F.lit(0), F.lit(horizon) - F.size(col(chunk))))
    return F.concat(rows, blank)


def last_n(v: ColumnLike, n: int) -> Column:
    """The last n elements, or all if there are fewer."""
    return F.slice(col(v), F.greatest(F.lit(1), F.size(col(v)) - n + 1), n)


def dot(a: ColumnLike, b: ColumnLike) -> Column:
    return F.aggregate(F.zip_with(doubles(a), doubles(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(v: ColumnLike) -> Column:
    return F.sqrt(dot(v, v))


def cosine(a: ColumnLike, b: ColumnLike) -> Column:
    return dot(a, b) / (norm(a) * norm(b))


def minus(a: ColumnLike, b: ColumnLike) -> Column:
    return F.zip_with(doubles(a), doubles(b), lambda x, y: x - y)


def plus(a: ColumnLike, b: ColumnLike) -> Column:
    return F.zip_with(doubles(a), doubles(b), lambda x, y: x + y)


def scaled(v: ColumnLike, s: Column) -> Column:
    """v times s, which is computed once and not for each element."""
    return let(lambda k: F.transform(doubles(v), lambda x: x * k), s)


def lerp(a: ColumnLike, b: ColumnLike, f: Column) -> Column:
    return F.zip_with(doubles(a), doubles(b), lambda x, y: x + f * (y - x))


def max_abs(v: ColumnLike) -> Column:
    return F.array_max(F.transform(doubles(v), F.abs))


def finite(v: ColumnLike) -> Column:
    """All elements are finite; null elements are not."""
    return F.forall(doubles(v), lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))


def in_range(v: ColumnLike, lo: float, hi: float) -> Column:
    return ~F.exists(doubles(v), lambda x: (x < lo) | (x > hi))


def close(a: Column, b: Column) -> Column:
    return F.abs(a - b) <= F.lit(1e-8) + F.lit(1e-5) * F.abs(b)


def at(v: ColumnLike, i: Column) -> Column:
    return F.get(doubles(v), i)


def clipped(v: ColumnLike, lo: float = -1.0, hi: float = 1.0) -> Column:
    return F.transform(doubles(v), lambda x: F.greatest(F.lit(lo), F.least(F.lit(hi), x)))


def min_max(v: ColumnLike, lo: ColumnLike, hi: ColumnLike) -> Column:
    """To [-1, 1]; dimensions whose bounds agree become 0."""
    return F.transform(doubles(v), lambda x, i: F.when(close(at(hi, i), at(lo, i)), 0.0).otherwise(2 * (x - at(lo, i)) / (at(hi, i) - at(lo, i)) - 1))


def min_max_back(v: ColumnLike, lo: ColumnLike, hi: ColumnLike) -> Column:
    """From [-1, 1]; values are clipped to it first."""
    return F.transform(clipped(v), lambda x, i: (x + 1) / 2 * (at(hi, i) - at(lo, i)) + at(lo, i))


def mean_std(v: ColumnLike, mean: ColumnLike, std: ColumnLike) -> Column:
    """Standard scores; dimensions without spread pass through."""
    return F.transform(doubles(v), lambda x, i: F.when(at(std, i) == 0, x).otherwise((x - at(mean, i)) / at(std, i)))


def mean_std_back(v: ColumnLike, mean: ColumnLike, std: ColumnLike) -> Column:
    return F.transform(doubles(v), lambda x, i: F.when(at(std, i) == 0, x).otherwise(x * at(std, i) + at(mean, i)))


def sin_cos(v: ColumnLike) -> Column:
    """All sines, then all cosines: twice the dimensions."""
    return F.concat(F.transform(doubles(v), F.sin), F.transform(doubles(v), F.cos))


def state_group(v: ColumnLike, params: Mapping[str, ColumnLike], mode: str, clip: bool = True) -> Column:
    """One group of a state by its mode: sin_cos, mean_std, or min_max, of which only the last clips."""
    if mode == "sin_cos":
        return sin_cos(v)
    if mode == "mean_std":
        return mean_std(v, params["mean"], params["std"])
    if mode == "min_max":
        out = min_max(v, params["min"], params["max"])
        return clipped(out) if clip else out
    raise ValueError(f"unknown mode {mode!r}: sin_cos, mean_std, min_max")


def state_group_back(v: ColumnLike, params: Mapping[str, ColumnLike], mode: str) -> Column:
    if mode == "mean_std":
        return mean_std_back(v, params["mean"], params["std"])
    if mode == "min_max":
        return min_max_back(v, params["min"], params["max"])
    raise ValueError(f"mode {mode!r} can't be inverted")


def action_group(chunk: ColumnLike, params: Mapping[str, ColumnLike], mode: str, reference: ColumnLike | None = None, clip: bool = True) -> Column:
    """A chunk of actions: relative to the reference where one is given, then normalised by step;
    both modes clip."""
    rows = col(chunk)
    if reference is not None:
        rows = F.transform(rows, lambda v: minus(v, reference))
    one = min_max if mode == "min_max" else mean_std
    a, b = ("min", "max") if mode == "min_max" else ("mean", "std")
    out = F.transform(rows, lambda v: one(v, params[a], params[b]))
    return F.transform(out, lambda v: clipped(v)) if clip else out


def action_group_back(chunk: ColumnLike, params: Mapping[str, ColumnLike], mode: str, reference: ColumnLike | None = None) -> Column:
    one = min_max_back if mode == "min_max" else mean_std_back
    a, b = ("min", "max") if mode == "min_max" else ("mean", "std")
    out = F.transform(col(chunk), lambda v: one(v, params[a], params[b]))
    return out if reference is None else F.transform(out, lambda v: plus(v, reference))


def dimensions(sizes: Mapping[str, int], sin_cos_groups: Sequence[str] = ()) -> int:
    """Elements of a state after processing: sin_cos groups count twice."""
    return sum(n * (2 if g in sin_cos_groups else 1) for g, n in sizes.items())
