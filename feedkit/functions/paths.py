"""Lexical path functions: clean, join, directory part and relative path.

A path is worked on as an array of its elements, so every function stays a native expression.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedkit.functions.binding import let

# An element that is empty, `.` or `..`; a leading slash counts, which only costs a fold.
_UNCLEAN = r"(?:^|/)\.{0,2}(?:/|\z)"
# The same for a path that ends in a slash.
_UNCLEAN_FOLDER = r"(?:^|/)\.{0,2}/"


def _fold(path: Column, finish: Callable[[Column], Column] | None = None) -> Column:
    """Elements of the cleaned path, without the root mark; `path` must be cheap to repeat."""
    rooted = path.startswith("/")

    def step(stack: Column, part: Column) -> Column:
        can_climb = (F.size(stack) > 0) & (F.try_element_at(stack, F.lit(-1)) != "..")
        climbed = F.when(can_climb, F.slice(stack, F.lit(1), F.size(stack) - 1)).otherwise(
            F.when(rooted, stack).otherwise(F.array_append(stack, part))
        )
        return (
            F.when((part == "") | (part == "."), stack)
            .when(part == "..", climbed)
            .otherwise(F.array_append(stack, part))
        )

    start = F.expr("cast(array() as array<string>)")
    return F.aggregate(F.split(path, "/"), start, step, finish)


def clean(path: Column) -> Column:
    """Shortest equivalent path; the empty path is `.`.

    Most paths are clean already, which a pattern can tell; only the others are folded.
    """

    def spelled(p: Column) -> Column:
        def finish(stack: Column) -> Column:
            joined = F.array_join(stack, "/")
            return (
                F.when(p.startswith("/"), F.concat(F.lit("/"), joined))
                .when(F.size(stack) == 0, F.lit("."))
                .otherwise(joined)
            )

        return _fold(p, finish)

    return F.when(path.rlike(_UNCLEAN), let(path, spelled)).otherwise(path)


def join(*parts: Column) -> Column:
    """Join the parts that are not empty and clean the result; all empty gives the empty path."""
    joined = F.concat_ws("/", *[F.nullif(p, F.lit("")) for p in parts])
    return let(joined, lambda j: F.when(j == "", F.lit("")).otherwise(clean(j)))


def dirname(path: Column) -> Column:
    """Everything up to and including the last slash."""
    return F.regexp_extract(path, r"^((?s:.*/)?)", 1)


def escapes(cleaned: Column) -> Column:
    """True where a cleaned path climbs out of its base; this is a test on the text prefix."""
    return cleaned.startswith("..")


def rel(base: Column, target: Column) -> Column:
    """Path that leads from directory `base` to `target`, null where none can be told."""

    def parts(p: Column) -> Column:
        return F.filter(F.split(clean(p), "/"), lambda e: (e != "") & (e != "."))

    def led(pair: Column) -> Column:
        here, there = pair["base"], pair["target"]
        mismatch = F.filter(
            F.sequence(F.lit(0), F.least(F.size(here), F.size(there))),
            lambda i: F.coalesce(F.get(here, i) != F.get(there, i), F.lit(True)),
        )

        def spelled(common: Column) -> Column:
            up = F.array_repeat(F.lit(".."), F.size(here) - common)
            down = F.slice(there, common + 1, F.size(there))
            steps = F.concat(up, down)
            unknown = F.coalesce(F.get(here, common) == "..", F.lit(False))
            return F.when(~unknown, F.when(F.size(steps) == 0, F.lit(".")).otherwise(F.array_join(steps, "/")))

        return let(F.array_min(mismatch), spelled)

    led_from = let(F.struct(parts(base).alias("base"), parts(target).alias("target")), led)
    # A target right below the base is the common case.
    below = target.startswith(base) & base.endswith("/") & ~base.rlike(_UNCLEAN_FOLDER) & ~target.rlike(_UNCLEAN)
    return (
        F.when(below, F.substr(target, F.length(base) + 1))
        .when(base.startswith("/") == target.startswith("/"), led_from)
    )


def walk_key(path: Column) -> Column:
    """Sort key of a directory walk: element by element, not character by character."""
    return F.split(path, "/")
