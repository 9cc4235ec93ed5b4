"""Scalar and array columns: numbers, names, sequences, polygons, colours, file signatures."""

from __future__ import annotations

from math import pi

from pyspark.sql import Column
from pyspark.sql import functions as F


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def next_multiple(x: Column, of: int) -> Column:
    return (F.ceil(x / of) * of).cast("long")


def one_cycle(step: Column, low: float, high: float, steps: int) -> Column:
    """From low to high along half a cosine."""
    return (1 - F.cos(step * pi / steps)) / 2 * (high - low) + low


def human_bytes(n: Column) -> Column:
    """1.5 KB, 3.0 MB: by steps of 1024 up to YB."""
    units = F.array(*[F.lit(u) for u in ("", "K", "M", "G", "T", "P", "E", "Z", "Y")])
    step = F.least(F.greatest(F.floor(F.log(F.greatest(F.abs(n), F.lit(1)).cast("double")) / F.log(F.lit(1024.0)) + 1e-12), F.lit(0)), F.lit(8)).cast("int")
    return F.concat(F.format_string("%.1f ", n / F.pow(F.lit(1024.0), step)), F.get(units, step), F.lit("B"))


def answer(text: Column, prompt: str, stop: str) -> Column:
    """What was written after the prompt, without white space around it and without the stop string at its end."""
    own = F.trim(F.when(F.startswith(text, F.lit(prompt)), F.substring(text, F.lit(len(prompt) + 1), F.length(text))).otherwise(text))
    return F.trim(F.when(F.endswith(own, F.lit(stop)), F.substring(own, F.lit(1), F.length(own) - len(stop))).otherwise(own))


def plain_name(text: Column) -> Column:
    """Characters that names of streams may not hold become underscores."""
    return F.regexp_replace(text, r"[|@#!¡·$€%&()=?¿^*;:,¨´><+]", "_")


def padded(x: Column, size: Column, value, left: bool = False) -> Column:
    fill = F.array_repeat(F.lit(value), F.greatest(size - F.size(x), F.lit(0)))
    return F.concat(fill, x) if left else F.concat(x, fill)


def resampled(points: Column, n: int) -> Column:
    """n numbers along a list of numbers, by linear interpolation between neighbours; its ends stay."""
    last = F.size(points) - 1

    def at(k: Column) -> Column:
        place = k * last / (n - 1)
        low = F.least(F.floor(place).cast("int"), F.greatest(last - 1, F.lit(0)))
        return F.get(points, low) + (F.coalesce(F.get(points, low + 1), F.get(points, low)) - F.get(points, low)) * (place - low)

    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), at)


def luma(r: Column, g: Column, b: Column) -> Column:
    """Y of YCbCr (BT.601) of 8-bit colours, from 16 to 235."""
    return (65.481 * r + 128.553 * g + 24.966 * b) / 255.0 + 16.0


def saturation(r: Column, g: Column, b: Column) -> Column:
    """Of the HSL cone, 0 to 1, of 8-bit colours."""
    most, least = F.greatest(r, g, b) / 255.0, F.least(r, g, b) / 255.0
    light, gap = (most + least) / 2, most - least
    return F.when(gap == 0, 0.0).when(light > 0.5, gap / (2 - most - least)).otherwise(gap / (most + least))


def thirds(x: Column) -> Column:
    """1 on the lines of thirds (x from 0 to 1 at the edge), falling to 0 beside them."""
    place = ((x - 1.0 / 3 + 1.0) % 2.0 * 0.5 - 0.5) * 16
    return F.greatest(1.0 - place * place, F.lit(0.0))


def scored_tags(tags: Column, least: float) -> Column:
    """Names of an array of (name, p) whose p is at least a threshold, best first, joined by commas."""
    kept = F.filter(tags, lambda t: t["p"] >= least)
    order = F.array_sort(F.transform(kept, lambda t: F.struct((-t["p"]).alias("k"), t["name"].alias("name"))))
    return F.array_join(F.transform(order, lambda t: t["name"]), ",")


def unsure_points(scores: Column, least: float = 0.3) -> Column:
    """Places of points whose score is below a threshold."""
    marked = F.transform(scores, lambda s, i: F.when(s < least, i))
    return F.array_compact(marked)


def file_kind(content: Column) -> Column:
    """png, jpeg, gif or null by the first bytes."""
    head = F.hex(F.substring(content, 1, 32))
    return (
        F.when(F.startswith(head, F.lit("89504E470D0A1A0A")), "png")
        .when(F.startswith(head, F.lit("474946383761")) | F.startswith(head, F.lit("474946383961")), "gif")
        .when(F.startswith(head, F.lit("FFD8")) | F.substring(head, 13, 8).isin("4A464946", "45786966") | F.contains(F.substring(head, 1, 46), F.lit("4A464946")), "jpeg")
    )
