"""Path and tag columns: names, ancestors, flattening, hashed names, tag spelling, export sizes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Tags that keep their underscores.
KAOMOJI = ["0_0", "(o)_(o)", "+_+", "+_-", "._.", "<o>_<o>", "<|>_<|>", "=_=", ">_<", "3_3", "6_9", ">_o", "@_@", "^_^", "o_o", "u_u", "x_x", "|_|", "||_||"]


def posix(path: Column) -> Column:
    return F.translate(path, "\\", "/")


def basename(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def dirname(path: Column) -> Column:
    return F.regexp_replace(path, r"/?[^/]*$", "")


def extension(path: Column) -> Column:
    """With its dot, lower case; a leading dot doesn't start one."""
    return F.lower(F.regexp_extract(basename(path), r"^\.*[^.].*(\.[^.]*)$", 1))


def flattened(path: Column) -> Column:
    return F.translate(path, "/\\", "__")


def inside(path: Column, folder: str | Column) -> Column:
    """Whether folder is a strict ancestor, by whole components."""
    folder = F.lit(folder) if isinstance(folder, str) else folder
    return F.startswith(path, F.concat(folder, F.lit("/")))


def inside_or_equal(path: Column, folder: str) -> Column:
    return (path == folder) | inside(path, folder)


def rebased(dataset: Column, path: Column) -> Column:
    return F.concat_ws("/", dataset, path)


def hashed_name(path: Column) -> Column:
    return F.concat(F.md5(path), extension(path))


def tag_spelling(tag: Column) -> Column:
    """Underscores become spaces, but in the fixed faces."""
    return F.when(tag.isin(KAOMOJI), tag).otherwise(F.replace(tag, F.lit("_"), F.lit(" ")))


def escaped_tags(tags: Column) -> Column:
    return F.replace(F.replace(F.array_join(tags, ","), F.lit("("), F.lit("\\(")), F.lit(")"), F.lit("\\)"))


def export_size(width: Column, height: Column, most: int) -> tuple[Column, Column]:
    """Both sides after shrinking to at most so many pixels; smaller images stay."""
    ratio = width / height
    new_height = F.floor(F.sqrt(F.lit(float(most)) / ratio))
    small = width * height <= most
    return F.when(small, width).otherwise(F.floor(new_height * ratio)).cast("long"), F.when(small, height).otherwise(new_height).cast("long")


def same_area(width: Column, height: Column, area: float) -> tuple[Column, Column]:
    scale = F.sqrt(F.lit(area) / (width * height))
    return F.ceil(width * scale), F.ceil(height * scale)


def quantized(x: Column, low: float, high: float, levels: int) -> Column:
    clipped = F.least(F.greatest(x, F.lit(low)), F.lit(high))
    return F.least(F.floor(levels * (clipped - low) / (high - low)), F.lit(levels - 1)).cast("long")


def dequantized(q: Column, low: float, high: float, levels: int) -> Column:
    return (q + 0.5) * (high - low) / levels + low


def uniform(key: Column) -> Column:
    """A number in [0, 1) from a key's md5: the same in every engine and run."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)
