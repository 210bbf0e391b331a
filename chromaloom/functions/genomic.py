"""Scalar functions on names, coordinates and sequences."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from itertools import cycle, islice

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Recognition sites. Fixed values.
RECOGNITION_SITES = {
    "dpnii": "GATC", "mboi": "GATC", "hindiii": "AAGCTT", "ecori": "GAATTC", "nlaiii": "CATG", "bglii": "AGATCT", "ncoi": "CCATGG", "bamhi": "GGATCC", "msei": "TTAA", "csp6i": "GTAC", "taqi": "TCGA",
}


def recognition_site(enzyme: str) -> str:
    """The site of an enzyme's name; a sequence of bases is its own site."""
    if re.fullmatch(r"[ACGTacgt]+", enzyme):
        return enzyme.upper()
    if enzyme.lower() not in RECOGNITION_SITES:
        raise ValueError(f"no enzyme called {enzyme} is known")
    return RECOGNITION_SITES[enzyme.lower()]


def coordinate_text(chrom: Column, start: Column, end: Column) -> Column:
    return F.format_string("%s:%d-%d", chrom, start, end)


def coordinate_parts(text: Column) -> Column:
    """``chrom:start-end`` (also ``chrom start end`` by tabs) -> struct; NULLs where it isn't one."""
    pattern = r"^([^:\s]+)[:\t]([0-9,]+)[-\t]([0-9,]+)$"
    number = lambda i: F.regexp_replace(F.regexp_extract(text, pattern, i), ",", "").try_cast("bigint")
    chrom = F.when(text.rlike(pattern), F.regexp_extract(text, pattern, 1))
    return F.struct(chrom.alias("chrom"), number(2).alias("start_pos"), number(3).alias("end_pos"))


def is_coordinate(text: Column) -> Column:
    parts = coordinate_parts(text)
    return F.coalesce(parts["start_pos"] <= parts["end_pos"], F.lit(False))


def valid_viewpoint_name(name: Column) -> Column:
    return F.coalesce(name.rlike(r"^[A-Za-z0-9_\-]+$"), F.lit(False))


def ends_with_name(text: Column, name: str) -> Column:
    """Ends with a name, taken literally."""
    return text.endswith(name)


def seeded_hash(*columns: Column) -> Column:
    """XXH64 with seed 42 as a signed number."""
    return F.xxhash64(*columns)


def flag_set(flags: Column, bit: int) -> Column:
    return flags.bitwiseAND(F.lit(bit)) != 0


def first_match(text: Column, table: Sequence[tuple[str, str]], default: str | None = None) -> Column:
    """The value of the first key that the text contains."""
    out = F.lit(default)
    for key, value in reversed(table):
        out = F.when(F.contains(text, F.lit(key)), value).otherwise(out)
    return out


def percentage(part: Column, whole: Column) -> Column:
    """NULL of nothing."""
    return F.try_divide(part * 100.0, whole.cast("double"))


def human_bases(n: int) -> str:
    """1500 -> 1.5kb."""
    for size, unit in ((10**9, "Gb"), (10**6, "Mb"), (10**3, "kb")):
        if abs(n) >= size:
            return f"{n / size:g}{unit}"
    return f"{n}bp"


_ON, _OFF = {"true", "t", "on", "yes", "y", "1"}, {"", "none", "f", "n", "no", "false", "off", "0", "null", "na"}


def is_on(x: object) -> bool:
    return str(x).strip().lower() in _ON


def is_off(x: object) -> bool:
    return x is None or str(x).strip().lower() in _OFF


def is_none(x: object) -> bool:
    return x is None or str(x).strip().lower() in {"", "none", "null", "na"}


def bin_sizes(text: str | int | Iterable[int]) -> list[int]:
    """Sizes from a number, a text of numbers, or a list; none gives an empty list."""
    if isinstance(text, int):
        return [text]
    if isinstance(text, str):
        return [] if is_off(text) else [int(float(x)) for x in re.split(r"[,;\s]+", text.strip()) if x]
    return [int(x) for x in text]


def for_each_file(argument: Sequence, n: int) -> list:
    """An argument for each of n files: as it is, or one repeated."""
    return list(islice(cycle(argument), n)) if len(argument) == 1 else list(argument)
