"""Scalar functions, as columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# What the formats name.
SECONDS = {"ms": 0.001, "s": 1.0, "m": 60.0, "h": 3600.0, "d": 86400.0}
MICROMETRES = {"nm": 0.001, "um": 1.0, "µm": 1.0, "mm": 1000.0, "cm": 10000.0, "m": 1000000.0}
TRUE_WORDS = ("true", "1", "yes", "y", "on")
BYTE_UNITS = ("B", "KB", "MB", "GB", "TB")
DEFAULT_MODES = ("tile", "inner_square")
ALL_MODES = ("tile", "nuclei", "cyto", "inner_square")
DEFAULT_MODE_WORDS = ("", "all", "default")
ALL_MODE_WORDS = ("full", "all4", "all_four", "full_stack")
MODE_WORDS = {
    "tile": ("tile", "full", "full_tile", "full-tile"),
    "nuclei": ("nuclei", "nucleus", "nuclear", "label", "labels"),
    "cyto": ("cyto", "cytoplasm"),
    "inner_square": ("inner", "inner_square", "inner-square", "square"),
}


def normal_id(c: Column) -> Column:
    """Trimmed, without quotes around it, and without the fraction of a whole number ('7.0' is '7')."""
    bare = F.regexp_replace(F.trim(c), "^[\"']+|[\"']+$", "")
    return F.when(bare.rlike(r"^[+-]?[0-9]+\.0+$"), F.regexp_replace(bare, r"\.0+$", "")).otherwise(bare)


def trailing_number(c: Column) -> Column:
    """The digits at the end, as a long; null without any."""
    return F.regexp_extract(c, "([0-9]+)$", 1).try_cast("long")


def seconds(c: Column) -> Column:
    """'1h 2m 3s', '12ms' or 'h:m:s' in seconds; null for anything else."""
    text = F.trim(c)
    clock = F.split(text, ":")
    by_clock = clock[0].try_cast("double") * 3600 + clock[1].try_cast("double") * 60 + clock[2].try_cast("double")
    units = F.create_map(*(F.lit(x) for kv in SECONDS.items() for x in kv))
    parts = F.regexp_extract_all(text, F.lit(r"([0-9.]+\s*(?:ms|s|m|h|d))\b"), F.lit(1))
    value = F.aggregate(parts, F.lit(0.0), lambda a, p: a + F.regexp_extract(p, r"([0-9.]+)", 1).try_cast("double") * units[F.regexp_extract(p, "([a-z]+)$", 1)])
    return F.when(text.rlike(r"^[0-9]+:[0-9]+:[0-9.]+$"), by_clock).when(F.size(parts) > 0, value)


def memory_bytes(c: Column) -> Column:
    """'1.5 GB' or '10 MiB' in bytes; every multiplier is a power of 1024."""
    text = F.upper(F.trim(c))
    number = F.regexp_extract(text, "^([0-9.]+)", 1).try_cast("double")
    unit = F.replace(F.regexp_extract(text, "([A-Z]*)$", 1), F.lit("IB"), F.lit("B"))
    power = sum((F.when(unit == u, n).otherwise(0) for n, u in enumerate(("KB", "MB", "GB", "TB"), 1)), F.lit(0))
    return F.when(unit.isin("", "B", "KB", "MB", "GB", "TB"), number * F.pow(F.lit(1024.0), power))


def safe_name(c: Column) -> Column:
    """Characters outside letters, digits, dot, dash and underscore as one underscore."""
    return F.regexp_replace(c, "[^A-Za-z0-9._-]+", "_")


def stable_id(prefix: str, *parts: Column) -> Column:
    """The prefix with 16 digits of the SHA-1 of the parts joined by tabs."""
    return F.concat(F.lit(prefix), F.substring(F.sha1(F.concat_ws("\t", *parts)), 1, 16))


def truthy(c: Column) -> Column:
    return F.lower(F.trim(c)).isin(*TRUE_WORDS)


def micrometres(value: Column, unit: Column) -> Column:
    """A length in micrometres; null for an unknown unit."""
    return value * F.create_map(*(F.lit(x) for kv in MICROMETRES.items() for x in kv))[F.lower(F.trim(unit))]


def whole_number(c: Column) -> Column:
    """Text as a whole number, its fraction cut off; null if it is none."""
    return F.trim(c).try_cast("double").cast("long")


def first_argmax(p: Column) -> Column:
    """The position from 0 of an array's largest value, the first of equals; null for an empty one."""
    return F.when(F.size(p) > 0, F.array_position(p, F.array_max(p)) - 1)


def softmax(p: Column, temperature: float) -> Column:
    """exp((p - max) / temperature), normalised."""
    e = F.transform(p, lambda x: F.exp((x - F.array_max(p)) / temperature))
    return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, y: a + y))


def json_path(text: Column, *paths: str) -> Column:
    """The first of several dotted paths that a JSON text has."""
    return F.coalesce(*(F.get_json_object(text, f"$.{p}") for p in paths))


def uncertainty(margin: Column, stability: Column, least_margin: float = 0.10, least_stability: float = 0.67) -> Column:
    """Why a cluster is or is not to be interpreted."""
    return (
        F.when(margin.isNull() | stability.isNull(), "not_assessed")
        .when((margin < least_margin) & (stability < least_stability), "low_margin_and_stability")
        .when(margin < least_margin, "low_margin")
        .when(stability < least_stability, "low_stability")
        .otherwise("accepted")
    )


def readable_bytes(c: Column) -> Column:
    """Bytes as '512 B' or '1.5 KB', in powers of 1024 up to TB; halves of the last digit go to the even one."""
    out = F.concat(c.cast("long").cast("string"), F.lit(" B"))
    for power, unit in list(enumerate(BYTE_UNITS))[1:]:
        value = F.rint(c / float(1024**power) * 10) / 10
        out = F.when(c >= float(1024**power), F.format_string(f"%.1f {unit}", value)).otherwise(out)
    return out


def readable_seconds(c: Column) -> Column:
    """Seconds as '1h 2m 3s', '2m 3s' or '3s', rounded; negative ones are 0."""
    s = F.greatest(F.rint(c).cast("long"), F.lit(0).cast("long"))
    h, m, rest = F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60
    return F.when(h > 0, F.format_string("%dh %dm %ds", h, m, rest)).when(m > 0, F.format_string("%dm %ds", m, rest)).otherwise(F.format_string("%ds", rest))


def modes(c: Column) -> Column:
    """Mode names of a text of words joined by commas or plus signs, each once, in order; an unknown word is an error."""
    text = F.lower(F.trim(F.coalesce(c, F.lit(""))))
    known = F.create_map(*(F.lit(x) for name, words in MODE_WORDS.items() for word in words for x in (word, name)))
    words = F.filter(F.transform(F.split(text, "[+,]"), lambda w: F.trim(w)), lambda w: w != "")
    named = F.array_distinct(F.transform(words, lambda w: F.coalesce(known[w], F.raise_error(F.concat(F.lit("unknown mode: "), w)).cast("string"))))
    named = F.when(F.size(words) == 0, F.raise_error(F.lit("no mode")).cast("array<string>")).otherwise(named)
    whole = [F.array(*(F.lit(m) for m in names)) for names in (DEFAULT_MODES, ALL_MODES)]
    return F.when(text.isin(*DEFAULT_MODE_WORDS), whole[0]).when(text.isin(*ALL_MODE_WORDS), whole[1]).otherwise(named)


def declared(text: Column, names: tuple[str, ...], inside: tuple[str, ...] = ("properties", "metadata", "pipeline_metadata")) -> Column:
    """The different plain values that a JSON text declares under any of `names`, in order: at its top, in the objects
    named by `inside`, in its features and in their properties. Objects, lists, nulls and blanks are left out."""
    plain = "map<string,string>"
    tops = F.array(F.from_json(text, plain), *(F.from_json(F.get_json_object(text, f"$.{p}"), plain) for p in inside))
    features = F.coalesce(F.from_json(F.get_json_object(text, "$.features"), f"array<{plain}>"), F.array().cast(f"array<{plain}>"))
    below = F.flatten(F.transform(features, lambda f: F.array(f, F.from_json(f["properties"], plain))))
    values = F.flatten(F.transform(F.concat(tops, below), lambda m: F.array(*(F.trim(m[n]) for n in names))))
    return F.array_distinct(F.filter(values, lambda v: v.isNotNull() & (v != "") & ~v.rlike(r"^[\[{]")))


def blend_weight(i: Column, n: int, least: float = 1e-3) -> Column:
    """The raised-cosine weight of position i from 0 in a patch n long, at least `least`; 1 in patches of one or two."""
    if n <= 2:
        return F.lit(1.0)
    return F.greatest(0.5 - 0.5 * F.cos(i * (2 * math.pi / (n - 1))), F.lit(least))
