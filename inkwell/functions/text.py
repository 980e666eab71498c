"""String functions: stripping, folding, path and name rules, tokens."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Device names that a portable file name must not have, fixed values.
RESERVED = ["con", "prn", "aux", "nul", *[f"com{k}" for k in range(1, 10)], *[f"lpt{k}" for k in range(1, 10)]]
BLANK = r"^\s+|\s+$"


def strip(c: Column) -> Column:
    """Without white space at either end (``trim`` drops spaces only)."""
    return F.regexp_replace(c, BLANK, "")


def fold(c: Column) -> Column:
    """Case-insensitive key; a sharp s folds to two letters."""
    return F.lower(F.upper(c))


def is_leaf(c: Column) -> Column:
    """A file name without folders, drive or relative parts."""
    return (c != "") & ~c.isin(".", "..") & ~c.rlike(r"[/\\]") & ~c.rlike(r"^[A-Za-z]:")


def is_leaf_strict(c: Column) -> Column:
    """``is_leaf`` without NUL characters."""
    return is_leaf(c) & (F.instr(c, "\0") == 0)


def is_leaf_png(c: Column) -> Column:
    return is_leaf(c) & (c == strip(c)) & F.lower(c).endswith(".png")


def suffix(c: Column) -> Column:
    return F.regexp_extract(F.lower(c), r"(\.[^./\\]+)$", 1)


def base_name(c: Column) -> Column:
    """Last part of a path with either kind of slash."""
    return F.element_at(F.split(F.replace(c, F.lit("\\"), F.lit("/")), "/"), -1)


def font_display(c: Column) -> Column:
    """Font file as a title: no suffix, no ``-regular``, dashes and underscores as spaces."""
    stem = F.regexp_replace(base_name(c), r"\.[^.]+$", "")
    return F.initcap(F.regexp_replace(F.regexp_replace(F.lower(stem), "-regular", ""), "[-_]", " "))


def dataset_name(c: Column) -> Column:
    """Portable data set name: digits become ``dataset_NNN``; null where it is not portable."""
    s = strip(c)
    digits = s.try_cast("int").cast("string")
    padded = F.when(F.length(digits) < 3, F.lpad(digits, 3, "0")).otherwise(digits)
    wide = F.when(s.rlike("^[0-9]{1,9}$"), F.concat(F.lit("dataset_"), padded)).otherwise(s)
    stem = F.lower(F.split(wide, r"\.").getItem(0))
    ok = (F.length(wide) <= 200) & wide.rlike(r"^[A-Za-z0-9][A-Za-z0-9._ -]*$") & ~wide.rlike(r"[. ]$") & ~stem.isin(*RESERVED)
    return F.when(ok, wide)


def parse_flag(c: Column) -> Column:
    """``True``/``False`` in any case; null otherwise."""
    return F.when(F.lower(strip(c)) == "true", True).when(F.lower(strip(c)) == "false", False)


def render_flag(c: Column) -> Column:
    return F.initcap(c.cast("string"))


def _accents() -> dict[str, str]:
    """Letters of the Latin blocks that decompose to one letter and marks, by rule, with that letter."""
    out = {}
    for k in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        plain = "".join(x for x in unicodedata.normalize("NFKD", chr(k)) if not unicodedata.combining(x))
        if len(plain) == 1 and plain != chr(k):
            out[chr(k)] = plain
    return out


def without_accents(c: Column) -> Column:
    """Latin letters without their marks, composed or combining."""
    known = _accents()
    return F.translate(F.regexp_replace(c, r"\p{Mn}", ""), "".join(known), "".join(known.values()))


def clean_name(c: Column) -> Column:
    """A name without accents and with single spaces; empty where it holds a digit, comma or period."""
    name = without_accents(F.regexp_replace(strip(c), r"\s+", " "))
    return F.when(name.rlike(r"[\p{Nd},.]"), "").otherwise(name)


def tokens(c: Column) -> Column:
    """Words between white space, none empty."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), r"\s+"), lambda x: x != "")


def human_bytes(c: Column, units: tuple[str, ...] = ("KB", "MB", "GB", "TB")) -> Column:
    """Bytes in steps of 1024 with one decimal, halves to even; the last unit takes all that is larger."""

    def shown(k):
        return F.concat(F.format_string("%.1f", F.bround(c / float(1024**k), 1)), F.lit(f" {units[k - 1]}"))

    out = shown(len(units))
    for k in range(len(units) - 1, 0, -1):
        out = F.when(c < 1024 ** (k + 1), shown(k)).otherwise(out)
    return F.when(c < 1024, F.concat(c.cast("long").cast("string"), F.lit(" B"))).otherwise(out)


def edit_distance(a: Column, b: Column) -> Column:
    """Levenshtein distance over code points."""
    return F.levenshtein(a, b)


def token_distance(a: Column, b: Column) -> Column:
    """Levenshtein distance of two arrays of words: each distinct word of both becomes one code point."""
    known = F.array_distinct(F.concat(a, b))

    def coded(words: Column) -> Column:
        place = F.transform(words, lambda w: F.array_position(known, w))
        points = F.transform(place, lambda k: F.lpad(F.hex(F.when(k < 0xD800, k).otherwise(k + 0x800)), 8, "0"))
        return F.decode(F.unhex(F.array_join(points, "")), "UTF-32")

    return F.levenshtein(coded(a), coded(b))
