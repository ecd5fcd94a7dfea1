"""Path and id string functions (X1-X10) as built-in Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's behaviour.
KINDERGARTEN_PREFIXES = ("đông_", "thành_", "tú_", "tuyến_")
KINDERGARTEN = "kindergarten"
PRIMARY_SCHOOL = "primaryschool"
AGE_CLASS_ROOT = "audio_MDD/"
ID_PREFIX_LEN = 14
UNFLATTEN_TAIL_LEN = 17


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def basename(col: Column | str) -> Column:
    """Text after the last '/' (whole string when there is none)."""
    return F.substring_index(_c(col), "/", -1)


def stem(col: Column | str) -> Column:
    """Basename minus its last extension, like Python's os.path.splitext:
    the extension starts at the last dot, unless only dots precede it."""
    return F.regexp_replace(basename(col), r"^(\.*[^.].*)\.[^.]*\z", "$1")


def swap_extension(col: Column | str, old: str = ".wav", new: str = "") -> Column:
    """Literal replace of every occurrence of ``old``."""
    return F.replace(_c(col), F.lit(old), F.lit(new))


def compose_path(prefix: Column | str, name: Column | str, ext: str = "") -> Column:
    """Prefix + name (+ extension)."""
    p = F.lit(prefix) if isinstance(prefix, str) else prefix
    return F.concat(p, _c(name), F.lit(ext))


def strip_prefix(col: Column | str, prefix: str) -> Column:
    """Drop the first len(prefix) characters; the prefix itself is not checked."""
    return F.substring(_c(col), len(prefix) + 1, 1 << 30)


def split_once(col: Column | str) -> tuple[Column, Column]:
    """Split at the first '/' into (set, file_name); no '/' -> file_name null."""
    parts = F.split(_c(col), "/", 2)
    return F.get(parts, 0), F.get(parts, 1)


def id_prefix(col: Column | str, n: int = ID_PREFIX_LEN) -> Column:
    """First n characters (shorter ids kept whole)."""
    return F.left(_c(col), F.lit(n))


def unflatten(col: Column | str, n: int = UNFLATTEN_TAIL_LEN) -> Column:
    """Last n characters with every '_' turned back into '/'."""
    return F.translate(F.right(_c(col), F.lit(n)), "_", "/")


def flatten(col: Column | str) -> Column:
    """Every '/' becomes '_'."""
    return F.translate(_c(col), "/", "_")


def age_class(col: Column | str) -> tuple[Column, Column]:
    """(class, current path) from the id's prefix.

    Ids starting with one of the kindergarten prefixes live one folder deeper:
    their first '_' becomes '/'. Exact code points, no Unicode normalization.
    """
    c = _c(col)
    is_kg = None
    for p in KINDERGARTEN_PREFIXES:
        t = F.startswith(c, F.lit(p))
        is_kg = t if is_kg is None else (is_kg | t)
    cls = F.when(is_kg, F.lit(KINDERGARTEN)).otherwise(F.lit(PRIMARY_SCHOOL))
    rel = F.when(is_kg, F.regexp_replace(c, "^([^_]*)_", "$1/")).otherwise(c)
    path = F.concat(F.lit(AGE_CLASS_ROOT), cls, F.lit("/"), rel, F.lit(".wav"))
    return cls, path
