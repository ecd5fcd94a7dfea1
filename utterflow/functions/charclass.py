"""Regex character classes built from Python's Unicode tables.

Java's ``\\s``/``\\p{P}`` and RE2's differ from Python's ``str.isspace`` and
``unicodedata.category(c)[0] == 'P'`` (see SURVEY §4.3). The reference's
normalizer is Python, so both classes are derived here from Python's tables and
spelled as explicit code-point ranges that Java (Spark) and RE2 (DuckDB) read
the same way.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache


def _ranges(codepoints: list[int]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for cp in codepoints:
        if out and cp == out[-1][1] + 1:
            out[-1] = (out[-1][0], cp)
        else:
            out.append((cp, cp))
    return out


def _klass(codepoints: list[int]) -> str:
    parts = []
    for lo, hi in _ranges(codepoints):
        parts.append(f"\\x{{{lo:x}}}" if lo == hi else f"\\x{{{lo:x}}}-\\x{{{hi:x}}}")
    return "[" + "".join(parts) + "]"


@lru_cache(maxsize=None)
def whitespace_class() -> str:
    """Everything ``str.isspace`` / Python ``re`` ``\\s`` accepts (29 code points)."""
    return _klass([c for c in range(sys.maxunicode + 1) if chr(c).isspace()])


@lru_cache(maxsize=None)
def whitespace_chars() -> str:
    """The same 29 code points as a literal string (for set-based trimming)."""
    return "".join(chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace())


def _quick(first: list[int], rest: str, last: int) -> str:
    """A Java class of the code points ``first`` below 256, which it keeps in a table, and of the class ``rest`` among
    those from 256 to ``last``: other characters are told by one look and one comparison, not by every range."""
    return "[" + "".join(f"\\x{{{c:x}}}" for c in first) + f"[\\x{{100}}-\\x{{{last:x}}}&&{rest}]]"


@lru_cache(maxsize=None)
def jvm_whitespace_class() -> str:
    """``whitespace_class`` in the order in which Java's regex is quickest; not for RE2."""
    spaces = [ord(c) for c in whitespace_chars()]
    return _quick([c for c in spaces if c < 256], _klass([c for c in spaces if c >= 256]), spaces[-1])


@lru_cache(maxsize=None)
def punctuation_class() -> str:
    """Every code point of Unicode general category P* (as Python sees it)."""
    return _klass([c for c in range(sys.maxunicode + 1)
                   if unicodedata.category(chr(c)).startswith("P")])


_JVM_PUNCT_CACHE: dict[str, str] = {}


def jvm_punctuation_class(spark) -> str:
    """Java-regex class equal to Python's category-P set, but fast.

    An explicit list of ~330 ranges makes Java's regex test every range for
    every character (30x slower than the table-driven ``\\p{P}``). So the
    class is ``\\p{P}`` plus/minus the code points on which the JVM's Unicode
    tables and Python's disagree. The JVM side is asked once per session with
    one ``replaceAll`` over a string of all code points.
    """
    try:
        key = spark.sparkContext.applicationId
        jvm = spark.sparkContext._jvm
    except Exception:             # no driver JVM handle (e.g. Spark Connect): exact but slower class
        return punctuation_class()
    if key in _JVM_PUNCT_CACHE:
        return _JVM_PUNCT_CACHE[key]
    every = "".join(chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF)
    pattern = jvm.java.util.regex.Pattern.compile("[^\\p{P}]")
    java_p = {ord(ch) for ch in pattern.matcher(every).replaceAll("")}
    py_p = {c for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c)).startswith("P")}
    extra = sorted(py_p - java_p)
    excess = sorted(java_p - py_p)
    inner = "\\p{P}" + (_klass(extra)[1:-1] if extra else "")
    klass = f"[{inner}&&[^{_klass(excess)[1:-1]}]]" if excess else f"[{inner}]"
    klass = _quick(sorted(c for c in py_p if c < 256), klass, sys.maxunicode)
    _JVM_PUNCT_CACHE[key] = klass
    return klass
