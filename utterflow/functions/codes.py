"""Decode the 5-character class code of a corpus record.

The code sits after one leading character: positions 1..5 (0-based) carry
topic, gender, dialect, emotion and age. Unknown characters decode to null; a
null code gives five nulls; a code shorter than 6 characters gives nulls for
the missing positions (the reference raises there).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's lookup tables.
TOPIC = {
    "0": "news",
    "1": "movies, drama (dialogue)",
    "2": "stories, audio book",
    "3": "cultural issue",
    "4": "tourism, exploring",
    "5": "living viewpoints, living expats",
    "6": "sports",
    "7": "security related",
    "8": "traffic",
    "9": "healthcare",
}
GENDER = {"M": "male", "F": "female"}
DIALECT = {
    "0": "northern dialect",
    "1": "central dialect",
    "2": "highland central dialect",
    "3": "southern dialect",
    "4": "minority ethnic group dialect",
}
EMOTION = {
    "N": "neutral",
    "J": "joyful",
    "A": "angry",
    "S": "sad",
    "T": "tired",
    "D": "disgust",
    "F": "fear",
    "H": "happy",
}
AGE = {
    "C": "children",
    "Y": "young",
    "M": "middle age",
    "O": "old",
    "S": "very old",
}

FIELDS = (("topic", TOPIC), ("gender", GENDER), ("dialect", DIALECT),
          ("emotion", EMOTION), ("age", AGE))


def _map_literal(d: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def decode_class(col: Column | str) -> list[Column]:
    """Five aliased columns: topic, gender, dialect, emotion, age."""
    c = F.col(col) if isinstance(col, str) else col
    out = []
    for i, (name, table) in enumerate(FIELDS, start=2):
        ch = F.substring(c, i, 1)
        out.append(F.try_element_at(_map_literal(table), ch).alias(name))
    return out
