"""Classes of code points, looked up for a whole text at once."""

from __future__ import annotations

import unicodedata

import numpy as np

CLASSES = ("lower", "upper", "letter", "digit", "space", "line", "stop", "mark", "symbol", "other")
# Characters that end or part clauses, and those seen in markup and noise.
STOPS = ".,!?;:"
SYMBOLS = "#*$%&|<>"
LAST = 0xFFFF  # later code points share the class of this one


def class_table() -> np.ndarray:
    """Class number of every code point up to ``LAST``."""
    named = {"Ll": 0, "Lu": 1, "Nd": 3, "Zs": 4}
    table = np.full(LAST + 1, CLASSES.index("other"), np.uint8)
    for code in range(LAST):
        kind = unicodedata.category(chr(code))
        table[code] = named.get(kind, 2 if kind[0] == "L" else 7 if kind[0] == "P" else 9)
    for chars, name in (("\t\x0b\x0c\r ", "space"), ("\n", "line"), (STOPS, "stop"), (SYMBOLS, "symbol")):
        table[[ord(c) for c in chars]] = CLASSES.index(name)
    return table


def class_counts(text: str, table: np.ndarray) -> np.ndarray:
    """How many code points of each class a text has."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.bincount(table[np.minimum(codes, LAST)], minlength=len(CLASSES))
