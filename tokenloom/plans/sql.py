"""Building blocks of the check SQL."""

from __future__ import annotations

from ..functions.tokens import SPACE
from ..functions.text import PUNCTUATION


def q(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


def words(col: str) -> str:
    return f"list_filter(string_split_regex({col}, '{SPACE}+'), lambda w: w <> '')"


def strip(col: str) -> str:
    return f"regexp_replace({col}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def collapse(col: str) -> str:
    return f"array_to_string({words(col)}, ' ')"


def sub(col: str, pattern: str, new: str) -> str:
    return f"regexp_replace({col}, {q(pattern)}, {q(new)}, 'g')"


def no_punct(col: str) -> str:
    return f"translate({col}, {q(PUNCTUATION)}, '')"


def uniform(seed: str, *keys: str) -> str:
    joined = " || '|' || ".join([q(seed), *[f"({k})::VARCHAR" for k in keys]])
    return f"(('0x' || substr(md5({joined}), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"


def replaces(col: str, pairs) -> str:
    for old, new in pairs:
        col = f"replace({col}, {q(old)}, {q(new)})"
    return col
