"""Tokenisers as Column expressions; nothing here leaves the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

# The characters Python's str.split() and str.strip() treat as whitespace.
SPACE = (
    r"[\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
BLANKS = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                           0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))  # the same characters
# Token patterns.
WORD_OR_SYMBOL = r"([\p{L}\p{N}\p{M}]+|[^\p{Z}\p{C}])"
WORD_SYMBOL_OR_GAP = r"([\p{L}\p{N}\p{M}]+|[^\p{Z}\p{C}]|[\p{Z}\p{C}]+)"
ALNUM_RUNS = r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"
CAMEL_BOUNDARY = r"(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])"


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row.

    A column used inside a higher-order function's lambda is otherwise
    computed again for every element.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words(text: Column) -> Column:
    """Whitespace tokens, empty ones left out."""
    return F.array_remove(F.split(F.translate(text, BLANKS, " " * len(BLANKS)), " "), "")


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def collapse_space(text: Column) -> Column:
    return F.array_join(words(text), " ")


def lines(text: Column) -> Column:
    return F.split(text, "\n")


def snake_parts(token: Column) -> Column:
    return F.split(token, "_")


def camel_parts(token: Column) -> Column:
    return F.array_remove(F.split(token, CAMEL_BOUNDARY), "")


def code_parts(text: Column, camel: bool = True, snake: bool = True) -> Column:
    """Whitespace tokens cut at underscores and at case changes."""
    if not (camel or snake):
        raise ValueError("turn on camel or snake splitting")
    if not camel:
        return F.flatten(F.transform(words(text), snake_parts))
    # case changes lie inside words and no part is empty, so the whole text is cut at once
    cut = F.regexp_replace(text, CAMEL_BOUNDARY, " ")
    return words(F.translate(cut, "_", " ") if snake else cut)


def words_and_symbols(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD_OR_SYMBOL), 1)


def words_with_gaps(text: Column) -> Column:
    """Words and symbols, each with the white space after it; joined and stripped they give the text back."""
    return F.regexp_extract_all(text, F.lit(WORD_OR_SYMBOL + r"[\p{Z}\p{C}]*"), 0)


def untokenised(cells: Column) -> Column:
    """The original text of cells of ``words_with_gaps``, without outer white space."""
    return F.regexp_replace(F.array_join(cells, ""), r"[\p{Z}\p{C}]+\z", "")


def alnum_runs(text: Column) -> Column:
    """Runs of letters/digits and of anything else; lone spaces kept only at the ends."""
    return bind(
        F.regexp_extract_all(text, F.lit(ALNUM_RUNS), 1),
        lambda runs: F.filter(runs, lambda t, i: (t != " ") | (i == 0) | (i == F.size(runs) - 1)),
    )


def ngrams(tokens: Column, n: int, uncased: bool = False,
           skip: Callable[[Column], Column] | None = None, as_strings: bool = True) -> Column:
    """All n-grams of length 1..n, by start position then length.

    ``skip`` gets the n-gram as an array column and returns a boolean column.
    """
    if uncased:
        tokens = F.transform(tokens, F.lower)

    def build(t: Column) -> Column:
        size = F.size(t)
        grams = F.flatten(
            F.transform(
                _positions(size),
                lambda s: F.transform(
                    F.sequence(F.lit(1), F.least(F.lit(n), size - s + 1)),
                    lambda k: F.slice(t, s, k),
                ),
            )
        )
        if skip is not None:
            grams = F.filter(grams, lambda g: ~skip(g))
        return F.transform(grams, lambda g: F.array_join(g, " ")) if as_strings else grams

    return bind(tokens, build)


def _positions(count: Column) -> Column:
    """1..count, empty when count is below one."""
    return F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))


def ngrams_of(tokens: Column, n: int) -> Column:
    """N-grams of exactly length n, joined by a space."""
    return bind(
        tokens,
        lambda t: F.transform(_positions(F.size(t) - n + 1), lambda s: F.array_join(F.slice(t, s, n), " ")),
    )


class TokenizerRegistry:
    """Language name -> Column expression; new languages plug in by name."""

    def __init__(self, default: Callable[[Column], Column] = words):
        self._default = default
        self._by_language: dict[str, Callable[[Column], Column]] = {}

    def register(self, language: str, tokenizer: Callable[[Column], Column]) -> "TokenizerRegistry":
        self._by_language[language] = tokenizer
        return self

    def tokenize(self, language: Column, text: Column) -> Column:
        chain = None
        for name, tokenizer in self._by_language.items():
            branch = tokenizer(text)
            chain = F.when(language == name, branch) if chain is None else chain.when(language == name, branch)
        fallback = self._default(text)
        return fallback if chain is None else chain.otherwise(fallback)
