"""String cleaning and splitting rules as Column expressions."""

from __future__ import annotations

import string

from pyspark.sql import Column, functions as F

from .tokens import SPACE, bind, collapse_space, lines, strip

# Fixed values -------------------------------------------------------------
DASHES_AND_QUOTES = "[‘…—−–]"
TYPOGRAPHIC_MARKS = "[?，`“”’™•°]"
LIST_MARKS = "[,:;]"
PADDED_OPERATORS = r"([\+\-\*/=(){}%^&\.])"
TRAILING_DOTS = r"\.+$"
CONTROL_SPACE = r"[\t\r\n\x{0B}\f]"
BRACKETS = r"[\(\[\]\)]"
CODE_OPERATORS = r"""[\(\[\+\-\*/,:;=(){}%^&\]\)'"]"""
PUNCTUATION = string.punctuation
PYTHON_CHAR_TO_TOKEN = {"#": " STOKEN0 ", "\\n": " STOKEN1 ", '"""': " STOKEN2 ", "'''": " STOKEN3 "}
PYTHON_TOKEN_TO_CHAR = {"STOKEN0": "#", "STOKEN1": "\\n", "STOKEN2": '"""', "STOKEN3": "'''"}
JAVA_CHAR_TO_TOKEN = {
    "//": " STOKEN0 ", "/*": " STOKEN1 ", "*/": " STOKEN2 ", "/**": " STOKEN3 ",
    "**/": " STOKEN4 ", '"""': " STOKEN5 ", "\\n": " STOKEN6 ",
}
JAVA_TOKEN_TO_CHAR = {
    "STOKEN0": "//", "STOKEN1": "/*", "STOKEN2": "*/", "STOKEN3": "/**",
    "STOKEN4": "**/", "STOKEN5": '"""', "STOKEN6": "\\n",
}
PYTHON2_PATTERNS = [r"print [^(]", r"raise \w+ ,", r"except \w+ ,", r"[^ ]+ = \d+ L"]
PYTHON2_PHRASES = [". iterkeys ( )", ". itervalues ( )", ". iteritems ( )", "xrange (", "imap ("]
CPP_DIRECTIVES = [
    '# include ".*?"',
    "# include <.*?>",
    "# ifndef [^ ]*",
    "# ifdef [^ ]*",
    r"# define [^ ]* [(] .*? [)] [(] .* [)]",
    r"# define [^ ]* [(] .*? [)] [{] .* [}]",
    r'# define [^ ]* ([(] )?["].*?["]( [)])?',
    r"# define [^ ]* ([(] )?\d*\.?\d*( [+-/*] ?\d*\.?\d*)?( [)])?",
    "# define [^ ]",
    r"# if defined [(] .*? [)]",
    "# if [^ ]*",
]
CPP_PHRASES = ["# else", "# endif"]
JAVA_ANNOTATIONS = r"^(@ (Override|Deprecated|SuppressWarnings) (\( .* \) )?)*"
TREE_SPECIALS = {
    "&apos;": "'", "&apos;s": "'s", "&quot;": '"', "&#91;": "[", "&#93;": "]",
    "&apos;@@": "'@@", "&apos;t": "'t", "&amp;": "&", "&apos;ll": "'ll", "&apos;ve": "'ve",
    "&apos;m": "'m", "&apos;re": "'re", "&apos;d": "'d", "&#124;": "|", "&gt;": ">", "&lt;": "<",
}
TREE_BRACKET_FIXES = [
    ("-LRB- (", "-LRB- -LRB-"), ("-RRB- )", "-RRB- -RRB-"),
    ("TRUNC (", "TRUNC -LRB-"), ("TRUNC )", "TRUNC -RRB-"),
]
# --------------------------------------------------------------------------


def replace_all(text: Column, pairs) -> Column:
    """Plain (non-regex) replacements, in order."""
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def quotes_balanced(text: Column) -> Column:
    double = F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))
    single = F.length(text) - F.length(F.replace(text, F.lit("'"), F.lit("")))
    return (double % 2 == 0) & (single % 2 == 0)


def line_comments(text: Column, marker: str = "#") -> Column:
    """Text after the first marker of each line, where quotes before it are balanced."""

    def comment(line: Column) -> Column:
        at = F.instr(line, marker)
        before = F.when(at > 1, F.substr(line, F.lit(1), at - 1)).otherwise("")
        after = F.when(at > 0, F.substr(line, at + len(marker))).otherwise("")
        return F.when((after != "") & quotes_balanced(before), after).otherwise("")

    return F.array_remove(F.transform(lines(text), comment), "")


def without_line_comments(text: Column, marker: str = "#", drop_char_before: bool = True) -> Column:
    """Lines up to the marker, blank ones dropped, each ended by a newline.

    The character right before the marker goes too unless ``drop_char_before``
    is off; that is what the known results contain.
    """
    cut = 2 if drop_char_before else 1

    def code(line: Column) -> Column:
        at = F.instr(line, marker)
        head = F.when(at > cut, F.substr(line, F.lit(1), at - cut)).otherwise("")
        return F.when(at > 0, head).otherwise(line)

    kept = F.array_remove(F.transform(lines(text), code), "")
    return F.when(F.size(kept) > 0, F.concat(F.array_join(kept, "\n"), F.lit("\n"))).otherwise("")


def _first_block(text: Column, opening: str, closing: str) -> tuple[Column, Column]:
    begin = F.locate(opening, text)
    end = F.when(begin > 0, F.call_function("locate", F.lit(closing), text, begin + len(opening))).otherwise(0)
    return begin, end


def quoted_block(text: Column, markers) -> tuple[Column, Column]:
    """(block, text without it); the first marker pair that opens in the text is the one used.

    The block is null, and the text whole, when the chosen pair never closes.
    """
    block, rest = None, None
    for opening, closing in markers:
        begin, end = _first_block(text, opening, closing)
        found = end > 0
        inner = F.when(found, strip(F.substr(text, begin + len(opening), end - begin - len(opening))))
        cut = F.when(
            found, F.concat(F.substr(text, F.lit(1), begin - 1), F.substr(text, end + len(closing)))
        ).otherwise(text)
        if block is None:
            block, rest = F.when(begin > 0, inner), F.when(begin > 0, cut)
        else:
            block, rest = block.when(begin > 0, inner), rest.when(begin > 0, cut)
    return block, rest.otherwise(text)


def _plain_marks(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, DASHES_AND_QUOTES, " "), TYPOGRAPHIC_MARKS, "")


def _pad_operators(text: Column) -> Column:
    text = F.regexp_replace(_plain_marks(text), LIST_MARKS, "")
    return F.regexp_replace(F.regexp_replace(text, PADDED_OPERATORS, " $1 "), TRAILING_DOTS, "")


def clean_comment(text: Column) -> Column:
    return strip(F.regexp_replace(_pad_operators(text), " +", " "))


def clean_docstring(text: Column) -> Column:
    text = F.regexp_replace(_pad_operators(text), CONTROL_SPACE, "")
    return strip(F.regexp_replace(F.regexp_replace(text, BRACKETS, ""), " +", " "))


def clean_code(text: Column) -> Column:
    return collapse_space(F.regexp_replace(_plain_marks(text), CODE_OPERATORS, ""))


def drop_punctuation(text: Column) -> Column:
    return F.translate(text, PUNCTUATION, "")


def first_sentence(text: Column, exact: bool = True) -> Column:
    """Text before the first dot, punctuation out, ending in ' .'.

    ``exact`` keeps the known result for a text without a dot: its last
    character is lost.
    """
    text = F.translate(text, "'\"", "  ")
    dot = F.instr(text, ".")
    whole = F.substr(text, F.lit(1), F.greatest(F.length(text) - 1, F.lit(0))) if exact else text
    head = F.when(dot > 0, F.substr(text, F.lit(1), dot - 1)).otherwise(whole)
    return F.concat(collapse_space(drop_punctuation(head)), F.lit(" ."))


def tabs_to_spaces(text: Column) -> Column:
    return F.replace(text, F.lit("\t"), F.lit("    "))


def normalize_answer(text: Column) -> Column:
    return collapse_space(F.lower(text))


def normalize_string(text: Column) -> Column:
    return collapse_space(drop_punctuation(F.lower(text)))


def has_text(text: Column) -> Column:
    return F.length(strip(drop_punctuation(text))) > 0


def word_chars(text: Column) -> Column:
    """Number of word characters (letters, digits, underscore, any script)."""
    return F.length(F.regexp_replace(text, r"[^\p{L}\p{N}_]", ""))


def split_punctuation(text: Column) -> Column:
    """International punctuation split: marks away from digits, symbols always."""
    text = F.regexp_replace(text, r"(\P{N})(\p{P})", "$1 $2 ")
    text = F.regexp_replace(text, r"(\p{P})(\P{N})", " $1 $2")
    return collapse_space(F.regexp_replace(text, r"(\p{S})", " $1 "))


def normalize_literal(text: Column, is_comment: bool, char_to_token=PYTHON_CHAR_TO_TOKEN,
                      token_to_char=PYTHON_TOKEN_TO_CHAR) -> Column:
    """String or comment literal made into space-separated tokens."""
    out = text
    if is_comment:
        out = F.regexp_replace(out, " +", " ")
        out = F.regexp_replace(out, r"(?d)(.)\1{4,}", "$1$1$1$1$1")
    enough = word_chars(out) >= 2
    out = F.replace(out, F.lit(" "), F.lit(" ▁ "))
    out = replace_all(out, char_to_token.items())
    marked = F.concat(F.regexp_replace(out, r"\n\z", ""), F.lit(" ENDCOM"))
    out = F.when(out.startswith(" STOKEN0"), marked).otherwise(out)
    out = replace_all(out, [("\n", " STRNEWLINE "), ("\t", " TABSYMBOL ")])
    out = split_punctuation(F.regexp_replace(out, " +", " "))
    out = replace_all(out, token_to_char.items())
    out = F.replace(out, F.lit("\r"), F.lit(""))
    return F.when(enough, out).otherwise("") if is_comment else out


def restore_subwords(text: Column) -> Column:
    return F.regexp_replace(text, "(?md)(@@ )|(@@ ?$)", "")


def guard_unknown(text: Column) -> Column:
    return F.replace(text, F.lit("<unk>"), F.lit("<<unk>>"))


def split_repo_path(path: Column) -> tuple[Column, Column]:
    """(repository = up to the second slash, path inside it)."""
    repo = F.substring_index(path, "/", 2)
    return repo, F.substr(path, F.length(repo) + 2)


def token_before(tokens: Column, pivot: str) -> Column:
    """Token before the first pivot; the last token when the pivot comes first."""
    return bind(tokens, lambda t: bind(
        F.array_position(t, pivot).cast("int"),
        lambda at: F.when(at > 1, F.get(t, at - 2)).when(at == 1, F.element_at(t, -1))))


def token_after(tokens: Column, pivot: str) -> Column:
    return bind(tokens, lambda t: bind(
        F.array_position(t, pivot).cast("int"), lambda at: F.when(at > 0, F.get(t, at))))


def first_parenthesised(tokens: Column) -> Column:
    """Tokens inside the first balanced pair of parentheses; null when there is none."""

    def inside(tail: Column) -> Column:
        state = F.aggregate(
            tail,
            F.struct(F.lit(0).alias("depth"), F.lit(0).alias("seen"), F.lit(0).alias("end")),
            lambda s, t: F.struct(
                (s["depth"] + F.when(t == "(", 1).when(t == ")", -1).otherwise(0)).alias("depth"),
                (s["seen"] + 1).alias("seen"),
                F.when((s["end"] == 0) & (t == ")") & (s["depth"] == 1), s["seen"] + 1)
                .otherwise(s["end"]).alias("end"),
            ),
            lambda s: s["end"],
        )
        return bind(
            F.when(state > 0, state).otherwise(F.size(tail)),
            lambda end: F.slice(tail, 2, F.greatest(end - 2, F.lit(0))),
        )

    def tail_of(t: Column) -> Column:
        start = F.array_position(t, "(").cast("int")
        return F.when(start > 0, F.slice(t, F.greatest(start, F.lit(1)), F.size(t)))

    return bind(bind(tokens, tail_of), inside)


def argument_types_and_names(signature: Column) -> Column:
    """Array of struct(type, name) of the arguments of a tokenised signature."""
    inner = F.array_join(first_parenthesised(F.split(signature, " ")), " ")

    def argument(arg: Column) -> Column:
        marks = F.array_join(F.regexp_extract_all(arg, F.lit(r"(\[ \])"), 1), " ")
        plain = F.when(marks == "", arg).otherwise(F.replace(arg, marks, F.lit("")))
        return bind(
            F.split(F.regexp_replace(strip(plain), " +", " "), " "),
            lambda parts: F.struct(
                F.concat_ws(" ", F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))),
                            F.array(marks)).alias("type"),
                F.element_at(parts, -1).alias("name"),
            ),
        )

    none = F.array(F.struct(F.lit("None").alias("type"), F.lit("None").alias("name")))
    return F.when(inner == "", none).otherwise(F.transform(F.split(inner, ","), argument))


def strip_annotations(text: Column) -> Column:
    return F.regexp_replace(text, JAVA_ANNOTATIONS.replace("^(", "^(?d)(", 1), "")


def strip_directives(text: Column) -> Column:
    for pattern in CPP_DIRECTIVES:
        text = F.regexp_replace(text, "(?d)" + pattern, "")
    return strip(replace_all(text, [(p, "") for p in CPP_PHRASES]))


def split_doc_and_code(text: Column, block: str, inline: str, block_trim: int = 0,
                       min_word_chars: int = 5) -> tuple[Column, Column]:
    """(code without comments, comments); both empty when there is too little comment text.

    ``block`` and ``inline`` are regular expressions; ``block_trim`` characters
    at the end of each block belong to the match but not to the comment.
    """
    blocks = F.regexp_extract_all(text, F.lit(f"(?s)({block})"), 1)
    code = F.regexp_replace(text, f"(?s){block}", "")
    inlines = F.regexp_extract_all(code, F.lit(f"(?d)({inline})"), 1)
    code = F.regexp_replace(code, f"(?d){inline}", "")
    if block_trim:
        blocks = F.transform(blocks, lambda b: F.substr(b, F.lit(1), F.length(b) - block_trim))
    comments = F.concat(
        F.array_join(blocks, " "),
        F.array_join(F.transform(inlines, lambda c: F.concat(F.lit(" <INLINE> "), c)), ""),
    )
    bare = replace_all(comments, [("<INLINE>", ""), ("ENDCOM", "")])
    keep = (F.size(blocks) > 0) & (word_chars(bare) >= min_word_chars)
    return (
        F.when(keep, F.regexp_replace(code, SPACE + "+", " ")).otherwise(""),
        F.when(keep, comments).otherwise(""),
    )


def split_hyphens(text: Column) -> Column:
    return F.regexp_replace(text, r"(\S)-(\S)", "$1 ##AT##-##AT## $2")


def escape_tree_text(text: Column) -> Column:
    """Round brackets widened; per token the last matching entity is replaced."""
    wide = F.translate(text, "()", "（）")

    def token(t: Column) -> Column:
        chain = None
        for old, new in reversed(TREE_SPECIALS.items()):
            hit, value = F.contains(t, F.lit(old)), F.replace(t, F.lit(old), F.lit(new))
            chain = F.when(hit, value) if chain is None else chain.when(hit, value)
        return chain.otherwise(t)

    return F.array_join(F.transform(F.split(wide, " "), token), " ")


def fix_tree_brackets(text: Column) -> Column:
    return replace_all(text, TREE_BRACKET_FIXES)


def split_id(text: Column, separator: str = " | ") -> tuple[Column, Column]:
    """(id, rest) at the first separator; a text without one has an empty rest."""
    key = F.substring_index(text, separator, 1)
    return key, F.substr(text, F.length(key) + len(separator) + 1)


def human_number(number: Column) -> Column:
    """Three significant digits with a K/M/B/T suffix."""
    x = number.cast("double")
    digits = F.when(x == 0, 0).otherwise(F.floor(F.log10(F.abs(x)))).cast("int")
    scale = F.pow(F.lit(10.0), (digits - 2).cast("double"))
    rounded = F.when(x == 0, F.lit(0.0)).otherwise(F.bround(x / scale, 0) * scale)
    group = F.when(F.abs(rounded) < 1000, 0).otherwise(F.floor((F.log10(F.abs(rounded)) + 1e-12) / 3)).cast("int")
    value = rounded / F.pow(F.lit(1000.0), group.cast("double"))
    suffix = F.get(F.array(*[F.lit(s) for s in ("", "K", "M", "B", "T")]), group)
    shown = F.regexp_replace(F.format_string("%.6f", value), r"\.?0+$", "")
    return F.concat(shown, suffix)


def label_of_path(path: Column) -> Column:
    """Name of the folder that holds a file."""
    return F.regexp_extract(path, r"([^/]+)/[^/]*$", 1)


def language_of_name(name: Column) -> Column:
    """Second dot-separated part of names with at least three parts."""
    parts = F.split(name, r"\.")
    return F.when(F.size(parts) >= 3, F.get(parts, F.lit(1)))


def byte_ids(word: Column, width: int) -> Column:
    """UTF-8 byte ids between begin (256) and end (257) marks, padded (258) to ``width``."""
    count = F.least(F.octet_length(word), F.lit(width - 2))
    ids = F.when(
        count > 0,
        bind(
            F.hex(F.encode(word, "UTF-8")),
            lambda hexed: F.transform(
                F.sequence(F.lit(1), count),
                lambda i: F.conv(F.substr(hexed, 2 * i - 1, F.lit(2)), 16, 10).cast("int"),
            ),
        ),
    ).otherwise(F.array().cast("array<int>"))
    return F.concat(F.array(F.lit(256)), ids, F.array(F.lit(257)), F.array_repeat(F.lit(258), width - 2 - count))


def comments_above(text: Column, opener: str, marker: str) -> Column:
    """Comment lines directly above an opener line with a blank line (or nothing) before them."""

    def pick(rows: Column) -> Column:
        def above(i: Column) -> Column:
            comment = F.get(rows, i - 1)
            before = F.when(i >= 2, F.get(rows, i - 2)).otherwise("")
            fits = F.get(rows, i).startswith(opener) & comment.startswith(marker) & (before == "")
            return F.when(F.coalesce(fits, F.lit(False)), comment).otherwise("")

        positions = F.sequence(F.lit(1), F.greatest(F.size(rows) - 1, F.lit(1)))
        return F.array_remove(F.transform(positions, above), "")

    return bind(F.transform(lines(text), strip), pick)
