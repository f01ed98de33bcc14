"""Registered queries: cleaning, splitting and tokenising of texts (X)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import text as T, tokens as K
from ..operators import tokentables
from ..session import table
from . import sql as S
from .registry import query

C = F.col
DOC = "SELECT doc_id, {} FROM documents"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


_SQL_LINES = "string_split(text, chr(10))"
_PARITY = ("(length({0}) - length(replace({0}, '\"', ''))) % 2 = 0 AND "
           "(length({0}) - length(replace({0}, '''', ''))) % 2 = 0")


@query("x01_line_comments", f"""
SELECT doc_id,
  array_to_string(list_filter(list_transform({_SQL_LINES}, lambda l:
      CASE WHEN instr(l, '.') > 0 AND {_PARITY.format("left(l, instr(l, '.') - 1)")}
           THEN substr(l, instr(l, '.') + 1) ELSE '' END), lambda c: c <> ''), '¶') AS comments,
  array_to_string(list_transform(list_filter(list_transform({_SQL_LINES}, lambda l:
      CASE WHEN instr(l, '.') > 0 THEN left(l, greatest(instr(l, '.') - 2, 0)) ELSE l END),
      lambda c: c <> ''), lambda c: c || chr(10)), '') AS code
FROM documents""")
def line_comments(spark, folder):
    d = documents(spark, folder)
    return d.select("doc_id", F.array_join(T.line_comments(C("text"), "."), "¶").alias("comments"),
                    T.without_line_comments(C("text"), ".").alias("code"))


_OPEN1 = "instr(html, '<style>')"
_REST1 = f"substr(html, {_OPEN1} + 7)"
_END1 = f"instr({_REST1}, '</style>')"


@query("x02_quoted_block", f"""
SELECT page_id,
  CASE WHEN {_OPEN1} > 0 AND {_END1} > 0 THEN {S.strip(f"left({_REST1}, {_END1} - 1)")} END AS block,
  CASE WHEN {_OPEN1} > 0 AND {_END1} > 0
       THEN left(html, {_OPEN1} - 1) || substr({_REST1}, {_END1} + 8) ELSE html END AS rest
FROM pages WHERE {_OPEN1} > 0
UNION ALL
SELECT page_id,
  CASE WHEN instr(html, '<h1>') > 0 AND instr(substr(html, instr(html, '<h1>') + 4), '</h1>') > 0
       THEN {S.strip("left(substr(html, instr(html, '<h1>') + 4), instr(substr(html, instr(html, '<h1>') + 4), '</h1>') - 1)")} END,
  CASE WHEN instr(html, '<h1>') > 0 AND instr(substr(html, instr(html, '<h1>') + 4), '</h1>') > 0
       THEN left(html, instr(html, '<h1>') - 1) || substr(substr(html, instr(html, '<h1>') + 4), instr(substr(html, instr(html, '<h1>') + 4), '</h1>') + 5)
       ELSE html END
FROM pages WHERE {_OPEN1} = 0""")
def quoted_block(spark, folder):
    block, rest = T.quoted_block(C("html"), [("<style>", "</style>"), ("<h1>", "</h1>")])
    return table(spark, folder, "pages").select("page_id", block.alias("block"), rest.alias("rest"))


def _sql_marks(col: str) -> str:
    return S.sub(S.sub(col, T.DASHES_AND_QUOTES, " "), T.TYPOGRAPHIC_MARKS, "")


def _sql_padded(col: str) -> str:
    col = S.sub(_sql_marks(col), T.LIST_MARKS, "")
    return S.sub(S.sub(col, T.PADDED_OPERATORS, r" \1 "), T.TRAILING_DOTS, "")


def sql_clean_comment(col: str) -> str:
    return S.strip(S.sub(_sql_padded(col), " +", " "))


@query("x03_clean_comment", DOC.format(f"{sql_clean_comment('text')} AS cleaned"))
def clean_comment(spark, folder):
    return documents(spark, folder).select("doc_id", T.clean_comment(C("text")).alias("cleaned"))


@query("x04_clean_docstring", DOC.format(
    S.strip(S.sub(S.sub(S.sub(_sql_padded("text"), T.CONTROL_SPACE, ""), T.BRACKETS, ""), " +", " ")) + " AS cleaned"))
def clean_docstring(spark, folder):
    return documents(spark, folder).select("doc_id", T.clean_docstring(C("text")).alias("cleaned"))


@query("x05_clean_code", DOC.format(S.collapse(S.sub(_sql_marks("text"), T.CODE_OPERATORS, "")) + " AS cleaned"))
def clean_code(spark, folder):
    return documents(spark, folder).select("doc_id", T.clean_code(C("text")).alias("cleaned"))


_UNQUOTED = "translate(text, '''\"', '  ')"


@query("x06_first_sentence", DOC.format(
    S.collapse(S.no_punct(f"CASE WHEN instr(text, '.') = 0 THEN left({_UNQUOTED}, length(text) - 1) "
                          f"ELSE left({_UNQUOTED}, instr(text, '.') - 1) END")) + " || ' .' AS sentence"))
def first_sentence(spark, folder):
    return documents(spark, folder).select("doc_id", T.first_sentence(C("text")).alias("sentence"))


@query("x07_drop_punctuation", DOC.format(S.no_punct("text") + " AS bare"))
def drop_punctuation(spark, folder):
    return documents(spark, folder).select("doc_id", T.drop_punctuation(C("text")).alias("bare"))


@query("x08_space_rules", DOC.format(
    "replace(replace(text, ' of ', chr(9)), chr(9), '    ') AS spaced, " + S.collapse("text") + " AS collapsed"))
def space_rules(spark, folder):
    tabbed = F.replace(C("text"), F.lit(" of "), F.lit("\t"))
    return documents(spark, folder).select("doc_id", T.tabs_to_spaces(tabbed).alias("spaced"),
                                           K.collapse_space(C("text")).alias("collapsed"))


@query("x09_space_tokenise", DOC.format(
    f"len({S.words('text')})::BIGINT AS n_tokens, array_to_string({S.words('text')}, '|') AS tokens"))
def space_tokenise(spark, folder):
    t = K.words(C("text"))
    return documents(spark, folder).select("doc_id", F.size(t).cast("long").alias("n_tokens"),
                                           F.array_join(t, "|").alias("tokens"))


@query("x10_snake_parts", """
SELECT p_partkey, array_to_string(string_split(replace(p_name, ' ', '_') || '_' || p_type, '_'), '|') AS parts
FROM part""")
def snake_parts(spark, folder):
    name = F.concat(F.replace(C("p_name"), F.lit(" "), F.lit("_")), F.lit("_"), C("p_type"))
    return table(spark, folder, "part").select("p_partkey", F.array_join(K.snake_parts(name), "|").alias("parts"))


CUT = "\ue001"  # a private-use mark for the SQL alone


def _sql_camel(token: str) -> str:
    """Cut marks put in twice: RE2 has no look-around and a match uses up its characters."""
    marked = token
    for _ in range(2):
        marked = S.sub(marked, "([a-z])([A-Z])", r"\1" + CUT + r"\2")
    for _ in range(2):
        marked = S.sub(marked, "([A-Z])([A-Z][a-z])", r"\1" + CUT + r"\2")
    return f"list_filter(string_split({marked}, '{CUT}'), lambda p: p <> '')"


_CODE_TEXT = "replace(replace(replace(text, '. ', ''), ' of ', '_'), ' the ', 'X')"


def _code_text():
    return T.replace_all(C("text"), [(". ", ""), (" of ", "_"), (" the ", "X")])


@query("x11_camel_code_parts", f"""
WITH t AS (SELECT doc_id, {_CODE_TEXT} AS code FROM documents),
s AS (SELECT doc_id, code, flatten(list_transform({S.words('code')}, lambda w: string_split(w, '_'))) AS snake FROM t)
SELECT doc_id,
  array_to_string(flatten(list_transform(snake, lambda w: {_sql_camel('w')})), '|') AS parts,
  array_to_string(flatten(list_transform({S.words('code')}, lambda w: {_sql_camel('w')})), '|') AS camel_only
FROM s""")
def camel_code_parts(spark, folder):
    code = _code_text()
    return documents(spark, folder).select(
        "doc_id", F.array_join(K.code_parts(code), "|").alias("parts"),
        F.array_join(K.code_parts(code, snake=False), "|").alias("camel_only"))


@query("x12_words_with_offsets", f"""
WITH p AS (SELECT doc_id, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS pos
           FROM (SELECT doc_id, regexp_extract_all(text, {S.q(K.WORD_SYMBOL_OR_GAP)}) AS pieces FROM documents)),
o AS (SELECT *, sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY pos) AS stop FROM p)
SELECT doc_id, count(*)::BIGINT AS n_tokens, string_agg(piece, ' ' ORDER BY pos) AS tokens,
  string_agg((stop - length(piece)) || '-' || stop, ' ' ORDER BY pos) AS spans
FROM o WHERE NOT regexp_matches(piece, '^[\\p{{Z}}\\p{{C}}]') GROUP BY doc_id""")
def words_with_offsets(spark, folder):
    spans = tokentables.words_with_offsets(documents(spark, folder), "doc_id", "text")
    listed = F.sort_array(F.collect_list(F.struct("start", "stop", "token")))
    return (
        spans.groupBy("doc_id").agg(listed.alias("s"))
        .select("doc_id", F.size("s").cast("long").alias("n_tokens"),
                F.array_join(F.col("s.token"), " ").alias("tokens"),
                F.array_join(F.transform("s", lambda x: F.concat_ws("-", x["start"], x["stop"])), " ").alias("spans")))


@query("x13_alnum_runs", f"""
SELECT doc_id, array_to_string(list_filter(runs, lambda t, i: t <> ' ' OR i = 1 OR i = len(runs)), '|') AS runs
FROM (SELECT doc_id, regexp_extract_all(text, {S.q(K.ALNUM_RUNS)}) AS runs FROM documents)""")
def alnum_runs(spark, folder):
    return documents(spark, folder).select("doc_id", F.array_join(K.alnum_runs(C("text")), "|").alias("runs"))


@query("x14_token_view", r"""
WITH p AS (SELECT conv_id, turn, unnest(c) AS piece, generate_subscripts(c, 1) AS pos FROM (
  SELECT conv_id, turn, regexp_extract_all(text, '[\p{L}\p{N}\p{M}]+|[^\p{Z}\p{C}]|[\p{Z}\p{C}]+') AS c FROM conversations)),
q AS (SELECT *, sum(length(piece)) OVER u - length(piece) AS start, NOT regexp_matches(piece, '^[\p{Z}\p{C}]') AS tok, sum(NOT regexp_matches(piece, '^[\p{Z}\p{C}]')) OVER u AS nr
  FROM p WINDOW u AS (PARTITION BY conv_id, turn ORDER BY pos)),
g AS (SELECT conv_id, turn, string_agg(lower(piece), ' ' ORDER BY pos) AS lowered, string_agg(piece, ' ' ORDER BY pos) FILTER (WHERE nr BETWEEN 3 AND 8) AS cut,
  min(start) AS a, max(start + length(piece)) AS b, min(start) FILTER (WHERE nr BETWEEN 3 AND 8) AS c, max(start + length(piece)) FILTER (WHERE nr BETWEEN 3 AND 8) AS d
  FROM q WHERE tok GROUP BY conv_id, turn)
SELECT t.conv_id, t.turn, CASE WHEN text IS NOT NULL THEN coalesce(lowered, '') END AS lowered, CASE WHEN text IS NOT NULL THEN coalesce(cut, '') END AS cut,
  CASE WHEN text IS NOT NULL THEN coalesce(substring(text, (a + 1)::BIGINT, (b - a)::BIGINT), '') END AS untokenised,
  CASE WHEN text IS NOT NULL THEN coalesce(substring(text, (c + 1)::BIGINT, (d - c)::BIGINT), '') END AS cut_text
FROM conversations t LEFT JOIN g USING (conv_id, turn)""")
def token_view(spark, folder):
    w = K.words_and_symbols(C("text"))
    cells = K.words_with_gaps(C("text"))
    return table(spark, folder, "conversations").select(
        "conv_id", "turn", F.array_join(F.transform(w, F.lower), " ").alias("lowered"),
        F.array_join(F.slice(w, 3, 6), " ").alias("cut"), K.untokenised(cells).alias("untokenised"),
        K.untokenised(F.slice(cells, 3, 6)).alias("cut_text"))


@query("x15_ngrams", f"""
WITH t AS (SELECT conv_id, turn, list_transform({S.words('text')}, lambda w: lower(w)) AS w FROM conversations),
g AS (SELECT conv_id, turn, w, unnest(range(1, len(w) + 1)) AS s FROM t),
k AS (SELECT conv_id, turn, w, s, unnest(range(1, least(3, len(w) - s + 1) + 1)) AS n FROM g)
SELECT conv_id, turn, string_agg(array_to_string(w[s:s + n - 1], ' '), '|' ORDER BY s, n) AS grams
FROM k WHERE w[s] <> 'the' GROUP BY conv_id, turn""")
def ngrams(spark, folder):
    grams = K.ngrams(K.words(C("text")), 3, uncased=True, skip=lambda g: F.get(g, F.lit(0)) == "the")
    return (table(spark, folder, "conversations").select("conv_id", "turn", grams.alias("g"))
            .where(F.size("g") > 0).select("conv_id", "turn", F.array_join("g", "|").alias("grams")))


@query("x16_normalize_answer", f"SELECT conv_id, turn, {S.collapse('lower(text)')} AS answer FROM conversations")
def normalize_answer(spark, folder):
    return table(spark, folder, "conversations").select("conv_id", "turn", T.normalize_answer(C("text")).alias("answer"))


@query("x17_normalize_string", DOC.format(S.collapse(S.no_punct("lower(text)")) + " AS normal"))
def normalize_string(spark, folder):
    return documents(spark, folder).select("doc_id", T.normalize_string(C("text")).alias("normal"))


def _sql_nfd(col: str) -> str:
    """Decomposition of the precomposed Latin letters, as nested replacements."""
    import unicodedata

    pairs = [(chr(c), unicodedata.normalize("NFD", chr(c))) for c in range(0xC0, 0x180)
             if unicodedata.normalize("NFD", chr(c)) != chr(c)]
    return S.replaces(col, pairs)


@query("x18_nfd_tokens", f"""
SELECT {_sql_nfd('token')} AS token, sum(n)::BIGINT AS n
FROM (SELECT token, count(*) AS n FROM (SELECT unnest({S.words('text')}) AS token FROM documents) GROUP BY token)
GROUP BY 1""")
def nfd_tokens(spark, folder):
    counts = tokentables.token_counts(documents(spark, folder).select(K.words(C("text")).alias("tokens")))
    return tokentables.normalise_nfd(counts).groupBy("token").agg(F.sum("n").alias("n"))


def _sql_literal(col: str, char_to_token=T.PYTHON_CHAR_TO_TOKEN, token_to_char=T.PYTHON_TOKEN_TO_CHAR) -> str:
    col = S.replaces(f"replace({col}, ' ', ' ▁ ')", char_to_token.items())
    ended = r"regexp_replace(x, '\n\z', '') || ' ENDCOM'"
    col = f"list_transform([{col}], lambda x: CASE WHEN starts_with(x, ' STOKEN0') THEN {ended} ELSE x END)[1]"
    col = S.sub(S.replaces(col, [("\n", " STRNEWLINE "), ("\t", " TABSYMBOL ")]), " +", " ")
    col = S.sub(S.sub(col, r"(\P{N})(\p{P})", r"\1 \2 "), r"(\p{P})(\P{N})", r" \1 \2")
    col = S.collapse(S.sub(col, r"(\p{S})", r" \1 "))
    return f"replace({S.replaces(col, token_to_char.items())}, chr(13), '')"


@query("x19_literal_tokens", DOC.format(_sql_literal("text") + " AS literal"))
def literal_tokens(spark, folder):
    return documents(spark, folder).select("doc_id", T.normalize_literal(C("text"), False).alias("literal"))


@query("x19_java_literal_tokens", DOC.format(_sql_literal("text", T.JAVA_CHAR_TO_TOKEN, T.JAVA_TOKEN_TO_CHAR) + " AS literal"))
def java_literal_tokens(spark, folder):
    return documents(spark, folder).select(
        "doc_id", T.normalize_literal(C("text"), False, T.JAVA_CHAR_TO_TOKEN, T.JAVA_TOKEN_TO_CHAR).alias("literal"))


# runs of more than five equal characters are cut by their lengths; the rule itself uses a back-reference
_SQUEEZED = r"""ch AS (SELECT doc_id, unnest(c) AS c, generate_subscripts(c, 1) AS i FROM (SELECT doc_id, regexp_extract_all(regexp_replace(text, ' +', ' ', 'g'), '(?s).') AS c FROM documents)),
st AS (SELECT *, c IS DISTINCT FROM lag(c) OVER (PARTITION BY doc_id ORDER BY i) AS starts FROM ch),
rn AS (SELECT *, sum(starts::INT) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM st),
ps AS (SELECT *, row_number() OVER (PARTITION BY doc_id, run ORDER BY i) AS nth FROM rn),
sq AS (SELECT doc_id, string_agg(c, '' ORDER BY i) FILTER (WHERE nth <= 5 OR c = chr(10)) AS text FROM ps GROUP BY doc_id),
co AS (SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(sq.text, '') END AS text FROM documents d LEFT JOIN sq USING (doc_id))"""


@query("x19_comment_tokens", f"""WITH {_SQUEEZED} SELECT doc_id,
  CASE WHEN len(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_]')) >= 2 THEN {_sql_literal('text')} ELSE '' END AS literal FROM co""")
def comment_tokens(spark, folder):
    return documents(spark, folder).select("doc_id", T.normalize_literal(C("text"), True).alias("literal"))


_SPLIT_TEXT = "replace(text, 'er', '@@ er') || '@@'"


@query("x20_restore_subwords", DOC.format(
    S.sub(_SPLIT_TEXT, "(?m)(@@ )|(@@ ?$)", "") + " AS restored"))
def restore_subwords(spark, folder):
    split = F.concat(F.replace(C("text"), F.lit("er"), F.lit("@@ er")), F.lit("@@"))
    return documents(spark, folder).select("doc_id", T.restore_subwords(split).alias("restored"))


@query("x21_guard_unknown", """
SELECT conv_id, turn, replace(replace(text, ' le ', ' <unk> '), '<unk>', '<<unk>>') AS guarded FROM conversations""")
def guard_unknown(spark, folder):
    masked = F.replace(C("text"), F.lit(" le "), F.lit(" <unk> "))
    return table(spark, folder, "conversations").select("conv_id", "turn", T.guard_unknown(masked).alias("guarded"))


_PATH = "regexp_replace(url, '^https?://', '')"
_NTH = f"array_to_string(string_split({_PATH}, '/')[1:2], '/')"


@query("x22_split_repo_path",
       f"SELECT page_id, {_NTH} AS repo, substr({_PATH}, length({_NTH}) + 2) AS inner_path FROM pages")
def split_repo_path(spark, folder):
    repo, inner = T.split_repo_path(F.regexp_replace("url", "^https?://", ""))
    return table(spark, folder, "pages").select("page_id", repo.alias("repo"), inner.alias("inner_path"))


@query("x23_pivot_names", f"""
SELECT doc_id,
  CASE WHEN list_position(w, ',') > 1 THEN w[list_position(w, ',') - 1]
       WHEN list_position(w, ',') = 1 THEN w[len(w)] END AS before_comma,
  CASE WHEN list_position(w, '.') > 0 THEN w[list_position(w, '.') + 1] END AS after_dot
FROM (SELECT doc_id, regexp_extract_all(text, {S.q(K.WORD_OR_SYMBOL)}) AS w FROM documents)""")
def pivot_names(spark, folder):
    w = K.words_and_symbols(C("text"))
    return documents(spark, folder).select("doc_id", T.token_before(w, ",").alias("before_comma"),
                                           T.token_after(w, ".").alias("after_dot"))


_ATTRS = r"""regexp_extract_all(html, '([a-z]+="[^"<>]*")', 1)"""
_SIGNATURE = ("'call ( ' || array_to_string(list_transform(" + _ATTRS +
              r""", lambda a: replace(replace(replace(replace(a, '="', ' [ ] '), '"', ''), '(', ''), ')', '')), ' , ')"""
              " || ' ( nested , pair ) ) { tail ( ) }'")
_INNER = f"array_to_string(list_transform({_ATTRS}, lambda a: replace(replace(replace(replace(a, '=\"', ' [ ] '), '\"', ''), '(', ''), ')', '')), ' , ') || ' ( nested , pair )'"
_ARG = r"""regexp_replace(trim(replace(a, '[ ]', '')), ' +', ' ', 'g')"""


@query("x24_signature_arguments", f"""
WITH s AS (SELECT page_id, string_split({_INNER}, ',') AS args FROM pages)
SELECT page_id,
  array_to_string(list_transform(args, lambda a: array_to_string(string_split({_ARG}, ' ')[:-2] ||
      [CASE WHEN contains(a, '[ ]') THEN '[ ]' ELSE '' END], ' ')), '|') AS types,
  array_to_string(list_transform(args, lambda a: string_split({_ARG}, ' ')[-1]), '|') AS names
FROM s""")
def signature_arguments(spark, folder):
    attrs = F.regexp_extract_all("html", F.lit(r'([a-z]+="[^"<>]*")'), 1)
    plain = F.transform(attrs, lambda a: T.replace_all(a, [('="', " [ ] "), ('"', ""), ("(", ""), (")", "")]))
    signature = F.concat(F.lit("call ( "), F.array_join(plain, " , "), F.lit(" ( nested , pair ) ) { tail ( ) }"))
    args = T.argument_types_and_names(signature)
    return (table(spark, folder, "pages").select("page_id", args.alias("a"))
            .select("page_id", F.array_join("a.type", "|").alias("types"), F.array_join("a.name", "|").alias("names")))


_DIRECTIVE_PAIRS = [("<br>", "# endif"), ("<meta ", "# define "), ("<b>", "# ifdef "), ("<li>", '# include "'),
                    ("</li>", '" '), ("<h1>", "# if "), ("<!--", "# define ad ( "), ("-->", " ) ( 1 ) ")]


def _sql_directives(col: str) -> str:
    for pattern in T.CPP_DIRECTIVES:
        col = S.sub(col, pattern, "")
    return S.strip(S.replaces(col, [(p, "") for p in T.CPP_PHRASES]))


_ANNOTATED = "'@ Override @ SuppressWarnings ( ' || url || ' ) void ' || page_id"


@query("x25_strip_annotations_directives", f"""
SELECT page_id, regexp_replace({_ANNOTATED}, {S.q(T.JAVA_ANNOTATIONS)}, '') AS bare,
  {_sql_directives(S.replaces('html', _DIRECTIVE_PAIRS))} AS undirected
FROM pages""")
def strip_annotations_directives(spark, folder):
    annotated = F.concat(F.lit("@ Override @ SuppressWarnings ( "), C("url"), F.lit(" ) void "),
                         C("page_id").cast("string"))
    return table(spark, folder, "pages").select(
        "page_id", T.strip_annotations(annotated).alias("bare"),
        T.strip_directives(T.replace_all(C("html"), _DIRECTIVE_PAIRS)).alias("undirected"))


_BLOCK, _INLINE = "<!--.*?-->", "<li>.*?</li>"
_AFTER_BLOCK = S.sub("html", "(?s)" + _BLOCK, "")
_COMMENTS = (f"array_to_string(regexp_extract_all(html, '(?s){_BLOCK}'), ' ') || "
             f"array_to_string(list_transform(regexp_extract_all({_AFTER_BLOCK}, '{_INLINE}'), lambda c: ' <INLINE> ' || c), '')")


@query("x26_doc_code_pair", f"""
WITH p AS (SELECT page_id, len(regexp_extract_all(html, '(?s){_BLOCK}')) AS n, {_COMMENTS} AS comments,
                  {S.sub(S.sub(_AFTER_BLOCK, _INLINE, ''), S.SPACE + '+', ' ')} AS code FROM pages),
k AS (SELECT *, n > 0 AND length({S.sub("replace(replace(comments, '<INLINE>', ''), 'ENDCOM', '')", r'[^\p{L}\p{N}_]', '')}) >= 5 AS keep FROM p)
SELECT page_id, CASE WHEN keep THEN code ELSE '' END AS code, CASE WHEN keep THEN comments ELSE '' END AS comments FROM k""")
def doc_code_pair(spark, folder):
    code, comments = T.split_doc_and_code(C("html"), _BLOCK, _INLINE)
    return table(spark, folder, "pages").select("page_id", code.alias("code"), comments.alias("comments"))


@query("x27_split_hyphens", DOC.format(
    S.sub("replace(text, ', ', '-')", r"(\S)-(\S)", r"\1 ##AT##-##AT## \2") + " AS split"))
def split_hyphens(spark, folder):
    return documents(spark, folder).select(
        "doc_id", T.split_hyphens(F.replace(C("text"), F.lit(", "), F.lit("-"))).alias("split"))


def _sql_special(token: str) -> str:
    cases = " ".join(f"WHEN contains({token}, {S.q(k)}) THEN replace({token}, {S.q(k)}, {S.q(v)})"
                     for k, v in reversed(T.TREE_SPECIALS.items()))
    return f"CASE {cases} ELSE {token} END"


_ENTITIES = [("***", "&apos;s&amp;"), ("%%%", "&quot;"), ("###", "("), (".", ")")]


@query("x28_escape_tree_text", DOC.format(
    f"array_to_string(list_transform(string_split(translate({S.replaces('text', _ENTITIES)}, '()', '（）'), ' '), "
    f"lambda t: {_sql_special('t')}), ' ') AS escaped, " +
    S.replaces("replace(text, ' the ', ' TRUNC ( -RRB- ) ')", T.TREE_BRACKET_FIXES) + " AS fixed"))
def escape_tree_text(spark, folder):
    return documents(spark, folder).select(
        "doc_id", T.escape_tree_text(T.replace_all(C("text"), _ENTITIES)).alias("escaped"),
        T.fix_tree_brackets(F.replace(C("text"), F.lit(" the "), F.lit(" TRUNC ( -RRB- ) "))).alias("fixed"))


@query("x29_split_id", """
SELECT conv_id, turn, string_split(line, ' | ')[1] AS key, substr(line, length(string_split(line, ' | ')[1]) + 4) AS body
FROM (SELECT conv_id, turn, conv_id || '_' || turn || ' | ' || replace(text, '. ', ' | ') AS line FROM conversations)""")
def split_id(spark, folder):
    line = F.concat(F.concat_ws("_", "conv_id", "turn"), F.lit(" | "), F.replace(C("text"), F.lit(". "), F.lit(" | ")))
    key, body = T.split_id(line)
    return table(spark, folder, "conversations").select("conv_id", "turn", key.alias("key"), body.alias("body"))


@query("x30_human_number", """
WITH n AS (SELECT o_orderkey, o_totalprice * (CASE o_orderkey % 4 WHEN 0 THEN 0.01 WHEN 1 THEN 1 WHEN 2 THEN 1000 ELSE 1e6 END)::DOUBLE AS x FROM orders),
d AS (SELECT o_orderkey, x, CASE WHEN x = 0 THEN 0 ELSE floor(log10(abs(x)))::INT END AS digits FROM n),
r AS (SELECT o_orderkey, CASE WHEN x = 0 THEN 0.0::DOUBLE ELSE round_even(x / pow(10.0::DOUBLE, digits - 2), 0) * pow(10.0::DOUBLE, digits - 2) END AS v FROM d),
g AS (SELECT o_orderkey, v, CASE WHEN abs(v) < 1000 THEN 0 ELSE floor((log10(abs(v)) + 1e-12) / 3)::INT END AS grp FROM r)
SELECT o_orderkey, regexp_replace(printf('%.6f', v / pow(1000.0::DOUBLE, grp)), '\\.?0+$', '') || ['', 'K', 'M', 'B', 'T'][grp + 1] AS shown FROM g""")
def human_number(spark, folder):
    k = C("o_orderkey") % 4
    x = C("o_totalprice") * F.when(k == 0, F.lit(0.01)).when(k == 1, F.lit(1.0)).when(k == 2, F.lit(1000.0)).otherwise(F.lit(1e6))
    return table(spark, folder, "orders").select("o_orderkey", T.human_number(x).alias("shown"))


@query("x31_subtokens", f"""
SELECT doc_id, array_to_string(list_transform({S.words("replace(text, 'er', '_er')")}, lambda w: array_to_string(string_split(w, '_'), '+')), ' ') AS subtokens
FROM documents""")
def subtokens(spark, folder):
    nested = F.transform(K.words(F.replace(C("text"), F.lit("er"), F.lit("_er"))), K.snake_parts)
    return documents(spark, folder).select(
        "doc_id", F.array_join(F.transform(nested, lambda p: F.array_join(p, "+")), " ").alias("subtokens"))


@query("x32_truncate_target", f"""
SELECT conv_id, turn, array_to_string(CASE WHEN role = 'system' THEN w ELSE w[:20] END, ' ') AS tokens
FROM (SELECT conv_id, turn, role, {S.words('lower(text)')} AS w FROM conversations)""")
def truncate_target(spark, folder):
    w = K.words(F.lower("text"))
    held_out = C("role") == "system"  # stands for the test split, whose targets stay whole
    return table(spark, folder, "conversations").select(
        "conv_id", "turn", F.array_join(F.when(held_out, w).otherwise(F.slice(w, 1, 20)), " ").alias("tokens"))


@query("x33_byte_ids", f"""
WITH t AS (SELECT DISTINCT unnest({S.words('text')}) AS token FROM documents),
h AS (SELECT token, hex(encode(token)) AS x, least(octet_length(encode(token)), 14) AS n FROM t)
SELECT token, array_to_string([256] || list_transform(range(0, n), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::INT)
    || [257] || list_transform(range(0, 14 - n), lambda i: 258), ' ') AS ids FROM h""")
def byte_ids(spark, folder):
    tokens = documents(spark, folder).select(F.explode(K.words(C("text"))).alias("token")).distinct()
    return tokens.select("token", F.array_join(T.byte_ids(C("token"), 16), " ").alias("ids"))
