"""Registered queries: trees (J14, J15, W19-W27) on the tag trees of pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import tokens as K
from ..operators import subword as B, trees as R
from ..operators.tokentables import token_counts
from ..session import staged, table
from . import sql as S
from .common import as_long
from .registry import query
from .subwords import MANY, MERGES, learned, _FINAL, merges_sql

C = F.col


def nodes(spark, folder):
    return R.nodes(R.events(table(spark, folder, "pages"), "page_id", "html"))


def merged(spark, folder):
    return R.merge_trees(R.split_trees(nodes(spark, folder)))


PIECES_SQL = r"""pc AS (SELECT doc, unnest(p) AS piece, generate_subscripts(p, 1) AS pos FROM (
  SELECT page_id AS doc, regexp_extract_all(regexp_replace(html, '(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->', '', 'g'),
    '</?[A-Za-z][^>]*>|<[!?][^>]*>|<[^<]*|[^<]+') AS p FROM pages))"""
# the stack of open elements, one recursion step per tag of a page; the rules are written out here on purpose
EVENTS_SQL = f"""{PIECES_SQL},
ru AS (SELECT unnest(string_split(t, ' ')) AS label, string_split(e, ' ') AS ended, string_split(u, ' ') AS scope FROM (VALUES
  ('address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul', 'p', 'button caption html object table td template th'),
  ('li', 'li', 'ul ol menu'), ('dt dd', 'dt dd', 'dl'), ('td th', 'td th', 'tr table'), ('tr', 'tr', 'table'), ('thead tbody tfoot', 'thead tbody tfoot', 'table'),
  ('option', 'option', 'select'), ('optgroup', 'option optgroup', 'select'), ('body', 'head', 'html')) v(t, e, u)),
kd AS (SELECT *, CASE WHEN label <> '' AND piece[2] = '/' THEN 'close' WHEN label <> '' THEN 'open' WHEN (piece[1:2] IN ('<!', '<?') AND suffix(piece, '>')) OR value = '' THEN 'skip' ELSE 'text' END AS kind,
  label IN ('area', 'base', 'br', 'col', 'embed', 'hr', 'img', 'input', 'link', 'meta', 'param', 'source', 'track', 'wbr') AS void
  FROM (SELECT doc, pos, piece, lower(regexp_extract(piece, '^</?([A-Za-z][A-Za-z0-9:-]*)[^>]*>$', 1)) AS label, {S.strip('piece')} AS value FROM pc)),
tg AS MATERIALIZED (SELECT kd.*, row_number() OVER (PARTITION BY doc ORDER BY pos) AS i, coalesce(ended, []) AS ended, coalesce(scope, []) AS scope FROM kd LEFT JOIN ru USING (label) WHERE kind IN ('open', 'close')),
st AS (SELECT doc, 0::BIGINT AS i, []::VARCHAR[] AS r, 0 AS before, false AS own FROM (SELECT DISTINCT doc FROM pc)
  UNION ALL SELECT doc, i, CASE WHEN kind = 'open' AND NOT void THEN [label] ELSE [] END || r[(gone + 1):], CASE WHEN kind = 'close' THEN greatest(gone - 1, 0) ELSE gone END, kind = 'open' OR gone > 0 FROM (
    SELECT *, CASE WHEN kind = 'close' THEN hit WHEN hit > 0 AND (wall = 0 OR hit < wall) THEN hit ELSE 0 END::BIGINT AS gone FROM (
      SELECT tg.doc, tg.i, kind, void, label, r, coalesce(list_position(list_transform(r, lambda x: CASE WHEN kind = 'close' THEN x = label ELSE list_contains(ended, x) END), true), 0) AS hit,
        coalesce(list_position(list_transform(r, lambda x: list_contains(scope, x)), true), 0) AS wall FROM st JOIN tg ON tg.doc = st.doc AND tg.i = st.i + 1))),
fx AS MATERIALIZED (SELECT st.*, tg.kind, tg.void, tg.label, tg.pos FROM st JOIN tg USING (doc, i)),
lo AS (SELECT doc, len(arg_max(r, i)) AS left_open FROM st GROUP BY doc)"""
NODES = f"""{EVENTS_SQL},
ev AS (SELECT doc, row_number() OVER (PARTITION BY doc ORDER BY pos, part) AS pos, kind, label, value FROM (
  SELECT doc, pos, 2 AS part, 'text' AS kind, NULL AS label, value FROM kd WHERE kind = 'text'
  UNION ALL SELECT doc, pos, 1, 'close', NULL, NULL FROM (SELECT doc, pos, unnest(range(before)) FROM fx)
  UNION ALL SELECT doc, pos, 2, kind, CASE WHEN kind = 'open' THEN label END, NULL FROM fx WHERE own
  UNION ALL SELECT doc, pos, 3, 'close', NULL, NULL FROM fx WHERE void AND kind = 'open'
  UNION ALL SELECT doc, 1000000000, 1, 'close', NULL, NULL FROM (SELECT doc, unnest(range(left_open)) FROM lo))),
cn AS (SELECT *, sum(CASE kind WHEN 'open' THEN 1 WHEN 'close' THEN -1 ELSE 0 END) OVER u AS after, sum((kind <> 'close')::INT) OVER u AS seen,
  sum((kind = 'text')::INT) OVER u AS texts FROM ev WINDOW u AS (PARTITION BY doc ORDER BY pos)),
lv AS (SELECT *, CASE WHEN kind = 'open' THEN after - 1 ELSE after END AS level FROM cn),
op AS (SELECT doc, pos, level, seen - 1 AS node_id FROM lv WHERE kind = 'open'),
cl AS (SELECT doc, pos, level, texts FROM lv WHERE kind = 'close'),
nd AS (SELECT n.doc, n.pos, (n.seen - 1)::BIGINT AS node_id, CASE WHEN n.kind = 'open' THEN n.label END AS label, CASE WHEN n.kind = 'text' THEN n.value END AS value,
  n.level::BIGINT AS level, (SELECT max(op.node_id) FROM op WHERE op.doc = n.doc AND op.level = n.level - 1 AND op.pos < n.pos)::BIGINT AS parent,
  (CASE WHEN n.kind = 'text' THEN n.texts - 1 ELSE n.texts END)::BIGINT AS first_leaf,
  (CASE WHEN n.kind = 'text' THEN n.texts - 1 ELSE (SELECT arg_min(cl.texts, cl.pos) FROM cl WHERE cl.doc = n.doc AND cl.level = n.level AND cl.pos > n.pos) - 1 END)::BIGINT AS last_leaf
  FROM lv n WHERE n.kind <> 'close'),
mg AS (SELECT doc, node_id + 1 AS node_id, label, value, level + 1 AS level, coalesce(parent + 1, 0) AS parent, first_leaf, last_leaf FROM nd
  UNION ALL SELECT doc, 0, 'ROOT', NULL, 0, NULL, 0, max(last_leaf) FROM nd GROUP BY doc),
ch AS (SELECT doc, parent AS node_id, count(*) AS nc, count(label) AS nt, arg_min(label IS NOT NULL, node_id) AS ft FROM mg WHERE parent IS NOT NULL GROUP BY ALL),
mf AS (SELECT mg.*, coalesce(nc, 0) AS nc, coalesce(nt, 0) AS nt, coalesce(ft, false) AS ft FROM mg LEFT JOIN ch USING (doc, node_id))"""


@query("w19_balanced_regions", f"""
WITH {PIECES_SQL}, d AS (SELECT *, sum(CASE WHEN piece LIKE '<div%' OR piece = '<ul>' THEN 1 WHEN piece IN ('</div>', '</ul>') THEN -1 ELSE 0 END) OVER (PARTITION BY doc ORDER BY pos) AS depth FROM pc),
e AS (SELECT *, (depth = 0 AND (piece IN ('</div>', '</ul>') OR piece IN ('<nav>', '</nav>', '<article>')))::INT AS fin FROM d),
r AS (SELECT *, coalesce(sum(fin) OVER (PARTITION BY doc ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run FROM e),
g AS (SELECT doc, run, string_agg(piece, ' ' ORDER BY pos) AS body, count(*) AS n, bool_or(depth = 1 AND (piece LIKE '<div%' OR piece = '<ul>')) AS has, bool_or(fin = 1 AND piece IN ('</div>', '</ul>')) AS whole,
   bool_or(piece LIKE '<div class%') AS standalone FROM r GROUP BY doc, run)
SELECT doc AS page_id, run::BIGINT AS region, n::BIGINT AS n_tokens, body, standalone FROM g WHERE has AND whole""")
def balanced_regions(spark, folder):
    t = R.pieces(table(spark, folder, "pages"), "page_id", "html").withColumnRenamed("piece", "token")
    opening = C("token").startswith("<div") | (C("token") == "<ul>")
    cells = R.balanced_regions(t, opening, C("token").isin("</div>", "</ul>"), C("token").isin("<nav>", "</nav>", "<article>"))
    listed = F.sort_array(F.collect_list(F.struct("pos", "token")))
    return cells.groupBy("doc", "region").agg(listed.alias("s"), F.bool_or(C("token").startswith("<div class")).alias("standalone")).select(
        C("doc").alias("page_id"), as_long("region"), F.size("s").cast("long").alias("n_tokens"),
        F.array_join("s.token", " ").alias("body"), "standalone")


_SPLIT = f"""{NODES}, sh AS (SELECT *, node_id + coalesce(sum((value IS NOT NULL)::INT) OVER (PARTITION BY doc ORDER BY node_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nid FROM nd),
ks AS (SELECT doc, parent AS node_id, list(nid ORDER BY nid) AS kids FROM sh WHERE parent IS NOT NULL GROUP BY ALL),
sp AS (SELECT sh.doc, nid AS node_id, coalesce(label, 'text') AS type, NULL::VARCHAR AS value, CASE WHEN value IS NOT NULL THEN [nid + 1] ELSE [] END || coalesce(kids, []) AS children FROM sh LEFT JOIN ks USING (doc, node_id)
  UNION ALL SELECT doc, nid + 1, NULL, value, []::BIGINT[] FROM sh WHERE value IS NOT NULL)"""


@query("w20_value_nodes", f"""
WITH RECURSIVE {_SPLIT} SELECT doc, node_id::BIGINT AS node_id, type, value, array_to_string(children, ' ') AS children FROM sp""")
def value_nodes(spark, folder):
    return R.split_value_nodes(staged(nodes(spark, folder), "tree-nodes")).select(
        "doc", as_long("node_id"), "type", "value", F.array_join("children", " ").alias("children"))


@query("w21_preorder_tokens", f"""
WITH RECURSIVE {_SPLIT} SELECT doc, string_agg(coalesce(value, '<' || type || '>'), '|' ORDER BY node_id) AS tokens, string_agg(value, '|' ORDER BY node_id) AS leaves FROM sp GROUP BY doc""")
def preorder_tokens(spark, folder):
    split = staged(R.split_value_nodes(staged(nodes(spark, folder), "tree-nodes")), "tree-split")
    leaves = R.preorder_tokens(split, only_leaves=True).select("doc", F.array_join("tokens", "|").alias("leaves"))
    return R.preorder_tokens(split).select("doc", F.array_join("tokens", "|").alias("tokens")).join(leaves, "doc", "left")


@query("w22_leaves_labels_spans", f"""
WITH RECURSIVE {NODES}, x AS (SELECT *, label IS NOT NULL AND nc = 1 AND nt = 0 AS is_pos FROM mf WHERE last_leaf >= first_leaf)
SELECT doc, string_agg(value, '|' ORDER BY first_leaf) FILTER (WHERE label IS NULL) AS leaves, coalesce(string_agg(label, ' ' ORDER BY level, node_id) FILTER (WHERE is_pos), '') AS pos_tags,
  string_agg(label, ' ' ORDER BY level, node_id) FILTER (WHERE label IS NOT NULL AND NOT is_pos) AS labels,
  string_agg(first_leaf || '-' || last_leaf, ' ' ORDER BY level, node_id) FILTER (WHERE label IS NOT NULL AND NOT is_pos) AS spans FROM x GROUP BY doc""")
def leaves_labels_spans(spark, folder):
    t = R.leaves_labels_spans(merged(spark, folder))
    return t.select("doc", F.array_join("leaves", "|").alias("leaves"), F.array_join("pos_tags", " ").alias("pos_tags"),
                    F.array_join("labels", " ").alias("labels"),
                    F.array_join(F.transform("spans", lambda s: F.array_join(s, "-")), " ").alias("spans"))


def _sql_collapse(condition: str, label: str) -> str:
    return f"""WITH RECURSIVE {NODES}, f AS (SELECT *, {condition} AS single FROM (SELECT *, lead(ft) OVER (PARTITION BY doc ORDER BY node_id) AS next_ft FROM mf)),
c AS (SELECT *, sum((NOT coalesce(prev, false))::INT) OVER (PARTITION BY doc ORDER BY node_id) AS chain FROM (SELECT *, lag(single) OVER (PARTITION BY doc ORDER BY node_id) AS prev FROM f))
SELECT doc, min(node_id)::BIGINT AS node_id, {label} AS label, count(*)::BIGINT AS size FROM c WHERE label IS NOT NULL GROUP BY doc, chain"""


@query("w23_collapse_last", _sql_collapse("nc = 1 AND nt = 1 AND parent IS NOT NULL", "arg_max(label, node_id)"))
def collapse_last(spark, folder):
    return R.collapse_unary(merged(spark, folder), collapse_pos=True).select("doc", as_long("node_id"), "label", as_long("size"))


@query("w23_collapse_joined", _sql_collapse("nc = 1 AND nt = 1 AND coalesce(next_ft, false)", "string_agg(label, '+' ORDER BY node_id)"))
def collapse_joined(spark, folder):
    return R.collapse_unary(merged(spark, folder), collapse_pos=False, collapse_root=True, join="+").select(
        "doc", as_long("node_id"), "label", as_long("size"))


@query("w24_tree_symbols", f"""
WITH RECURSIVE {NODES} SELECT token, count(*)::BIGINT AS n FROM (SELECT unnest({S.words('value')}) AS token FROM mg WHERE value IS NOT NULL
  UNION ALL SELECT label FROM mg WHERE label IS NOT NULL) GROUP BY token""")
def tree_symbols(spark, folder):
    return R.symbols(merged(spark, folder), K.words).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


@query("w25_subword_children", f"""
WITH RECURSIVE {NODES}, lw AS MATERIALIZED (SELECT doc, node_id, parent, unnest(w) AS token, generate_subscripts(w, 1) - 1 AS word_no FROM (SELECT doc, node_id, parent, {S.words('value')} AS w FROM mg WHERE value IS NOT NULL)),
{merges_sql(MERGES, "(SELECT token, count(*) AS n FROM lw GROUP BY token)")},
s AS (SELECT token, p FROM {_FINAL} WHERE len(p) > 1)
SELECT doc, node_id, word_no::BIGINT AS word_no, piece_no::BIGINT AS piece_no, piece, label FROM (
  SELECT l.doc, l.node_id, l.word_no, generate_subscripts(p, 1) - 1 AS piece_no, unnest(p) AS piece, t.label || '_bpe' AS label
  FROM lw l JOIN s USING (token) JOIN mg t ON t.doc = l.doc AND t.node_id = l.parent)""")
def subword_children(spark, folder):
    return _subword_children(spark, folder, MERGES)


@query("w25_children_1000_merges")
def children_1000_merges(spark, folder):
    return _subword_children(spark, folder, MANY)


def _subword_children(spark, folder, merges):
    m = staged(merged(spark, folder), "tree-nodes")  # read for the counts and for both sides of the lookup
    counts = token_counts(m.where(C("value").isNotNull()).select(K.words(C("value")).alias("tokens")))
    segmented = B.segment(counts, learned(spark, folder, "pages", lambda: counts, merges))
    return R.subword_children(m, segmented, K.words).select(
        "doc", as_long("node_id"), as_long("word_no"), as_long("piece_no"), "piece", "label")


@query("w26_merge_trees", f"WITH RECURSIVE {NODES} SELECT doc, node_id::BIGINT AS node_id, label, value, level::BIGINT AS level, parent::BIGINT AS parent FROM mg")
def merge_trees(spark, folder):
    return merged(spark, folder).select("doc", as_long("node_id"), "label", "value", as_long("level"), as_long("parent"))


@query("w27_merge_order", f"""
WITH RECURSIVE {NODES}, k AS (SELECT *, first_value(first_leaf) OVER (PARTITION BY doc, parent ORDER BY node_id) AS f, lag(last_leaf) OVER (PARTITION BY doc, parent ORDER BY node_id) AS ll
  FROM mg WHERE last_leaf >= first_leaf AND parent IS NOT NULL),
s AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY last_leaf, f DESC) - 1 AS step, max(last_leaf) OVER (PARTITION BY doc) + 1 AS nl FROM k WHERE ll IS NOT NULL)
SELECT a.doc, string_agg((CASE WHEN a.f = a.ll THEN a.f ELSE l.nl + l.step END) || ',' || (CASE WHEN a.first_leaf = a.last_leaf THEN a.first_leaf ELSE r.nl + r.step END) || ',' || (a.nl + a.step), ',' ORDER BY a.step) AS encoding
FROM s a LEFT JOIN s l ON l.doc = a.doc AND l.f = a.f AND l.last_leaf = a.ll LEFT JOIN s r ON r.doc = a.doc AND r.f = a.first_leaf AND r.last_leaf = a.last_leaf AND a.first_leaf <> a.f
GROUP BY a.doc""")
def merge_order(spark, folder):
    steps = R.merge_order(staged(merged(spark, folder), "tree-nodes"))
    triple = F.struct("step", F.concat_ws(",", "left", "right", "parent").alias("t"))
    return steps.groupBy("doc").agg(F.sort_array(F.collect_list(triple)).alias("s")).select(
        "doc", F.array_join("s.t", ",").alias("encoding"))


@query("j14_parent_child", f"""
WITH RECURSIVE {NODES}, ed AS (SELECT doc, unnest(list(node_id)) AS child FROM mg WHERE parent IS NOT NULL GROUP BY doc, parent)
SELECT ed.doc, count(*)::BIGINT AS edges, count(c.node_id)::BIGINT AS matched, (count(*) - count(DISTINCT child))::BIGINT AS repeated
FROM ed LEFT JOIN mg c ON c.doc = ed.doc AND c.node_id = ed.child GROUP BY ed.doc""")
def parent_child(spark, folder):
    return R.edge_check(staged(merged(spark, folder), "tree-nodes"))


@query("j15_covered_leaves", f"""
WITH RECURSIVE {NODES} SELECT t.doc, t.node_id, count(*)::BIGINT AS leaves, sum(length(l.value))::BIGINT AS chars FROM mg t JOIN mg l
ON l.doc = t.doc AND l.value IS NOT NULL AND l.first_leaf BETWEEN t.first_leaf AND t.last_leaf WHERE t.label IS NOT NULL GROUP BY t.doc, t.node_id""")
def covered_leaves(spark, folder):
    cells = R.covered_leaves(staged(merged(spark, folder), "tree-nodes"), F.length)
    return cells.select("doc", as_long("node_id"), as_long("leaves"), as_long("total").alias("chars"))


@query("w20_page_balance", f"""
WITH RECURSIVE {EVENTS_SQL} SELECT lo.doc, count(*) FILTER (WHERE kind = 'open' AND NOT void)::BIGINT AS opened,
  (coalesce(sum(before), 0) + any_value(left_open))::BIGINT AS implied, count(*) FILTER (WHERE kind = 'close' AND NOT own)::BIGINT AS ignored
FROM lo LEFT JOIN fx ON fx.doc = lo.doc GROUP BY lo.doc""")
def page_balance(spark, folder):
    return R.balance_report(table(spark, folder, "pages"), "page_id", "html")
