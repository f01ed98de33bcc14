"""Trees as node tables: one row per node, numbered in preorder within its document.

Tags of any name are kept. A page need not be well formed: void tags are nodes
without children, end tags that may be left out are implied by what follows, an
end tag closes what is still open inside its element, end tags without an open
element are ignored, and the end of the page closes the rest. Every page
therefore gives a balanced stream of events.

Texts are hashed to tasks by document once; tags are cut out after that, so
every window by document (or document and level) reuses that placement. A
window never holds more than one document. Node spans come from running
counts, not from comparing nodes with leaves.
"""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from ..functions.tokens import strip
from ..session import placed_by

NO_CONTENT = "(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->"
# a tag, a declaration, or text; "<" that begins neither starts a text
PIECES = "(</?[A-Za-z][^>]*>|<[!?][^>]*>|<[^<]*|[^<]+)"
TAG_NAME = "^</?([A-Za-z][A-Za-z0-9:-]*)[^>]*>$"

# Fixed values of HTML: elements without content, and start tags that end an
# open element (first set) unless an element of the second set lies between.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = ("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
           "header hr main menu nav ol p pre section table ul")
_P_SCOPE = "button caption html object table td template th"
_RULES = [
    (_BLOCKS, "p", _P_SCOPE),
    ("li", "li", "ul ol menu"),
    ("dt dd", "dt dd", "dl"),
    ("td th", "td th", "tr table"),
    ("tr", "tr", "table"),
    ("thead tbody tfoot", "thead tbody tfoot", "table"),
    ("option", "option", "select"),
    ("optgroup", "option optgroup", "select"),
    ("body", "head", "html"),
]
ENDS = {tag: (frozenset(ended.split()), frozenset(scope.split())) for tags, ended, scope in _RULES for tag in tags.split()}


def pieces(df: DataFrame, key: str, html: str) -> DataFrame:
    """(doc, pos, piece): tags and text runs in order."""
    return _cut(df, key, html).select("doc", F.posexplode("cut").alias("pos", "piece"))


def _cut(df: DataFrame, key: str, html: str) -> DataFrame:
    cleaned = F.regexp_replace(F.coalesce(html, F.lit("")), F.lit(NO_CONTENT), F.lit(""))  # a null page has no nodes
    return placed_by(df.select(F.col(key).alias("doc"), F.col(html)), "doc").select(
        "doc", F.regexp_extract_all(cleaned, F.lit(PIECES), 1).alias("cut"))


def closings(marks: list[str]) -> list[tuple[int, bool]]:
    """For each mark, how many elements end before it and whether it counts; one more entry for the end of the page.

    A mark is ``+name`` for a start tag, ``-name`` for an end tag, anything else for text.
    """
    stack, held, out = [], Counter(), []

    def end(depth: int) -> int:
        gone = len(stack) - depth
        for _ in range(gone):
            held[stack.pop()] -= 1
        return gone

    for mark in marks:
        kind, name = mark[:1], mark[1:]
        before, counts = 0, True
        if kind == "-":
            counts = held[name] > 0
            if counts:
                depth = len(stack) - 1
                while stack[depth] != name:
                    depth -= 1
                before = end(depth) - 1
        elif kind == "+":
            ended, scope = ENDS.get(name, ((), ()))
            if any(held[tag] for tag in ended):
                depth = len(stack) - 1
                while depth >= 0 and stack[depth] not in ended and stack[depth] not in scope:
                    depth -= 1
                if depth >= 0 and stack[depth] in ended:
                    before = end(depth)
            if name not in VOID:
                stack.append(name)
                held[name] += 1
        out.append((before, counts))
    return [*out, (len(stack), False)]


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("before", T.IntegerType()), T.StructField("counts", T.BooleanType())])))
def _closings(marks: pd.Series) -> pd.Series:
    return marks.map(lambda row: [{"before": before, "counts": counts} for before, counts in closings(list(row))])


def _marked(df: DataFrame, key: str, html: str) -> DataFrame:
    """(doc, cut, marks, ends) per page; texts of white space only are left out."""
    name = lambda piece: F.lower(F.regexp_extract(piece, TAG_NAME, 1))
    mark = lambda piece: (
        F.when(name(piece) != "", F.concat(F.when(piece.startswith("</"), F.lit("-")).otherwise(F.lit("+")), name(piece)))
        .when(piece.rlike("(?s)^<[!?].*>$") | (strip(piece) == ""), F.lit("skip")).otherwise(F.lit("")))
    cut = _cut(df, key, html).withColumn("cells", F.filter(
        F.transform("cut", lambda piece: F.struct(mark(piece).alias("mark"), strip(piece).alias("value"))), lambda c: c["mark"] != "skip"))
    return cut.select("doc", "cells", _closings(F.col("cells.mark")).alias("ends"))


def events(df: DataFrame, key: str, html: str) -> DataFrame:
    """(doc, pos, kind, label, value): a balanced stream of opening and closing of elements, and non-blank texts."""
    text = F.lit(None).cast("string")

    def event(kind: str, label: Column = text, value: Column = text) -> Column:
        return F.struct(F.lit(kind).alias("kind"), label.alias("label"), value.alias("value"))

    close = event("close")
    none = F.array().cast("array<struct<kind:string,label:string,value:string>>")

    def own(cell: Column) -> Column:
        label = F.substring(cell["mark"], 2, 1 << 20)
        return (
            F.when(cell["mark"] == "", F.array(event("text", value=cell["value"])))
            .when(cell["mark"].startswith("-"), F.array(close))
            .when(label.isin(*sorted(VOID)), F.array(event("open", label), close))
            .otherwise(F.array(event("open", label))))

    def step(pair: Column) -> Column:
        cell, ends = pair["cells"], pair["ends"]
        return F.concat(F.array_repeat(close, ends["before"]), F.when(ends["counts"], own(cell)).otherwise(none))

    stream = F.flatten(F.transform(F.arrays_zip("cells", "ends"), step))
    return _marked(df, key, html).select("doc", F.posexplode(stream).alias("pos", "event")).select("doc", "pos", "event.*")


def balance_report(df: DataFrame, key: str, html: str) -> DataFrame:
    """(doc, opened, implied, ignored): start tags with content, ends they left to be implied, and end tags without an open element."""
    rows = _marked(df, key, html)
    ends = lambda p: p["cells"]["mark"].startswith("-") & ~p["ends"]["counts"]
    starts = lambda c: c["mark"].startswith("+") & ~F.substring(c["mark"], 2, 1 << 20).isin(*sorted(VOID))
    return rows.select(
        "doc", F.size(F.filter("cells", starts)).cast("long").alias("opened"),
        F.aggregate("ends", F.lit(0).cast("long"), lambda n, e: n + e["before"]).alias("implied"),
        F.size(F.filter(F.arrays_zip("cells", "ends"), lambda p: F.coalesce(ends(p), F.lit(False)))).cast("long").alias("ignored"))


def nodes(stream: DataFrame) -> DataFrame:
    """Node table of balanced events.

    Columns: doc, node_id, label (null for texts), value (null for tags),
    level, pos, parent, first_leaf, last_leaf, last_node (last node below). A
    node without texts below it has last_leaf < first_leaf.
    """
    upto = W.partitionBy("doc").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    is_open, is_text = F.col("kind") == "open", F.col("kind") == "text"
    delta = F.when(is_open, 1).when(F.col("kind") == "close", -1).otherwise(0)
    counted = (
        stream.withColumn("after", F.sum(delta).over(upto))
        .withColumn("seen", F.sum((is_open | is_text).cast("int")).over(upto))
        .withColumn("texts", F.sum(is_text.cast("int")).over(upto))
        .withColumn("level", F.when(is_open, F.col("after") - 1).otherwise(F.col("after")))
    )
    # the next tag event of the same level after an opening tag is its closing tag
    closing = W.partitionBy("doc", "level", is_text).orderBy("pos")
    spanned = (
        counted.withColumn("last_leaf", F.when(is_text, F.col("texts")).otherwise(F.lead("texts").over(closing)) - 1)
        .withColumn("last_node", F.when(is_text, F.col("seen")).otherwise(F.lead("seen").over(closing)) - 1)
        .where(F.col("kind") != "close")
        .select("doc", (F.col("seen") - 1).alias("node_id"), F.when(is_open, F.col("label")).alias("label"), "value", "level",
                "pos", F.when(is_text, F.col("texts") - 1).otherwise(F.col("texts")).alias("first_leaf"), "last_leaf", "last_node")
    )
    # parent: the latest opening tag one level up; tags stand in both roles
    roles = F.array(F.struct((F.col("level") - 1).alias("slot"), F.lit(None).cast("bigint").alias("opener")),
                    F.when(F.col("label").isNotNull(), F.struct(F.col("level").alias("slot"), F.col("node_id").alias("opener"))))
    both = spanned.select("*", F.explode(F.array_compact(roles)).alias("r")).select("*", "r.slot", "r.opener").drop("r")
    latest = F.last("opener", ignorenulls=True).over(W.partitionBy("doc", "slot").orderBy("pos").rowsBetween(W.unboundedPreceding, 0))
    return both.withColumn("parent", latest).where(F.col("opener").isNull()).drop("slot", "opener")


def children_lists(table: DataFrame) -> DataFrame:
    """(doc, node_id, children): child ids in order, for nodes that have any."""
    kids = table.where(F.col("parent").isNotNull()).groupBy("doc", F.col("parent").alias("parent_id")).agg(
        F.sort_array(F.collect_list("node_id")).alias("children"))
    return kids.select("doc", F.col("parent_id").alias("node_id"), "children")


def split_value_nodes(table: DataFrame) -> DataFrame:
    """Each node with a value gets a new first child holding it; ids shift by the values before.

    Result: (doc, node_id, type, value, children).
    """
    before = W.partitionBy("doc").orderBy("node_id").rowsBetween(W.unboundedPreceding, -1)
    has_value = F.col("value").isNotNull()
    shift = F.coalesce(F.sum(has_value.cast("int")).over(before), F.lit(0))
    moved = table.withColumn("new_id", F.col("node_id") + shift)
    kids = (
        moved.where(F.col("parent").isNotNull()).groupBy("doc", F.col("parent").alias("node_id"))
        .agg(F.sort_array(F.collect_list("new_id")).alias("kids"))
    )
    full = moved.join(kids, ["doc", "node_id"], "left").withColumn("kids", F.coalesce("kids", F.array().cast("array<bigint>")))
    own = F.when(has_value, F.array_prepend("kids", F.col("new_id") + 1)).otherwise(F.col("kids"))
    typed = full.select("doc", F.col("new_id").alias("node_id"), F.coalesce("label", F.lit("text")).alias("type"),
                        F.lit(None).cast("string").alias("value"), own.alias("children"))
    values = full.where(has_value).select("doc", (F.col("new_id") + 1).alias("node_id"), F.lit(None).cast("string").alias("type"),
                                          "value", F.array().cast("array<bigint>").alias("children"))
    return typed.unionByName(values)


def preorder_tokens(split: DataFrame, only_leaves: bool = False) -> DataFrame:
    """(doc, tokens): values, and ``<type>`` for the other nodes unless only leaves are wanted."""
    rows = split.where(F.col("value").isNotNull()) if only_leaves else split
    shown = F.coalesce("value", F.concat(F.lit("<"), "type", F.lit(">")))
    return rows.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("node_id", shown.alias("t")))).alias("s")).select(
        "doc", F.col("s.t").alias("tokens"))


def with_child_figures(table: DataFrame) -> DataFrame:
    """Adds only_child (has exactly one child) and first_is_tag (its first child is a tag).

    A first child is the next row in preorder, and it is the only one when both
    subtrees end at the same node.
    """
    following = W.partitionBy("doc").orderBy("node_id")
    has_child = F.col("last_node") > F.col("node_id")
    only = has_child & (F.lead("last_node").over(following) == F.col("last_node"))
    first_tag = has_child & F.lead(F.col("label").isNotNull()).over(following)
    return table.withColumn("only_child", F.coalesce(only, F.lit(False))).withColumn(
        "first_is_tag", F.coalesce(first_tag, F.lit(False)))


def split_trees(table: DataFrame) -> DataFrame:
    """Numbers the top-level trees of each document; ids restart at 0 in each tree."""
    upto = W.partitionBy("doc").orderBy("node_id").rowsBetween(W.unboundedPreceding, 0)
    top = F.col("level") == 0
    numbered = table.withColumn("tree", F.sum(top.cast("int")).over(upto) - 1).withColumn(
        "_first", F.last(F.when(top, F.col("node_id")), ignorenulls=True).over(upto))
    for name in ("node_id", "parent", "last_node"):
        numbered = numbered.withColumn(name, F.col(name) - F.col("_first"))
    return numbered.drop("_first")


def merge_trees(trees: DataFrame, root: str = "ROOT") -> DataFrame:
    """All trees of a document under one new root, numbered in preorder again."""
    order = W.partitionBy("doc").orderBy("tree", "node_id")
    whole = W.partitionBy("doc")
    base = F.col("_new") - F.col("node_id")
    moved = trees.withColumn("_new", F.row_number().over(order).cast("bigint")).withColumn(
        "_leaf", F.max("last_leaf").over(whole)).withColumn("_node", F.max("_new").over(whole))
    node = F.struct(
        F.col("_new").alias("node_id"), "label", "value", (F.col("level") + 1).alias("level"),
        F.coalesce(F.col("parent") + base, F.lit(0)).alias("parent"), "first_leaf", "last_leaf", (F.col("last_node") + base).alias("last_node"))
    top = F.struct(
        F.lit(0).cast("bigint").alias("node_id"), F.lit(root).alias("label"), F.lit(None).cast("string").alias("value"),
        F.lit(0).cast("bigint").alias("level"), F.lit(None).cast("bigint").alias("parent"),
        F.lit(0).cast("bigint").alias("first_leaf"), F.col("_leaf").alias("last_leaf"), F.col("_node").alias("last_node"))
    rows = F.array_compact(F.array(F.when(F.col("_new") == 1, top), node))
    return moved.select("doc", F.explode(rows).alias("r")).select("doc", "r.*")


def leaves_labels_spans(merged: DataFrame) -> DataFrame:
    """(doc, leaves, pos_tags, labels, spans): leaves left to right, the rest breadth first.

    A tag whose only child is a text is a part-of-speech tag; other tags are
    inner nodes with the first and last leaf below them. Tags without any text
    are left out: such trees have no span.
    """
    rows = with_child_figures(merged).where(F.col("last_leaf") >= F.col("first_leaf"))
    is_tag = F.col("label").isNotNull()
    is_pos = is_tag & F.col("only_child") & ~F.col("first_is_tag")
    place = F.struct("level", "node_id")

    def ordered(condition, *values) -> Column:
        return F.sort_array(F.collect_list(F.when(condition, F.struct(place, *values))))

    grouped = rows.groupBy("doc").agg(
        F.sort_array(F.collect_list(F.when(~is_tag, F.struct("first_leaf", "value")))).alias("l"),
        ordered(is_pos, F.col("label")).alias("p"),
        ordered(is_tag & ~is_pos, F.col("label"), F.array("first_leaf", "last_leaf").alias("span")).alias("n"))
    return grouped.select("doc", F.col("l.value").alias("leaves"), F.col("p.label").alias("pos_tags"),
                          F.col("n.label").alias("labels"), F.col("n.span").alias("spans"))


def collapse_unary(merged: DataFrame, collapse_pos: bool, collapse_root: bool = False, join: str | None = None) -> DataFrame:
    """(doc, node_id, label, size): tags left after folding single-child chains.

    A folded chain takes its last label, or all labels joined by ``join``.
    In preorder an only child follows its parent directly, so chains are
    islands of consecutive rows.
    """
    rows = with_child_figures(merged)
    inside = W.partitionBy("doc").orderBy("node_id")
    single = F.col("only_child") & F.col("first_is_tag")
    if not collapse_pos:
        single = single & F.coalesce(F.lead("first_is_tag").over(inside), F.lit(False))
    if not collapse_root:
        single = single & F.col("parent").isNotNull()
    flagged = rows.withColumn("_single", single)
    starts = flagged.withColumn("_start", (~F.coalesce(F.lag("_single").over(inside), F.lit(False))).cast("int"))
    chains = starts.withColumn("_chain", F.sum("_start").over(inside.rowsBetween(W.unboundedPreceding, 0)))
    kept = chains.where(F.col("label").isNotNull()).groupBy("doc", "_chain")
    listed = F.sort_array(F.collect_list(F.struct("node_id", "label")))
    out = kept.agg(listed.alias("c")).withColumn("labels", F.col("c.label"))
    label = F.array_join("labels", join) if join is not None else F.element_at("labels", -1)
    return out.select("doc", F.get("c", F.lit(0))["node_id"].alias("node_id"), label.alias("label"), F.size("c").alias("size"))


def symbols(merged: DataFrame, words_of) -> DataFrame:
    """(doc, token): leaf words and tag labels, the material of a tree vocabulary."""
    leaves = merged.where(F.col("value").isNotNull()).select("doc", F.explode(words_of(F.col("value"))).alias("token"))
    return leaves.unionByName(merged.where(F.col("label").isNotNull()).select("doc", F.col("label").alias("token")))


def covered_leaves(merged: DataFrame, size) -> DataFrame:
    """(doc, node_id, leaves, total): leaves below each tag that has any, and the sum of ``size`` of their values.

    A running sum in preorder gives the total up to each node; a subtree's total
    is the one up to its last node less the one up to itself.
    """
    upto = W.partitionBy("doc").orderBy("node_id").rowsBetween(W.unboundedPreceding, 0)
    summed = merged.withColumn("_upto", F.sum(F.coalesce(size(F.col("value")), F.lit(0))).over(upto))
    ends = summed.select("doc", F.col("node_id").alias("last_node"), F.col("_upto").alias("_end"))
    tags = summed.where(F.col("label").isNotNull() & (F.col("last_leaf") >= F.col("first_leaf")))
    return tags.join(ends, ["doc", "last_node"]).select(
        "doc", "node_id", (F.col("last_leaf") - F.col("first_leaf") + 1).alias("leaves"), (F.col("_end") - F.col("_upto")).alias("total"))


def edge_check(table: DataFrame) -> DataFrame:
    """(doc, edges, matched, repeated): listed children, those that exist, and those listed twice."""
    edges = children_lists(table).select("doc", F.explode("children").alias("child"))
    listed = edges.groupBy("doc", "child").agg(F.count(F.lit(1)).alias("times"))
    found = listed.join(table.select("doc", F.col("node_id").alias("child"), F.lit(1).alias("hit")), ["doc", "child"], "left")
    return found.groupBy("doc").agg(F.sum("times").alias("edges"), F.count("hit").alias("matched"),
                                    F.count_if(F.col("times") > 1).alias("repeated"))


def merge_order(merged: DataFrame) -> DataFrame:
    """(doc, left, right, parent, step): the binarised tree as merges in bottom-up order.

    Nodes with more than two children merge them left to right. Every merge
    covers a distinct span, so operands are found by an equi-join on spans;
    one-leaf spans are the leaves themselves, numbered from 0.
    """
    leafy = merged.where((F.col("last_leaf") >= F.col("first_leaf")) & F.col("parent").isNotNull())
    siblings = W.partitionBy("doc", "parent").orderBy("node_id")
    merges = (
        leafy.withColumn("from_leaf", F.first("first_leaf").over(siblings.rowsBetween(W.unboundedPreceding, 0)))
        .withColumn("left_last", F.lag("last_leaf").over(siblings))
        .where(F.col("left_last").isNotNull())
        .select("doc", "from_leaf", "left_last", "first_leaf", "last_leaf")
    )
    n_leaves = F.max("last_leaf").over(W.partitionBy("doc")) + 1
    step = F.row_number().over(W.partitionBy("doc").orderBy("last_leaf", F.col("from_leaf").desc())) - 1
    numbered = merges.withColumn("step", step).withColumn("parent", (n_leaves + F.col("step")).cast("bigint"))
    spans = numbered.select("doc", "from_leaf", F.col("last_leaf").alias("to_leaf"), F.col("parent").alias("id"))

    def operand(rows: DataFrame, start: str, stop: str, name: str) -> DataFrame:
        known = spans.select(F.col("doc").alias("_d"), F.col("from_leaf").alias("_f"), F.col("to_leaf").alias("_t"), F.col("id").alias(f"_{name}"))
        hit = (F.col("doc") == F.col("_d")) & (F.col(start) == F.col("_f")) & (F.col(stop) == F.col("_t"))
        return rows.join(known, hit, "left").drop("_d", "_f", "_t").withColumn(
            name, F.when(F.col(start) == F.col(stop), F.col(start)).otherwise(F.col(f"_{name}"))).drop(f"_{name}")

    both = operand(operand(numbered, "from_leaf", "left_last", "left"), "first_leaf", "last_leaf", "right")
    return both.select("doc", "left", "right", "parent", "step")


def subword_children(merged: DataFrame, segmented: DataFrame, words_of) -> DataFrame:
    """(doc, node_id, word_no, piece_no, label, piece): the words of each leaf that have several pieces, as labelled children.

    A leaf of several words is cut into words first, numbered from 0. The
    children are labelled with the tag above the leaf plus ``_bpe``.
    ``segmented`` holds (token, n, pieces) of distinct words.
    """
    from .vocab import skewed_lookup

    tags = merged.where(F.col("label").isNotNull()).select("doc", F.col("node_id").alias("parent"), F.col("label").alias("tag"))
    leaves = merged.where(F.col("value").isNotNull()).join(tags, ["doc", "parent"], "left")
    words = leaves.select("doc", "node_id", "tag", F.posexplode_outer(words_of(F.col("value"))).alias("word_no", "token"))
    split = skewed_lookup(words.where(F.col("token").isNotNull()),
                          segmented.where(F.size("pieces") > 1).select("token", "n", "pieces"), "token", "n")
    return split.select("doc", "node_id", "word_no", F.posexplode("pieces").alias("piece_no", "piece"),
                        F.concat("tag", F.lit("_bpe")).alias("label"))


def balanced_regions(tokens: DataFrame, opening: Column, closing: Column, separator: Column, base_depth: int = 0) -> DataFrame:
    """(doc, region, pos, token): runs made of a head and one balanced body.

    ``tokens`` has doc, pos, token. Depth is the running balance of opening and
    closing tokens. At ``base_depth`` a run ends with a separator or with the
    closing token of its body; runs without a body are dropped. One document
    can hold many regions.
    """
    order = W.partitionBy("doc").orderBy("pos")
    upto, before = order.rowsBetween(W.unboundedPreceding, 0), order.rowsBetween(W.unboundedPreceding, -1)
    delta = F.when(opening, 1).when(closing, -1).otherwise(0)
    deep = tokens.withColumn("_open", opening).withColumn("_sep", separator).withColumn("_close", closing).withColumn(
        "_depth", F.sum(delta).over(upto))
    ends = (F.col("_depth") == base_depth) & (F.col("_close") | F.col("_sep"))
    cut = deep.withColumn("_run", F.coalesce(F.sum(ends.cast("int")).over(before), F.lit(0)))
    body = F.max((F.col("_open") & (F.col("_depth") == base_depth + 1)).cast("int")).over(W.partitionBy("doc", "_run"))
    whole = F.max(ends.cast("int") * F.col("_close").cast("int")).over(W.partitionBy("doc", "_run"))
    return cut.withColumn("_body", body * whole).where(F.col("_body") == 1).select(
        "doc", F.col("_run").alias("region"), "pos", "token")
