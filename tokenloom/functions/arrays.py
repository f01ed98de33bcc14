"""Sequences, id arrays and small matrices as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .tokens import bind

# Special ids of the two vocabulary layouts.
SUMMARY_IDS = {"<unk>": 0, "<blank>": 1, "<s>": 2, "</s>": 3}
CORPUS_IDS = {"<s>": 0, "</s>": 1, "<pad>": 2, "<unk>": 3}
CORPUS_IDS.update({f"<special{i}>": 4 + i for i in range(10)})


def range_from_zero(count: Column) -> Column:
    """0..count-1, empty for a count below one."""
    return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))


def with_bounds(tokens: Column, first: str = "<s>", last: str = "</s>") -> Column:
    return F.array_append(F.array_prepend(tokens, F.lit(first)), F.lit(last))


def pad(seq: Column, width: Column, value) -> Column:
    return F.concat(seq, F.array_repeat(F.lit(value), F.greatest(width - F.size(seq), F.lit(0)).cast("int")))


def parse_matrix(json: Column) -> Column:
    """JSON array of space-separated rows -> square matrix padded with ''."""

    def square(rows: Column) -> Column:
        return bind(
            F.greatest(F.size(rows), F.coalesce(F.array_max(F.transform(rows, F.size)), F.lit(0))),
            lambda n: F.transform(
                F.concat(rows, F.array_repeat(F.array().cast("array<string>"), n - F.size(rows))),
                lambda r: pad(r, n, ""),
            ),
        )

    rows = F.transform(F.from_json(json, "array<string>"), lambda r: F.split(r, " "))
    return bind(rows, square)


def source_map(tokens: Column) -> Column:
    """Each token's 0-based place in the row's own vocabulary (tokens by first appearance)."""
    return bind(
        tokens,
        lambda t: bind(
            F.array_distinct(t),
            lambda vocab: F.transform(t, lambda w: (F.array_position(vocab, w) - 1).cast("int")),
        ),
    )


def align(target: Column, source: Column, unknown: int) -> Column:
    """Each target token's place in the source vocabulary, else ``unknown``."""
    return bind(
        F.array_distinct(source),
        lambda vocab: F.transform(
            target, lambda w: F.coalesce(F.nullif(F.array_position(vocab, w), F.lit(0)) - 1, F.lit(unknown)).cast("int")
        ),
    )


def cut_at(ids: Column, stop: int) -> Column:
    """Items before the first ``stop``."""
    return bind(
        ids,
        lambda a: bind(
            F.array_position(a, stop).cast("int"),
            lambda at: F.when(at > 0, F.slice(a, 1, F.greatest(at - 1, F.lit(0)))).otherwise(a),
        ),
    )


def replace_unknown(prediction: Column, source: Column, weight, unknown: str = "<unk>") -> Column:
    """Unknown target tokens become the source token of largest weight.

    ``weight(target_index, source_token, source_index)`` is a column; the first
    of equal weights wins.
    """

    def best(i: Column, src: Column) -> Column:
        return bind(
            F.transform(src, lambda s, j: weight(i, s, j)),
            lambda row: F.get(src, (F.array_position(row, F.array_max(row)) - 1).cast("int")),
        )

    return bind(
        source,
        lambda src: F.transform(prediction, lambda t, i: F.when(t == unknown, best(i, src)).otherwise(t)),
    )


def strip_tail(ids: Column, drop: list[int]) -> Column:
    """Removes ids in ``drop`` from the end."""
    return bind(
        ids,
        lambda a: bind(
            F.coalesce(
                F.array_max(F.transform(a, lambda x, i: F.when(~x.isin(drop), i + 1).otherwise(0))), F.lit(0)
            ),
            lambda last: F.slice(a, 1, last),
        ),
    )


def relative_positions(length: Column, limit: int, signed: bool) -> Column:
    """length x length matrix of clipped distances (column minus row)."""

    def cell(i: Column, j: Column) -> Column:
        clipped = F.greatest(F.least(j - i, F.lit(limit)), F.lit(-limit))
        return clipped + limit if signed else F.abs(clipped)

    return F.transform(
        range_from_zero(length), lambda i: F.transform(range_from_zero(length), lambda j: cell(i, j))
    )


def relative_runs(length: Column, limit: int, signed: bool) -> Column:
    """The rows of ``relative_positions`` as runs (row, value, times), in order: at most 2 * limit + 1 a row.

    Left of the diagonal band and right of it a row has one value, so the array
    grows with the length, not with its square.
    """

    def run(i: Column, step: Column) -> Column:
        left = F.when(i >= limit, i - limit + 1)
        right = F.when(i + limit < length, length - i - limit)
        inside = F.when((i + step >= 0) & (i + step < length), 1)
        times = F.when(F.lit(limit == 0), length).when(step == -limit, left).when(step == limit, right).otherwise(inside)
        value = step + limit if signed else F.abs(step)
        return F.struct(i.alias("row"), value.alias("value"), F.coalesce(times, F.lit(0)).cast("int").alias("times"))

    rows = F.transform(range_from_zero(length), lambda i: F.filter(
        F.transform(F.sequence(F.lit(-limit), F.lit(limit)), lambda step: run(i, step)), lambda r: r["times"] > 0))
    return F.flatten(rows)


def length_mask(length: Column, width: Column) -> Column:
    return F.transform(range_from_zero(width), lambda i: i < length)


def square_mask(length: Column, width: Column) -> Column:
    return F.transform(
        range_from_zero(width),
        lambda i: F.transform(range_from_zero(width), lambda j: ((i < length) & (j < length)).cast("int")),
    )


def truncate_with_end(ids: Column, most: int, end) -> Column:
    return F.when(F.size(ids) > most, F.array_append(F.slice(ids, 1, most - 1), F.lit(end))).otherwise(ids)


def concat_pair(first: Column, second: Column, first_lang: int, second_lang: int,
                reset_positions: bool) -> tuple[Column, Column, Column]:
    """(tokens, positions, language ids) of two sequences put together.

    Without a position reset the shared end mark of the first sequence is overwritten.
    """
    left = F.size(first) if reset_positions else F.size(first) - 1
    tokens = F.concat(F.slice(first, 1, left), second)
    total = left + F.size(second)
    positions = F.transform(
        range_from_zero(total), lambda i: F.when((i >= left) & F.lit(reset_positions), i - left).otherwise(i)
    )
    langs = F.transform(range_from_zero(total), lambda i: F.when(i < left, first_lang).otherwise(second_lang))
    return tokens, positions, langs


def schedule_value(config: str, step: Column) -> Column:
    """Value at ``step`` of a schedule such as '0:0,1000:0,2000:1' (linear between points)."""
    points = [(int(k), float(v)) for k, v in (p.split(":") for p in config.split(","))]
    if any(a[0] >= b[0] for a, b in zip(points, points[1:])):
        raise ValueError("schedule steps must increase")
    chain = None
    for (xa, ya), (xb, yb) in zip(points, points[1:]):
        inside = (step >= xa) & (step < xb)
        value = F.lit(ya) + (step - xa) * F.lit((yb - ya) / (xb - xa))
        chain = F.when(inside, value) if chain is None else chain.when(inside, value)
    last = F.when(step >= points[-1][0], F.lit(points[-1][1]))
    return F.coalesce(chain, last) if chain is not None else last


def length_penalty(length: Column, alpha: float) -> Column:
    return F.pow((length + 5) / F.lit(6.0), F.lit(alpha))


def coverage_log_penalty(coverage: Column, beta: float) -> Column:
    total = F.aggregate(coverage, F.lit(0.0), lambda s, c: s + F.log(F.least(c, F.lit(1.0))))
    return -F.lit(beta) * total


def coverage_sum_penalty(coverage: Column, beta: float) -> Column:
    total = F.aggregate(coverage, F.lit(0.0), lambda s, c: s + F.greatest(c, F.lit(1.0)))
    return F.lit(beta) * (total - F.size(coverage))
