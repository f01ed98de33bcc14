"""Steps of merge learning: merges that are proposed in another order, and where the guesses come from."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from tokenloom.operators import merges as M


def joined(symbols, pair):
    out, i = [], 0
    while i < len(symbols):
        if tuple(symbols[i:i + 2]) == pair:
            out.append(pair[0] + pair[1])
            i += 2
        else:
            out.append(symbols[i])
            i += 1
    return out


def pair_counts(words):
    return Counter(pair for word in words for pair in zip(word, word[1:]))


def changes_by_turn(words, merges):
    out = []
    for pair in merges:
        was, words = pair_counts(words), [joined(word, pair) for word in words]
        now = pair_counts(words)
        out.append({p: now[p] - was[p] for p in {*was, *now} if now[p] != was[p]})
    return out


@pytest.mark.parametrize("p, q", [(("a", "b"), ("c", "d")), (("a", "b"), ("a", "d")), (("a", "d"), ("b", "d")), (("a", "a"), ("c", "c")), (("a", "b"), ("c", "c"))])
def test_merges_that_commute_exchange_their_changes(p, q):
    draw = random.Random(f"{p}{q}")
    words = [draw.choices("abcd", k=draw.randint(2, 12)) for _ in range(400)]
    assert M._commute(p, q)
    of_p, of_q = changes_by_turn(words, [p, q])
    M._exchange(p, q, of_p, of_q)
    kept = lambda changes: {pair: n for pair, n in changes.items() if n}
    assert [kept(of_q), kept(of_p)] == changes_by_turn(words, [q, p])


@pytest.mark.parametrize("p, q", [(("a", "b"), ("b", "c")), (("b", "c"), ("a", "b")), (("a", "b"), ("ab", "c")), (("a", "b"), ("c", "ab")), (("a", "a"), ("a", "b"))])
def test_merges_that_meet_do_not_commute(p, q):
    assert not M._commute(p, q)


def test_a_step_goes_on_where_the_order_was_guessed_wrong(spark, monkeypatch):
    draw = random.Random(5)
    counts = {"".join(draw.choices("abcdefgh", k=draw.randint(1, 9))): draw.randint(1, 30) for _ in range(300)}
    frame = spark.createDataFrame(list(counts.items()), "token string, n long")
    want, words = [], {tuple(token) + (M.END_OF_WORD,): n for token, n in counts.items()}
    for _ in range(60):
        pairs = Counter()
        for word, n in words.items():
            for pair in zip(word, word[1:]):
                pairs[pair] += n
        want.append(min(pairs, key=lambda pair: (-pairs[pair], *pair)))
        words = {tuple(joined(word, want[-1])): n for word, n in words.items()}
    guess, steps = M._proposed, []

    def turned(*given):
        asked = guess(*given)
        for at in range(0, len(asked) - 2, 2):  # the last one's symbol may be known
            if M._commute(asked[at], asked[at + 1]):
                asked[at], asked[at + 1] = asked[at + 1], asked[at]
        steps.append(len(asked))
        return asked

    monkeypatch.setattr(M, "_proposed", turned)
    assert M.learn_merges(frame, 60) == want
    assert len(steps) < 40
