"""Languages of large alphabets and of many scripts."""

from __future__ import annotations

import random

import numpy as np

from tokenloom.llm import language
from tokenloom.llm.language import Automaton, Languages, suffix_automaton


def test_letters_beyond_the_first_250():
    draw = random.Random(3)
    scripts = {"en": "abcdefghijklmnop", "ja": [chr(0x3041 + i) for i in range(80)], "ko": [chr(0xAC00 + 7 * i) for i in range(900)],
               "zh": [chr(0x4E00 + 3 * i) for i in range(2000)]}
    words = {name: ["".join(draw.choices(letters, k=3)) for _ in range(900)] for name, letters in scripts.items()}
    model = Languages({name: " ".join(own) for name, own in words.items()})
    assert model.names == sorted(scripts) and model.pad > 2000
    for name, own in words.items():
        found, scores = model.best([" ".join(draw.choices(own, k=20)) for _ in range(20)])
        assert set(found) == {name} and min(scores) > 0.5


def test_two_levels_equal_the_table():
    draw = np.random.default_rng(5)
    for size in (3, language.WIDE - 1, language.WIDE, language.WIDE + 1, 700):
        sequence = draw.integers(0, size, 600)
        table, levels = suffix_automaton(sequence, size + 1), Automaton(sequence, size + 1)
        states, symbols = (x.ravel() for x in np.meshgrid(np.arange(len(table)), np.arange(size + 1)))
        assert (levels.step(states, levels.number[symbols]) == table[states, symbols]).all()
