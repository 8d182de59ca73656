"""The word table: small ones start anew, and never fill up."""

from __future__ import annotations

import numpy as np

from fieldmosaic.llm.word_ids import WordIds, code_points


def looked_up(table: WordIds, words: list[str]) -> list[list[int]]:
    bounds = np.cumsum([0, *map(len, words)])
    text = "".join(words)
    ids, upto = table.ids(text, code_points(text), bounds[:-1], bounds[1:])
    return [ids[a:b].tolist() for a, b in zip(upto, upto[1:])]


def test_small_word_table():
    rng = np.random.default_rng(2)
    table = WordIds(lambda words: [[ord(c) for c in w] for w in words], slots=64)
    for size in (10, 20, 40, 500, 3, 60):  # 500 words are more than the table has slots
        words = ["".join(map(chr, rng.integers(97, 123, n))) for n in rng.integers(1, 90, size)]
        assert looked_up(table, words) == [[ord(c) for c in w] for w in words]
        assert table.size <= table.slots // 4 * 3
