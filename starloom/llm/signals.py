"""Countable signs of a text's quality, for whole columns at a time."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from starloom.llm import textops as t
from starloom.llm.linear import gram_hashes

#: What counts as a symbol.
SYMBOLS = b"#*$%&|<>"

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(SYMBOLS)] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_LOWER = np.zeros(256, dtype=bool)
_LOWER[97:123] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[list(b".,;:?!")] = True
_ALPHABETIC = (np.arange(256) >= 128) | _UPPER | _LOWER | ((np.arange(256) >= 48) & (np.arange(256) < 58))
_START = (np.arange(256) & 0xC0) != 0x80


@dataclass
class Signs:
    n_words: int = 0
    word_chars: int = 0
    n_symbols: int = 0
    n_dup_lines: int = 0
    n_repeat_words: int = 0
    n_distinct: int = 0
    top_word: int = 0
    n_lines: int = 0
    n_upper: int = 0
    n_lower: int = 0
    n_exclaims: int = 0
    n_stops: int = 0
    n_bare: int = 0


def repeated_words(words: np.ndarray, window: int = 3) -> int:
    """Words that lie in a window of words found twice or more, the first included."""
    grams = gram_hashes(words, window)
    if not len(grams):
        return 0
    _, number, count = np.unique(grams, return_inverse=True, return_counts=True)
    again = count[number] > 1
    covered = np.zeros(len(words), dtype=bool)
    for k in range(window):
        covered[k : k + len(again)] |= again
    return int(covered.sum())


def _lines(own: np.ndarray) -> tuple[int, int]:
    """Lines with a word, and how many of them equal an earlier one."""
    breaks = np.flatnonzero(own == 10)
    starts = np.concatenate(([0], breaks + 1))
    ends = np.concatenate((breaks, [len(own)]))
    solid = np.concatenate(([0], np.cumsum(~t.SPACE[own])))
    worded = solid[ends] > solid[starts]
    hashes = t.span_hash(t.prefix_hash(own), starts[worded], ends[worded])
    return len(hashes), len(hashes) - len(np.unique(hashes))


def _words(own: np.ndarray) -> tuple[int, int]:
    """Words that end in a punctuation mark, and words without letter or digit."""
    starts, ends = t.word_spans(own, np.array([0, len(own)]))
    letters = np.concatenate(([0], np.cumsum(_ALPHABETIC[own])))
    return int(_STOP[own[ends - 1]].sum()), int((letters[ends] == letters[starts]).sum())


def signs(column: pa.Array) -> Iterator[Signs]:
    data, offsets = t.utf8(column)
    hashes, counts = t.word_hashes(data, offsets)
    ends = np.cumsum(counts)
    for k, (end, n) in enumerate(zip(ends.tolist(), counts.tolist())):
        own = data[offsets[k] : offsets[k + 1]]
        if not len(own):
            yield Signs()
            continue
        words = hashes[end - n : end]
        sizes = np.unique(words, return_counts=True)[1]
        n_lines, n_dup = _lines(own)
        kinds = np.bincount(own, minlength=256)
        n_stops, n_bare = _words(own)
        yield Signs(
            n_words=n,
            word_chars=int(kinds[_START & ~t.SPACE].sum()),
            n_symbols=int(kinds[_SYMBOL].sum()),
            n_dup_lines=n_dup,
            n_repeat_words=repeated_words(words),
            n_distinct=len(sizes),
            top_word=int(sizes.max()) if n else 0,
            n_lines=n_lines,
            n_upper=int(kinds[_UPPER].sum()),
            n_lower=int(kinds[_LOWER].sum()),
            n_exclaims=int(kinds[33]),
            n_stops=n_stops,
            n_bare=n_bare,
        )
