"""Recompression of word sequences: names of runs and pairs, level by level.

A round first names every maximal run of an equal symbol, then every pair of a left and a
right symbol, where a bit of a symbol's own name says which it is. Names are hashes of what
they stand for. So they are global: equal runs and pairs have equal names in every
task, without a shared dictionary, and equal substrings are parsed alike except at their
ends, where a symbol could join one outside.
"""

from __future__ import annotations

import numpy as np

from clickloom.llm.tokens import mix, range_hash

_RUN = np.uint64(0x8CB92BA72F3D8DD7)
_PAIR = np.uint64(0xD1B54A32D192ED03)
#: Pair rounds between run rounds; a run round takes a symbol off both ends of a window.
_PAIR_ROUNDS = 4


def _is_left(symbols: np.ndarray, level: int) -> np.ndarray:
    return (mix(symbols + np.uint64(level)) >> np.uint64(63)).astype(bool)


Level = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def name_runs(symbols: np.ndarray, opens: np.ndarray) -> Level:
    """(symbols, opens, parent, first child) after naming runs; ``opens``: a text's first."""
    starts = np.ones(len(symbols), dtype=bool)
    starts[1:] = (symbols[1:] != symbols[:-1]) | opens[1:]
    at = np.flatnonzero(starts)
    length = np.diff(np.append(at, len(symbols)))
    named = symbols[at]
    run = np.flatnonzero(length > 1)
    named[run] = mix(named[run] * _RUN + length[run].astype(np.uint64))
    return named, opens[at], np.cumsum(starts) - 1, at


def name_pairs(
    symbols: np.ndarray, opens: np.ndarray, left: np.ndarray
) -> Level:
    """(symbols, opens, parent, first child) after naming pairs of a left and a right symbol."""
    joined = np.zeros(len(symbols), dtype=bool)  # to the symbol before
    joined[1:] = left[:-1] & ~left[1:] & ~opens[1:]
    at = np.flatnonzero(~joined)
    named = symbols[at]
    pair = np.flatnonzero(np.append(joined[1:], False)[at])
    named[pair] = mix(mix(named[pair] * _PAIR) + symbols[at[pair] + 1])
    return named, opens[at], np.cumsum(~joined) - 1, at


def window_symbols(
    hashes: np.ndarray, opens: np.ndarray, starts: np.ndarray, k: int, least: int = 2
) -> tuple[np.ndarray, np.ndarray]:
    """For each window of k words, a name of its highest-level interior symbols, and where.

    The interior of a window at a level are the symbols that depend on its own words
    alone: an end symbol that might join one outside is left out, whether it does or not.
    So equal windows have equal interiors, wherever they stand. The name is that of the
    interior at the highest level where it still has ``least`` symbols; a window without
    such a level, as one word repeated, is named by all its words. The second array has
    the word at which the interior begins: windows with an equal name and place look at
    the same symbols of the text.
    """
    symbols, level = hashes, 0
    low, high = starts, starts + k
    names, places = np.empty(len(starts), dtype=np.uint64), starts.copy()
    first_word = np.arange(len(hashes))
    alive = np.arange(len(starts))
    while len(alive):
        # The level above, to name here those windows alone that do not reach it.
        if level % (_PAIR_ROUNDS + 1) == 0:
            above, above_opens, parent, at = name_runs(symbols, opens)
            above_low, above_high = parent[low] + 1, parent[high - 1]
            stays = above_high - above_low >= least
        else:
            left = _is_left(symbols, level)
            above_low, above_high = low + ~left[low], high - left[high - 1]
            stays = above_low < above_high
            above, above_opens, parent, at = name_pairs(symbols, opens, left)
            # What is empty may stand behind the last symbol.
            above_low = np.append(parent, 0)[above_low]
            above_high = parent[above_high - 1] + 1
            stays &= above_high - above_low >= least
        ends = np.flatnonzero(~stays)
        if len(ends):
            name = range_hash(symbols, low[ends], high[ends])
            names[alive[ends]] = mix(name + np.uint64(level)) if level else name
            places[alive[ends]] = first_word[low[ends]]
        on = np.flatnonzero(stays)
        alive, low, high = alive[on], above_low[on], above_high[on]
        symbols, opens, first_word = above, above_opens, first_word[at]
        level += 1
    return names, places
