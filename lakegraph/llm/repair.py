"""Re-Pair grammars of many sequences at once, with whole-array operations.

Re-Pair replaces the most frequent pair of neighbouring symbols by a new
nonterminal until no pair occurs twice. Here a round replaces every occurrence
that is more frequent than the pairs it overlaps (equal counts by a hash), in all
sequences together: where no more frequent pair competes, the order of
replacements makes no difference. A pair that occurs once never occurs twice
again, so its place is closed; symbols between closed places are final and leave
the working arrays, and later rounds cost only what is still repeated.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from lakegraph.llm import words


@dataclass
class Grammar:
    """Nonterminal k covers ``size[k]`` terminals, its left part ``left[k]`` of
    them. ``of`` and ``at`` list all derivation positions: nonterminal and first
    terminal, ordered by nonterminal. ``starts`` are the first terminals of the
    start rule's symbols."""
    left: np.ndarray
    size: np.ndarray
    of: np.ndarray
    at: np.ndarray
    starts: np.ndarray


def _even(s: np.ndarray, i: np.ndarray) -> np.ndarray:
    """Whether each pair is free of the one before it: of a stretch of equal
    symbols only every other pair can be replaced."""
    same = s[i] == s[i + 1]
    chained = np.zeros(len(i), dtype=bool)
    chained[1:] = same[1:] & same[:-1] & (i[1:] == i[:-1] + 1)
    place = np.arange(len(i))
    head = np.maximum.accumulate(np.where(chained, 0, place))
    return (place - head) % 2 == 0


def grammar(ids: np.ndarray) -> Grammar:
    """Grammar of terminals numbered from 0. Sequences stand one behind the other
    and share no terminal, so that no pair across two of them repeats."""
    n = len(ids)
    s, at, size = ids.astype(np.int64), np.arange(n), np.ones(n, dtype=np.int64)
    open_ = np.ones(n, dtype=bool)                      # whether the pair with the next symbol may repeat
    open_[-1:] = False
    starts = np.ones(n, dtype=bool)
    symbols = int(ids.max(initial=-1)) + 1
    terminals, turn = symbols, 0
    lefts, sizes, ofs, ats = [], [], [], []
    while True:
        i = np.flatnonzero(open_)
        if not len(i):
            break
        key = s[i] * symbols + s[i + 1]
        free = _even(s, i)
        pairs, of, many = np.unique(key[free], return_inverse=True, return_counts=True)
        again = many >= 2
        closed = np.ones(len(i), dtype=bool)
        closed[free] = ~again[of]
        if not free.all():                              # the others of a stretch share its fate
            k = np.searchsorted(pairs, key[~free])
            found = (k < len(pairs)) & (pairs[np.minimum(k, len(pairs) - 1)] == key[~free])
            closed[~free] = ~(found & again[np.minimum(k, len(pairs) - 1)])
        open_[i[closed]] = False
        rank = np.empty(len(pairs), dtype=np.int64)
        rank[np.lexsort((words.mix(pairs.astype(words.U64) + words.U64(turn)), many))] = np.arange(len(pairs))
        strength = np.full(len(s) + 1, -1, dtype=np.int64)
        live = i[free][again[of]]
        strength[live] = rank[of[again[of]]]
        before = np.concatenate([[-1], strength[:-2]]) if len(s) else strength[:0]
        best = live[(strength[live] > before[live]) & (strength[live] > strength[live + 1])]
        if len(best):
            chosen, number, times = np.unique(strength[best], return_inverse=True, return_counts=True)
            keep = times[number] >= 2                   # a rule is used twice at least
            best, number = best[keep], number[keep]
            number = np.unique(number, return_inverse=True)[1]
        if len(best):
            first = np.zeros(int(number.max()) + 1, dtype=np.int64)
            first[number[::-1]] = best[::-1]
            lefts.append(size[first])
            sizes.append(size[first] + size[first + 1])
            ofs.append(number + symbols - terminals)
            ats.append(at[best])
            starts[at[best + 1]] = False
            s[best] = number + symbols
            size[best] += size[best + 1]
            open_[best] = open_[best + 1]
            symbols += len(first)
        stay = open_.copy()
        stay[1:] |= open_[:-1]
        stay[best + 1] = False
        s, at, size, open_ = s[stay], at[stay], size[stay], open_[stay]
        turn += 1
    none = np.zeros(0, dtype=np.int64)
    left, whole, of, where = (np.concatenate(x) if x else none for x in (lefts, sizes, ofs, ats))
    order = np.lexsort((where, of))
    return Grammar(left, whole, of[order], where[order], np.flatnonzero(starts))
