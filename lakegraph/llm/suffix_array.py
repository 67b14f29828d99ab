"""Suffix array by linear grouping.

Phase 1 sorts suffixes into groups of equal Lyndon prefix: groups are processed
in descending order, every suffix of a group finds the nearest earlier suffix
in a lower group (its previous-smaller pointer), and the suffixes pointed at
move to new groups above their old ones, those pointed at most often highest.
Phase 2 goes through the array upwards and puts the predecessors along the
pointers at the front of their groups. No substring is renamed or sorted again.
"""

from __future__ import annotations

from collections import defaultdict


def suffix_array(text: list[int]) -> list[int]:
    """Suffix array of integers whose last one is the only smallest."""
    n = len(text)
    if n == 0:
        return []
    order = sorted(range(n), key=text.__getitem__)      # by first symbol
    place, start, size = [0] * n, [0] * n, [0] * n
    head = 0
    for i, suffix in enumerate(order):
        if i and text[suffix] != text[order[i - 1]]:
            head = i
        place[suffix], start[suffix] = i, head
        size[head] += 1
    before = [-1] * n
    end = n
    while end > 0:
        low = start[order[end - 1]]
        if end - low == 1:
            members = (order[low],)
        else:
            members = sorted(order[low:end])
        times: dict[int, int] = {}
        for suffix in members:
            j = suffix - 1
            while j >= 0 and start[j] >= low:
                j = before[j]
            before[suffix] = j
            if j >= 0:
                times[j] = times.get(j, 0) + 1
        end = low
        if len(times) == 1 or (times and max(times.values()) == 1):
            batches = (times,)
        else:
            by_times = defaultdict(list)
            for j, t in times.items():
                by_times[t].append(j)
            batches = tuple(by_times[t] for t in sorted(by_times, reverse=True))
        for batch in batches:
            moved: dict[int, int] = {}
            for j in batch:                              # to the upper end of the group
                g = start[j]
                m = moved.get(g, 0) + 1
                moved[g] = m
                at, to = place[j], g + size[g] - m
                other = order[to]
                order[at], order[to] = other, j
                place[other], place[j] = at, to
            for j in batch:
                g = start[j]
                m = moved[g]
                if m < size[g]:
                    start[j] = g + size[g] - m
            for g, m in moved.items():
                if m < size[g]:
                    size[g] -= m
                    size[g + size[g]] = m
    # phase 2
    out, free = [-1] * n, list(range(n))
    placed = bytearray(n)
    out[0] = n - 1
    placed[n - 1] = 1
    for i in range(n):
        j = out[i] - 1
        while j >= 0 and not placed[j]:
            g = start[j]
            out[free[g]] = j
            free[g] += 1
            placed[j] = 1
            j = before[j]
    return out


def common_prefixes(text: list[int], array: list[int], stop: int) -> list[int]:
    """Symbols that each suffix shares with the one before it in the array,
    up to the next symbol that is not above ``stop``."""
    n = len(text)
    rank = [0] * n
    for r, s in enumerate(array):
        rank[s] = r
    out, k = [0] * n, 0
    for s in range(n):
        r = rank[s]
        if r == 0 or text[s] <= stop:
            k = 0
            continue
        t = array[r - 1]
        while text[s + k] == text[t + k] and text[s + k] > stop:
            k += 1
        out[r] = k
        if k:
            k -= 1
    return out


def longest_with_smaller(array: list[int], common: list[int], owner: list[int]) -> list[int]:
    """For each suffix (by text place): the longest prefix it shares with a
    suffix of a smaller owner. The nearest smaller owner above or below in the
    array shares the most, so one stack pass each way finds it."""
    n = len(array)
    best = [0] * n
    stack: list[tuple[int, int]] = []
    for r in range(n):
        s, k = array[r], common[r]
        d = owner[s]
        while stack and stack[-1][0] >= d:
            k = min(k, stack.pop()[1])
        best[s] = k if stack else 0
        stack.append((d, k))
    stack, k_next = [], 0
    for r in range(n - 1, -1, -1):
        s, k = array[r], k_next
        d = owner[s]
        while stack and stack[-1][0] >= d:
            k = min(k, stack.pop()[1])
        if stack and k > best[s]:
            best[s] = k
        stack.append((d, k))
        k_next = common[r]
    return best
