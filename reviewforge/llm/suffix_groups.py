"""Linear suffix sorting by grouping (no recursion, no renaming)."""

from __future__ import annotations

from itertools import groupby


def suffix_array(text: list[int]) -> list[int]:
    """Suffix array of ``text``, whose last symbol must be smaller than all others and occur once.

    Suffixes start in groups by first symbol. Groups are processed from the
    highest down; each suffix of a group gets its pointer to the previous
    suffix of a smaller group, and the suffixes pointed at leave their own
    groups for new, higher ones, the more pointers the higher. In the end two
    suffixes share a group exactly if they have the same longest Lyndon
    prefix. A single pass from the smallest suffix up then follows the
    pointers and emits every group in order.
    """
    n = len(text)
    order = sorted(range(n), key=text.__getitem__)  # members of each group are contiguous
    place = [0] * n
    group = [0] * n  # first place of a suffix's group
    size = [0] * n
    first = 0
    for k, i in enumerate(order):
        if text[i] != text[order[first]]:
            first = k
        place[i], group[i] = k, first
        size[first] += 1
    before = [-1] * n
    top = n
    while top > 0:
        low = group[order[top - 1]]
        pointed: dict[int, int] = {}
        for i in sorted(order[low:top]):
            p = i - 1
            while p >= 0 and group[p] >= low:
                p = before[p]
            before[i] = p
            if p >= 0:
                pointed[p] = pointed.get(p, 0) + 1
        top = low
        if not pointed:
            continue
        by_count = sorted(pointed, key=lambda p: (-pointed[p], group[p]))
        # Grouped before any of them moves: suffixes of one count and one group move together.
        for (_, home), moving in [(key, list(ps)) for key, ps in groupby(by_count, key=lambda p: (pointed[p], group[p]))]:
            rest = size[home] - len(moving)
            if not rest:
                continue
            new = home + rest
            at = home + size[home]
            for p in moving:  # swap to the end of the group
                at -= 1
                other, hole = order[at], place[p]
                order[hole], place[other] = other, hole
                order[at], place[p] = p, at
            for p in moving:
                group[p] = new
            size[home], size[new] = rest, len(moving)
    out = [-1] * n
    following = list(range(n))  # next free place of each group
    done = [False] * n
    out[0] = n - 1
    done[n - 1] = True
    for k in range(n):
        p = out[k] - 1
        while p >= 0 and not done[p]:
            at = following[group[p]]
            out[at] = p
            following[group[p]] = at + 1
            done[p] = True
            p = before[p]
    return out
