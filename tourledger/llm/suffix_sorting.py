"""Suffix sorting by linear grouping on Lyndon prefixes, without recursion or renaming."""

from __future__ import annotations


def suffix_order(text: list[int]) -> list[int]:
    """The suffixes of ``text`` in ascending order.

    Symbol 0 separates strings: the text must begin and end with one, suffixes are compared up
    to the next one, and equal ones come in any order. Symbols are ranks: time and memory are linear
    in the text and in the greatest of them, as nothing is sorted by comparison. Suffixes begin
    in text order inside a group and stay so, since the nearest smaller place before a later
    suffix is not before that of an earlier one.

    First, suffixes are gathered in groups by their longest Lyndon prefix. They begin in
    groups by first symbol. From the greatest group down, each suffix finds the nearest place
    before it whose group is smaller; that place's prefix grows by the group's, as often as
    the group's suffixes point to it, and with it moves into a new group right above its old
    one. Then the groups are filled from the left: what follows a suffix's Lyndon prefix is a
    smaller suffix, so once that one has its rank, all that it follows take the next free
    ranks of their groups, found by going back from it along the same pointers.
    """
    n = len(text)
    place = [-1] * (max(text) + 1)
    for symbol in text:
        place[symbol] = 0
    symbols = [symbol for symbol, there in enumerate(place) if not there]
    for k, symbol in enumerate(symbols):
        place[symbol] = k
    group = [place[symbol] for symbol in text]
    members: list[list[int]] = [[] for _ in symbols]
    for i, g in enumerate(group):
        members[g].append(i)
    size = [len(own) for own in members]
    below = [g - 1 for g in range(len(symbols))]
    above = [*range(1, len(symbols)), -1]
    smaller = [-1] * n
    done = bytearray(n)
    current = len(symbols) - 1

    def split(old: int, grown: list[int]) -> None:
        """Move some of a group's suffixes to a new group right above it."""
        fresh, upper = len(size), above[old]
        for j in grown:
            group[j] = fresh
        members.append(grown)
        size.append(len(grown))
        size[old] -= len(grown)
        above.append(upper)
        below.append(old)
        above[old] = fresh
        if upper >= 0:
            below[upper] = fresh

    while current > 0:
        own = members[current]
        if size[current] == 1:  # as most are: at most one suffix grows
            if len(own) > 1:
                own = members[current] = [i for i in own if group[i] == current]
            i = own[0]
            done[i] = 1
            j = i - 1
            while done[j]:
                j = smaller[j]
            smaller[i] = j
            if text[j] and size[group[j]] > 1:
                split(group[j], [j])
            current = below[current]
            continue
        if size[current] != len(own):
            own = members[current] = [i for i in own if group[i] == current]
        for i in own:
            done[i] = 1
        pointed: dict[int, int] = {}
        for i in own:
            j = i - 1
            while done[j]:
                j = smaller[j]
            smaller[i] = j
            if text[j]:
                pointed[j] = pointed.get(j, 0) + 1
        moved: list[dict[int, list[int]]] = [{} for _ in range(max(pointed.values(), default=0) + 1)]
        for j, times in pointed.items():
            moved[times].setdefault(group[j], []).append(j)
        # The most often extended go first and are pushed up by the others; a group that
        # grows as a whole stays where it is.
        for grown in reversed(moved):
            for old, some in grown.items():
                if len(some) < size[old]:
                    split(old, some)
        current = below[current]

    ranks = [0] * len(size)
    at = current = 0
    while current >= 0:
        ranks[current] = at
        at += size[current]
        current = above[current]
    found = [0] * n
    placed = bytearray(n)
    for k, i in enumerate(members[0]):
        found[k] = i
        placed[i] = 1
    for k in range(n):
        j = found[k] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            found[ranks[g]] = j
            ranks[g] += 1
            placed[j] = 1
            j = smaller[j]
    return found
