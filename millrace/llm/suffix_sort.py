"""Deep-shallow sorting of byte strings.

Strings are sorted by multikey quicksort over eight-byte characters down to a shallow depth: a group is
split around the character of its middle string into less, equal and greater, and the equal part goes on to
the next character. All open groups take a step at once, whatever their depths, by one stable sort
over group and side. Groups that still share their prefix at the shallow depth are
ordered by blind tries: a trie that keeps only the branching positions, is descended
without looking at the skipped bytes, and corrected by one comparison with the leaf.
"""

from __future__ import annotations

import numpy as np

CHARACTER = 8
END = -1  # branches of strings that end; before all bytes


class BlindTrie:
    """Distinct strings; an inner node is [depth, {byte: child}, one of its strings]."""

    def __init__(self, first: bytes):
        self.root: list | bytes = first

    def add(self, x: bytes) -> None:
        node = self.root
        while type(node) is list:
            depth = node[0]
            child = node[1].get(x[depth] if depth < len(x) else END)
            node = node[2] if child is None else child
        depth = _common(x, node)
        parent, node, key = None, self.root, END
        while type(node) is list and node[0] < depth:
            parent, key = node, x[node[0]] if node[0] < len(x) else END
            node = node[1][key]
        mine = x[depth] if depth < len(x) else END
        if type(node) is list and node[0] == depth:
            node[1][mine] = x
            return
        other = node[2] if type(node) is list else node
        fork = [depth, {mine: x, other[depth] if depth < len(other) else END: node}, x]
        if parent is None:
            self.root = fork
        else:
            parent[1][key] = fork

    def ordered(self) -> list[bytes]:
        out, stack = [], [self.root]
        while stack:
            node = stack.pop()
            if type(node) is list:
                stack += [node[1][k] for k in sorted(node[1], reverse=True)]
            else:
                out.append(node)
        return out


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


def deep_shallow_order(strings: list[bytes], groups: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the strings by (group, string), and the common prefix of each with the one before it.

    The prefix is 0 where the group changes. ``depth`` is where multikey quicksort hands over to the tries.
    """
    n = len(strings)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    lens = np.array([len(s) for s in strings], np.int64)
    width = -(-(int(lens.max()) + 1) // CHARACTER) * CHARACTER
    padded = np.zeros((n, width), np.uint8)
    padded.ravel()[np.arange(int(lens.sum())) + np.repeat(np.arange(n) * width - (np.cumsum(lens) - lens), lens)] = np.frombuffer(
        b"".join(strings), np.uint8
    )
    characters = padded.view(">u8").astype(np.uint64)
    order = np.argsort(groups, kind="stable")
    part = np.cumsum(np.diff(groups[order], prepend=groups[order[0]]) != 0)  # the group of each place
    level = np.zeros(n, np.int64)  # of each place's group: its strings share the characters before
    limit = min(-(-depth // CHARACTER), width // CHARACTER)
    while len(live := np.flatnonzero((np.bincount(part)[part] > 1) & (level < limit))):
        mine = order[live]
        character = characters[mine, level[live]]
        starts = np.flatnonzero(np.diff(part[live], prepend=-1))
        counts = np.diff(np.append(starts, len(live)))
        pivot = np.repeat(character[starts + counts // 2], counts)
        side = (character >= pivot).astype(np.int64) + (character > pivot)  # less, equal, greater
        key = np.repeat(np.arange(len(starts)), counts) * 3 + side
        by = np.argsort(key, kind="stable")
        order[live] = mine[by]
        level[live] += side[by] == 1  # only what equals the pivot goes on to the next character
        fresh = np.diff(part, prepend=part[0]) != 0
        fresh[live[1:]] |= (np.diff(key[by]) != 0) & (np.diff(live) == 1)
        part = np.cumsum(fresh)
    sizes = np.bincount(part)
    starts = np.cumsum(sizes) - sizes
    for start, size in zip(starts[sizes > 1].tolist(), sizes[sizes > 1].tolist(), strict=True):
        places: dict[bytes, list[int]] = {}
        for i in order[start : start + size].tolist():
            places.setdefault(strings[i], []).append(i)
        if len(places) > 1:
            first, *rest = places
            trie = BlindTrie(first)
            for s in rest:
                trie.add(s)
            order[start : start + size] = [i for s in trie.ordered() for i in places[s]]
    same = padded[order[1:]] == padded[order[:-1]]
    first_miss = np.where(same.all(axis=1), width, same.argmin(axis=1))
    prefix = np.minimum(first_miss, np.minimum(lens[order[1:]], lens[order[:-1]]))
    prefix[groups[order[1:]] != groups[order[:-1]]] = 0
    return order, np.concatenate([[0], prefix])
