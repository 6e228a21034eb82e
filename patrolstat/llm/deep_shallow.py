"""Deep-shallow sorting of byte strings, with longest common prefixes.

Strings are ordered by multikey quicksort (three-way splits on the byte at the
current depth) down to a shallow depth; groups that still agree there are
ordered by a blind trie, which looks at one byte per branch and compares a
string with a single leaf.
"""

from __future__ import annotations

SHALLOW = 8


def common_prefix(a: bytes, b: bytes, at: int = 0) -> int:
    """Length of the longest common prefix; the first ``at`` bytes are known to agree."""
    n = min(len(a), len(b))
    if a[at:n] == b[at:n]:
        return n
    step = 32
    while a[at:at + step] == b[at:at + step]:
        at += step
    while a[at] == b[at]:
        at += 1
    return at


class _Branch:
    __slots__ = ("depth", "next")

    def __init__(self, depth: int):
        self.depth = depth
        self.next: dict[int, _Branch | list[int]] = {}


def _byte(s: bytes, depth: int) -> int:
    return s[depth] if depth < len(s) else -1


def blind_trie(strings: list[bytes], group: list[int], depth: int) -> list[tuple[int, int]]:
    """``group`` (which agrees up to ``depth``) in order, each with its common prefix with the one before."""
    root: _Branch | list[int] = [group[0]]
    for x in group[1:]:
        s = strings[x]
        node = root
        while isinstance(node, _Branch):  # blindly to some leaf
            node = node.next.get(_byte(s, node.depth)) or next(iter(node.next.values()))
        other = strings[node[0]]
        lcp = common_prefix(s, other, depth)
        if lcp == len(s) == len(other):
            node.append(x)
            continue
        above, edge, node = None, 0, root
        while isinstance(node, _Branch) and node.depth < lcp:
            above, edge = node, _byte(s, node.depth)
            node = node.next[edge]
        if isinstance(node, _Branch) and node.depth == lcp:
            node.next[_byte(s, lcp)] = [x]
            continue
        split = _Branch(lcp)
        split.next[_byte(other, lcp)] = node
        split.next[_byte(s, lcp)] = [x]
        if above is None:
            root = split
        else:
            above.next[edge] = split
    out: list[tuple[int, int]] = []
    stack: list[tuple[_Branch | list[int], int]] = [(root, depth)]
    while stack:
        node, lcp = stack.pop()
        if isinstance(node, _Branch):
            edges = sorted(node.next, reverse=True)
            stack += [(node.next[e], node.depth) for e in edges[:-1]]
            stack.append((node.next[edges[-1]], lcp))
        else:
            out.append((node[0], lcp))
            out += [(x, len(strings[x])) for x in node[1:]]
    return out


def deep_shallow_sort(strings: list[bytes], shallow: int = SHALLOW, start: int = 0,
                      group: list[int] | None = None) -> tuple[list[int], list[int]]:
    """Order of the strings (all agree in their first ``start`` bytes) and each one's common prefix
    with the one before it in that order (the first one's is -1)."""
    order: list[int] = []
    lcps: list[int] = []
    stack: list[tuple[list[int], int, int]] = [(list(range(len(strings))) if group is None else group, start, -1)]
    while stack:
        group, depth, before = stack.pop()
        if not group:
            continue
        if len(group) == 1 or depth >= start + shallow:
            found = blind_trie(strings, group, depth) if len(group) > 1 else [(group[0], depth)]
            order += [x for x, _ in found]
            lcps += [before, *(l for _, l in found[1:])]
            continue
        keys = [_byte(strings[x], depth) for x in group]
        pivot = sorted((keys[0], keys[len(keys) // 2], keys[-1]))[1]
        less = [x for x, k in zip(group, keys) if k < pivot]
        same = [x for x, k in zip(group, keys) if k == pivot]
        more = [x for x, k in zip(group, keys) if k > pivot]
        # what comes first takes over the prefix with whatever stands before the group
        parts = [p for p in ((less, depth), (same, depth + 1 if pivot >= 0 else depth), (more, depth)) if p[0]]
        for i in range(len(parts) - 1, -1, -1):
            members, at = parts[i]
            if pivot < 0 and members is same:
                # strings that end here are equal
                stack.append((members, start + shallow, before if i == 0 else depth))
            else:
                stack.append((members, at, before if i == 0 else depth))
    return order, lcps
