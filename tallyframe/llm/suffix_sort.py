"""Deep-shallow sorting of byte strings, with the lengths of their common prefixes.

Multikey quicksort splits the strings three ways on eight bytes at a time down
to a shallow depth; strings that still agree there go into a blind trie: a
string descends by the branching bytes alone, without looking at what lies
between them, is compared once with the leaf that it ends at, and is put in
where the two first differ.
"""

from __future__ import annotations

STEP = 8


def common_prefix(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


class _Trie:
    """Blind trie of strings that share ``depth`` bytes; a node is [branch position, {next byte: child}] or a list of equal strings."""

    def __init__(self, strings: list[bytes], first: int) -> None:
        self.strings = strings
        self.root: list = [None, [first]]                    # [None, members] is a leaf

    def _byte(self, k: int, at: int) -> int:
        s = self.strings[k]
        return s[at] if at < len(s) else -1                  # the end of a string comes before any byte

    def insert(self, k: int) -> None:
        node = self.root
        while node[0] is not None:                           # blind: any child will do when there's none for this byte
            node = node[1].get(self._byte(k, node[0])) or next(iter(node[1].values()))
        other = node[1][0]
        a, b = self.strings[k], self.strings[other]
        if a == b:
            node[1].append(k)
            return
        at = common_prefix(a, b)
        node = self.root
        while node[0] is not None and node[0] < at:
            node = node[1][self._byte(k, node[0])]
        if node[0] == at:
            node[1][self._byte(k, at)] = [None, [k]]
        else:
            node[0], node[1] = at, {self._byte(other, at): [node[0], node[1]], self._byte(k, at): [None, [k]]}

    def walk(self, out: list[int], lcp: list[int], before: int) -> None:
        """Strings in order; ``lcp`` gets the common prefix of each with the one before it (``before`` for the first)."""
        stack = [(self.root, before)]
        while stack:
            node, shared = stack.pop()
            if node[0] is None:
                for i, k in enumerate(node[1]):
                    out.append(k)
                    lcp.append(len(self.strings[k]) if i else shared)
            else:
                children = [node[1][c] for c in sorted(node[1])]
                stack.extend((child, node[0]) for child in reversed(children[1:]))
                stack.append((children[0], shared))


def deep_shallow_sort(strings: list[bytes], shallow: int = 64) -> tuple[list[int], list[int]]:
    """Order of the strings and, per place, the common prefix with the string before (0 for the first)."""
    out: list[int] = []
    stack = [(list(range(len(strings))), 0)]
    while stack:                                             # the left part lies on top
        part, depth = stack.pop()
        if len(part) == 1:
            out.append(part[0])
        elif depth >= shallow:
            trie = _Trie(strings, part[0])
            for k in part[1:]:
                trie.insert(k)
            trie.walk(out, [], 0)
        elif part:
            cut = depth + STEP
            pivot = strings[part[len(part) // 2]][depth:cut]
            less, same, more = [], [], []
            for k in part:
                key = strings[k][depth:cut]
                (same if key == pivot else less if key < pivot else more).append(k)
            stack.append((more, depth))
            if len(pivot) < STEP:                            # ended strings that agree are equal
                stack.append((same[:1], depth)) if len(same) == 1 else stack.append((same, shallow))
            else:
                stack.append((same, cut))
            stack.append((less, depth))
    lcp = [0, *[common_prefix(strings[a], strings[b]) for a, b in zip(out, out[1:], strict=False)]]
    return out, lcp
