"""Edit sequences as linked nodes that share their prefixes.

A node is one edit behind another node. Every node knows its depth, a rolling hash of the
whole sequence and ancestors at powers of two, so two sequences are compared by a search
for their longest common prefix in logarithmic time. Equal sequences are one node, since
children are kept per parent and letter; a hash that claims equality is checked against that.
"""

from __future__ import annotations

from functools import cmp_to_key

_MODULUS = (1 << 61) - 1
_BASE = 0x1F3D5B79A7C3E581 % _MODULUS
ROOT = 0


class EditTrie:
    def __init__(self, modulus: int = _MODULUS):
        self._modulus = modulus
        self._letter = [""]
        self._depth = [0]
        self._hash = [0]
        # Ancestors 1, 2, 4, ... above.
        self._up: list[list[int]] = [[]]
        self._child: dict[tuple[int, str], int] = {}

    def extend(self, node: int, letters: str) -> int:
        for letter in letters:
            key = (node, letter)
            known = self._child.get(key)
            if known is None:
                known = len(self._letter)
                self._child[key] = known
                self._letter.append(letter)
                self._depth.append(self._depth[node] + 1)
                self._hash.append((self._hash[node] * _BASE + ord(letter)) % self._modulus)
                up, above, k = [node], node, 0
                while k < len(self._up[above]):
                    above = self._up[above][k]
                    up.append(above)
                    k += 1
                self._up.append(up)
            node = known
        return node

    def text(self, node: int) -> str:
        letters = []
        while node != ROOT:
            letters.append(self._letter[node])
            node = self._up[node][0]
        return "".join(reversed(letters))

    def _ancestor(self, node: int, depth: int) -> int:
        over = self._depth[node] - depth
        while over:
            k = over.bit_length() - 1
            node = self._up[node][k]
            over -= 1 << k
        return node

    def _same(self, a: int, b: int, exact: bool) -> bool:
        return a == b if exact else self._hash[a] == self._hash[b]

    def _split(self, a: int, b: int, exact: bool) -> tuple[int, int]:
        """The first nodes that differ, below the longest common prefix of equally deep nodes."""
        for k in range(len(self._up[a]) - 1, -1, -1):
            if k < len(self._up[a]):
                x, y = self._up[a][k], self._up[b][k]
                if not self._same(x, y, exact):
                    a, b = x, y
        return a, b

    def compare(self, a: int, b: int) -> int:
        """-1, 0 or 1, as the sequences compare as texts."""
        if a == b:
            return 0
        depth = min(self._depth[a], self._depth[b])
        x, y = self._ancestor(a, depth), self._ancestor(b, depth)
        if x == y:
            return -1 if self._depth[a] < self._depth[b] else 1
        # Different nodes are different sequences: a hash that says otherwise collides.
        exact = self._hash[x] == self._hash[y]
        if not exact:
            p, q = self._split(x, y, False)
            exact = self._up[p][0] != self._up[q][0]
        if exact:
            p, q = self._split(x, y, True)
        return -1 if self._letter[p] < self._letter[q] else 1

    def ranks(self, nodes: list[int]) -> list[int]:
        """Position of each node among the given ones, which must be distinct."""
        ordered = sorted(range(len(nodes)), key=cmp_to_key(lambda i, j: self.compare(nodes[i], nodes[j])))
        places = [0] * len(nodes)
        for place, i in enumerate(ordered):
            places[i] = place
        return places
