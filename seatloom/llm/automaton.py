"""Aho-Corasick over vocabulary pieces, with outputs by length, and exact BPE on top of it in one pass.

A token sequence is what BPE makes of a text exactly when every two neighbours stay apart if merged alone: no
merge crosses a boundary unless it would do so with only these two tokens there. So for each prefix exactly
one of the tokens that end there fits the last token of the prefix before it, and one pass over the automaton's
output links finds it. What pairs stay apart is remembered.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence


class AhoCorasick:
    """Nodes are numbers; outputs(node) lists (length, id) of all pieces that end there, longest first."""

    def __init__(self, pieces: Sequence[tuple[Sequence, int]]):
        self.go: list[dict] = [{}]
        own: list[tuple[int, int] | None] = [None]
        for piece, number in pieces:
            node = 0
            for c in piece:
                nxt = self.go[node].get(c)
                if nxt is None:
                    nxt = self.go[node][c] = len(self.go)
                    self.go.append({})
                    own.append(None)
                node = nxt
            own[node] = (len(piece), number)
        self.fail = [0] * len(self.go)
        self.link = [0] * len(self.go)  # the nearest node on the way of failures that ends a piece
        self.own = own
        queue = list(self.go[0].values())
        for node in queue:
            for c, child in self.go[node].items():
                queue.append(child)
                back = self.fail[node]
                while back and c not in self.go[back]:
                    back = self.fail[back]
                back = self.go[back].get(c, 0)
                self.fail[child] = back
                self.link[child] = back if own[back] else self.link[back]
        self.shortcuts = 0
        self.found: list[tuple | None] = [None] * len(self.go)

    #: Transitions over failures that are remembered, beside the trie's own.
    MOST_SHORTCUTS = 1_000_000

    def step(self, node: int, c) -> int:
        """The node after c, remembered for the next time."""
        go = self.go
        if c in go[node]:
            return go[node][c]
        at = node
        while at and c not in go[at]:
            at = self.fail[at]
        target = go[at].get(c, 0)
        if self.shortcuts < self.MOST_SHORTCUTS:
            self.shortcuts += 1
            go[node][c] = target
        return target

    def outputs(self, node: int) -> tuple:
        got = self.found[node]
        if got is None:
            found, at = [], node if self.own[node] else self.link[node]
            while at:
                found.append(self.own[at])
                at = self.link[at]
            got = self.found[node] = tuple(found)
        return got


class PrefixBpe:
    """Last token and token count of BPE at every prefix of a word.

    merge(symbols) -> symbols is the plain rule on a few symbols; symbols are slices of the word.
    A symbol that no piece covers stands alone as token -1.
    """

    MOST_PAIRS = 1_000_000

    def __init__(self, pieces: Sequence[tuple[Sequence, int]], merge: Callable[[Sequence], list]):
        self.automaton, self.merge = AhoCorasick(pieces), merge
        self.piece = {i: p for p, i in pieces}
        self.size = {i: len(p) for p, i in pieces} | {-1: 1}
        #: by token, then by the one before it (None: the word's beginning): whether they stay apart
        self.apart: dict[int, dict] = {i: {} for _, i in pieces}
        self.pairs = 0

    def fits(self, left: int | None, right: int) -> bool:
        """Whether right can follow left (None: begin the word)."""
        got = self.apart[right].get(left)
        if got is None:
            b = self.piece[right]
            if left is None or left == -1:
                got = self.merge(b) == [b]
            else:
                a = self.piece[left]
                got = self.merge(a + b) == [a, b]
            if self.pairs >= self.MOST_PAIRS:
                for known in self.apart.values():
                    known.clear()
                self.pairs = 0
            self.pairs += 1
            self.apart[right][left] = got
        return got

    def last_tokens(self, word: Sequence) -> list:
        """last[e]: the last token of the prefix of length e (None for the empty one)."""
        last: list = [None]
        self._go_on(word, last, [0])
        return last

    def _go_on(self, word: Sequence, last: list, nodes: list[int]) -> None:
        """Bring last and the automaton's nodes, which hold a prefix of the word, to the word's end."""
        go, step, found, outputs, apart, fits = self.automaton.go, self.automaton.step, self.automaton.found, self.automaton.outputs, self.apart, self.fits
        node, known = nodes[-1], len(nodes)
        for e, c in enumerate(word[known - 1 :], known):
            to = go[node].get(c)
            node = step(node, c) if to is None else to
            nodes.append(node)
            for length, token in found[node] or outputs(node):
                before = last[e - length]
                ok = apart[token].get(before)
                if ok or ok is None and fits(before, token):
                    last.append(token)
                    break
            else:
                last.append(-1)

    def run(self, word: Sequence) -> tuple[list, list[int]]:
        """last[e] and count[e] for the prefixes of length 0 to len(word): one token more than where the last begins."""
        last, size = self.last_tokens(word), self.size
        count = [0]
        for e in range(1, len(last)):
            count.append(count[e - size[last[e]]] + 1)
        return last, count

    def count(self, word: Sequence) -> int:
        """Tokens of the whole word."""
        last, size, e, n = self.last_tokens(word), self.size, len(word), 0
        while e:
            e -= size[last[e]]
            n += 1
        return n

    def tokens(self, word: Sequence) -> list[int]:
        return self._back(self.last_tokens(word), len(word))

    def tokens_of_sorted(self, words: Sequence[Sequence]) -> list[list[int]]:
        """Tokens of each word. The pass over a word begins where it parts from the word before it, so it is cheap for
        words in order; the result doesn't depend on the order."""
        out, last, nodes, before = [], [None], [0], ""
        for word in words:
            same = 0
            for a, b in zip(before, word, strict=False):
                if a != b:
                    break
                same += 1
            del last[same + 1 :], nodes[same + 1 :]
            self._go_on(word, last, nodes)
            out.append(self._back(last, len(word)))
            before = word
        return out

    def _back(self, last: list, e: int) -> list[int]:
        size, out = self.size, []
        while e:
            out.append(last[e])
            e -= size[last[e]]
        return out[::-1]
