"""A byte-pair encoder's merges as a deterministic transducer whose transitions carry token counts.

The encoding of a word's prefix is that of a shorter prefix plus one last token, and a last token ``t`` may follow a
last token ``u`` exactly where the merges leave ``u`` and ``t`` apart when run on both together. So what the next byte
does depends on little: the longest suffix read that begins some token (a node of the trie of all tokens, with links to
shorter suffixes), and, for each place in that suffix, the last token that ends there and how many tokens lie between
it and the end. This is the state. A transition reads a byte, finds the one token that ends behind it and fits its
predecessor, and is annotated with the change of the number of tokens; the counts met along a word add up to its
number of tokens. States and transitions are compiled when first met, as most of them never are, and at most
``STATE_LIMIT`` states are kept: beyond it the tables start anew, which changes no count.

Where merges cross the border of two tokens: ``u``'s right-hand parts and ``t``'s left-hand parts each exist from the
merge that makes them to the merge that uses them up, and the first merge whose two sides exist at once goes across.

Only merges that make each token in one way, from parts made earlier, are compiled; others are an error.
"""

from __future__ import annotations

import json
import math

from tonestream.llm.common import byte_letters

#: Most states that are kept; each has about twice as many numbers as its suffix has bytes.
STATE_LIMIT = 1 << 17
#: The "last token" in front of a word.
START = -1


class MergeTransducer:
    def __init__(self, model: dict):
        """``model`` is the ``model`` of a tokenizer file."""
        if model["type"] != "BPE" or any(model.get(x) for x in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix",
                                                                "fuse_unk", "byte_fallback", "ignore_merges")):
            raise ValueError("only plain byte-level BPE models are compiled")
        byte_of = {ord(letter): b for b, letter in byte_letters().items()}
        ids = model["vocab"]
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        for n, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair, made = (ids[left], ids[right]), ids[left + right]
            if made in self.parts or len(left + right) < 2 or any(len(x) > 1 and ids[x] not in self.parts for x in (left, right)):
                raise ValueError("these merges make a token twice, or from parts made later")
            self.rank[pair], self.parts[made] = n, pair
        if any(chr(letter) not in ids for letter in byte_of):
            raise ValueError("not every byte of UTF-8 has a token")
        whole = {t: i for t, i in ids.items() if all(ord(c) in byte_of for c in t)}  # others hold bytes that no text has
        self._trie([(bytes(byte_of[ord(c)] for c in t), i) for t, i in whole.items() if i in self.parts or len(t) == 1])
        self.alone: dict[int, bool] = {ids[chr(letter)]: True for letter in byte_of}
        self.apart: dict[tuple[int, int], bool] = {}
        self.tails: dict[int, list[tuple[int, float]]] = {}
        self.heads: dict[int, list[tuple[int, float]]] = {}
        self._forget()

    def _trie(self, tokens: list[tuple[bytes, int]]) -> None:
        self.child: dict[int, int] = {}
        self.depth, self.token, came = [0], [START], [(0, 0)]
        for raw, i in tokens:
            node = 0
            for b in raw:
                below = self.child.get(node << 8 | b)
                if below is None:
                    below = self.child[node << 8 | b] = len(self.depth)
                    self.depth.append(self.depth[node] + 1)
                    self.token.append(START)
                    came.append((node, b))
                node = below
            self.token[node] = i
        self.shorter = [0] * len(came)
        for node in sorted(range(1, len(came)), key=self.depth.__getitem__):
            parent, b = came[node]
            if parent:
                self.shorter[node] = self._suffix(self.shorter[parent], b)
        self.ending: dict[int, list[tuple[int, int]]] = {}

    def _suffix(self, node: int, byte: int) -> int:
        """The longest suffix that begins a token, one byte on."""
        while (below := self.child.get(node << 8 | byte)) is None:
            if not node:
                return 0
            node = self.shorter[node]
        return below

    def _tokens(self, node: int) -> list[tuple[int, int]]:
        """``(length, token)`` of the tokens that end where the node's suffix ends."""
        found = self.ending.get(node)
        if found is None:
            found, at = [], node
            while at:
                if self.token[at] != START and self._stands(self.token[at]):
                    found.append((self.depth[at], self.token[at]))
                at = self.shorter[at]
            self.ending[node] = found
        return found

    def _spine(self, token: int, side: int, kept: dict) -> list[tuple[int, float]]:
        """``(part, number of the merge that uses it up)`` down one side of a token."""
        found = kept.get(token)
        if found is None:
            found, part, used = [], token, math.inf
            while True:
                found.append((part, used))
                if part not in self.parts:
                    break
                used = self.rank[self.parts[part]]
                part = self.parts[part][side]
            kept[token] = found
        return found

    def _crossing(self, u: int, t: int) -> float:
        """The first merge across the border of ``u`` and ``t``; infinite if there is none.

        Of equal merges that overlap the left one comes first, hence the two comparisons.
        """
        first, heads = math.inf, self._spine(t, 0, self.heads)
        for x, x_used in self._spine(u, 1, self.tails):
            for y, y_used in heads:
                n = self.rank.get((x, y))
                if n is not None and n < x_used and n <= y_used and n < first:
                    first = n
        return first

    def _stands(self, token: int) -> bool:
        """Do the merges make this token of its bytes?"""
        todo = [token]
        while todo:
            t = todo[-1]
            if t not in self.alone:
                more = [p for p in self.parts[t] if p not in self.alone]
                if more:
                    todo += more
                    continue
                self.alone[t] = all(self.alone[p] for p in self.parts[t]) and self._crossing(*self.parts[t]) == self.rank[self.parts[t]]
            todo.pop()
        return self.alone[token]

    def _fits(self, u: int, t: int) -> bool:
        if u == START:
            return True
        found = self.apart.get((u, t))
        if found is None:
            if len(self.apart) > 8 * STATE_LIMIT:
                self.apart.clear()
            found = self.apart[u, t] = self._crossing(u, t) == math.inf
        return found

    def _forget(self) -> None:
        start = (0, (START,), (0,))
        self.states, self.number, self.step = [start], {start: 0}, {}

    def _compile(self, state: int, byte: int) -> tuple[int, int]:
        """The transition ``(next state, change of the number of tokens)``."""
        node, last, count = self.states[state]
        node = self._suffix(node, byte)
        length, token = next((n, t) for n, t in self._tokens(node) if self._fits(last[n - 1], t))
        more, reach = count[length - 1] + 1, self.depth[node]
        target = (node, (token, *last[:reach]), (0, *(c - more for c in count[:reach])))
        to = self.number.get(target)
        if to is None:
            anew = len(self.states) > STATE_LIMIT
            if anew:
                self._forget()
            to = self.number[target] = len(self.states)
            self.states.append(target)
            if anew:  # the state left has no number any more
                return to, more
        self.step[state << 8 | byte] = (to, more)
        return to, more

    def tokens(self, word: bytes) -> int:
        """How many tokens the merges leave of a word."""
        state = total = 0
        for byte in word:
            found = self.step.get(state << 8 | byte)
            state, more = found or self._compile(state, byte)
            total += more
        return total


def load(path: str) -> MergeTransducer:
    """The transducer of a tokenizer file."""
    with open(path, encoding="utf-8") as f:
        return MergeTransducer(json.load(f)["model"])
