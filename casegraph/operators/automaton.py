"""Many terms found in many texts at once: a trie over token numbers with failure links, as flat arrays.

The automaton is built once on the driver, from a dictionary of checked size, and broadcast. Tokens of a batch are
numbered by one look-up; a token that no term has ends every match, so only runs of the others are read. All runs of a
batch move on by a token at a time. The work follows the number of tokens, whatever the lengths of the terms. A long run
is cut into pieces, each read from as many tokens before it as the longest term has, so that no step waits for one text.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_PIECE = 256


@dataclass(frozen=True)
class TermAutomaton:
    vocabulary: pa.Array  # a token's number is its place
    keys: np.ndarray  # state * len(vocabulary) + token of each transition, ascending
    targets: np.ndarray
    fail: np.ndarray  # state of the longest proper suffix that is a path too
    term: np.ndarray  # term that ends at a state, or -1
    shorter: np.ndarray  # next state along the failure links at which a term ends, 0 for none
    longest: int

    def number(self, tokens: pa.Array) -> np.ndarray:
        """Numbers of tokens; -1 for one that no term has."""
        return pc.fill_null(pc.index_in(tokens, value_set=self.vocabulary), -1).to_numpy(zero_copy_only=False)

    def _step(self, state: np.ndarray, token: np.ndarray) -> np.ndarray:
        out = np.zeros_like(state)
        at, open_ = state.copy(), np.arange(len(state))
        while len(open_):
            key = at[open_] * len(self.vocabulary) + token[open_]
            place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[place] == key
            out[open_[hit]] = self.targets[place[hit]]
            open_ = open_[~hit]
            open_ = open_[at[open_] != 0]
            at[open_] = self.fail[at[open_]]
        return out

    def _pieces(self, numbers: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First token, number of tokens, and how many of them only lead up to the piece; the longest first."""
        known = numbers >= 0
        joined = np.zeros(len(numbers), dtype=bool)
        joined[1:] = known[1:] & known[:-1] & (text[1:] == text[:-1])
        start = np.flatnonzero(known & ~joined)
        follows = np.append(joined[1:], False)
        length = np.flatnonzero(known & ~follows) + 1 - start
        cuts = -(-length // _PIECE)
        of = np.repeat(np.arange(len(start)), cuts)
        offset = (np.arange(len(of)) - np.repeat(np.cumsum(cuts) - cuts, cuts)) * _PIECE
        lead = np.minimum(offset, self.longest - 1)
        size = np.minimum(length[of] - offset, _PIECE) + lead
        order = np.argsort(-size, kind="stable")
        return (start[of] + offset - lead)[order], size[order], lead[order]

    def find(self, numbers: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Text and term of every occurrence; ``text`` says which text each token is in, ascending."""
        texts, terms = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        begin, size, lead = self._pieces(numbers, text)
        state = np.zeros(len(begin), dtype=np.int64)
        for t in range(int(size[0]) if len(size) else 0):
            n = int(np.searchsorted(-size, -t, side="left"))
            state = self._step(state[:n], numbers[begin[:n] + t].astype(np.int64))
            at, of = state, text[begin[:n] + t]
            counted = (lead[:n] <= t) & (at > 0)
            at, of = at[counted], of[counted]
            while len(at):
                ends = self.term[at] >= 0
                texts.append(of[ends])
                terms.append(self.term[at[ends]])
                at = self.shorter[at]
                at, of = at[at > 0], of[at > 0]
        return np.concatenate(texts), np.concatenate(terms)


def build(terms: Sequence[Sequence[str]]) -> TermAutomaton:
    """The automaton of different, non-empty terms, each a sequence of tokens."""
    words = sorted({token for term in terms for token in term})
    number = {word: i for i, word in enumerate(words)}
    children: list[dict[int, int]] = [{}]
    ends = [-1]
    for i, term in enumerate(terms):
        state = 0
        for token in term:
            following = children[state].get(number[token])
            if following is None:
                following = children[state][number[token]] = len(children)
                children.append({})
                ends.append(-1)
            state = following
        ends[state] = i
    fail, shorter = [0] * len(children), [0] * len(children)
    queue = deque(children[0].values())
    while queue:
        state = queue.popleft()
        for token, following in children[state].items():
            queue.append(following)
            at = fail[state]
            while at and token not in children[at]:
                at = fail[at]
            fail[following] = at = children[at].get(token, 0)
            shorter[following] = at if ends[at] >= 0 else shorter[at]
    moves = sorted((s * len(words) + token, t) for s, below in enumerate(children) for token, t in below.items())
    keys, targets = np.array(moves, dtype=np.int64).reshape(-1, 2).T
    return TermAutomaton(
        pa.array(words, type=pa.string()), np.ascontiguousarray(keys), np.ascontiguousarray(targets), np.array(fail, dtype=np.int64),
        np.array(ends, dtype=np.int64), np.array(shorter, dtype=np.int64), max((len(t) for t in terms), default=1),
    )
