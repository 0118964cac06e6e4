"""Longest-match word pieces over a given vocabulary: a double-array trie with failure links (Song et al. 2021).

A word is read once from left to right. Where the trie goes no further, the failure link of the node names the pieces
that are certain by then and the node at which reading goes on, so no character is read twice whatever the pieces are.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable

import numpy as np
from pyspark.sql import Column, DataFrame

from lexloom.operators.subwords import split_words

#: The mark of a piece inside a word, and the piece of a word that has no others.
INSIDE = "##"
UNKNOWN = "[UNK]"
SENT_PIECES = 1 << 20


class PieceTrie:
    """The pieces as a double-array trie: the child of ``s`` by character ``c`` is ``base[s] + code(c)`` if its check is ``s``.

    Node 0 begins words, node 1 goes on inside them. ``link`` and ``pops`` are each node's failure link (-1: none) and
    the pieces that it makes certain.
    """

    def __init__(self, pieces: Iterable[str], inside: str = INSIDE) -> None:
        starts, inner = {}, {}
        for piece in sorted(set(pieces)):
            if piece.startswith(inside) and len(piece) > len(inside):
                inner[piece[len(inside) :]] = piece
            elif piece:
                starts[piece] = piece
        self.codes = {c: k + 1 for k, c in enumerate(sorted({c for text in (*starts, *inner) for c in text}))}
        self.base, self.check = np.zeros(2, np.int64), np.full(2, -1, np.int64)
        self.check[:2] = 0
        self.first_free = 2
        order, parents, piece_at = self._build(starts, inner)
        self.base, self.check = self.base.tolist(), self.check.tolist()
        self._link(order, parents, piece_at)

    def _build(self, starts: dict[str, str], inner: dict[str, str]) -> tuple[list[int], dict[int, tuple[int, int]], dict[int, str]]:
        """Places the nodes level by level; each goes with its piece, its parent and the character from there."""
        order, parents, piece_at = [], {}, {}
        level = deque((root, sorted(texts.items()), 0) for root, texts in ((0, starts), (1, inner)))
        while level:
            node, below, depth = level.popleft()
            children: dict[int, list[tuple[str, str]]] = {}
            for text, piece in below:
                if len(text) == depth:
                    piece_at[node] = piece
                else:
                    children.setdefault(self.codes[text[depth]], []).append((text, piece))
            if not children:
                continue
            self._place(node, np.array(sorted(children)))
            for code, texts in sorted(children.items()):
                child = int(self.base[node]) + code
                parents[child] = (node, code)
                order.append(child)
                level.append((child, texts, depth + 1))
        return order, parents, piece_at

    def _place(self, node: int, codes: np.ndarray) -> None:
        """Finds a base at which the places of all children are free."""
        while True:
            room = len(self.check)
            free = np.flatnonzero(self.check[self.first_free :] < 0) + self.first_free
            if len(free):
                self.first_free = int(free[0])
            bases = free[free - codes[0] >= 1] - codes[0]
            bases = bases[bases + codes[-1] < room]
            for code in codes[1:]:
                bases = bases[self.check[bases + code] < 0]
            if len(bases):
                break
            grown = max(64, room, int(codes[-1]) + 2)
            self.base = np.concatenate([self.base, np.zeros(grown, np.int64)])
            self.check = np.concatenate([self.check, np.full(grown, -1, np.int64)])
        self.base[node] = bases[0]
        self.check[bases[0] + codes] = node

    def step(self, node: int, code: int) -> int:
        """The child of ``node`` by a character's code, or -1."""
        to = self.base[node] + code
        return to if to < len(self.check) and to > 1 and self.check[to] == node and self.base[node] else -1

    def _link(self, order: list[int], parents: dict[int, tuple[int, int]], piece_at: dict[int, str]) -> None:
        self.link = [-1] * len(self.base)
        self.pops: list[tuple[str, ...]] = [()] * len(self.base)
        for node in order:  # by depth, so shorter nodes have their links
            if node in piece_at:
                self.link[node], self.pops[node] = 1, (piece_at[node],)
                continue
            parent, code = parents[node]
            at, popped = self.link[parent], list(self.pops[parent])
            while at >= 0 and self.step(at, code) < 0:
                popped += self.pops[at]
                at = self.link[at]
            if at >= 0:
                self.link[node], self.pops[node] = self.step(at, code), tuple(popped)

    def split(self, word: str, unknown: str = UNKNOWN) -> list[str]:
        """The longest known piece of what is left, again and again; ``unknown`` alone if that does not reach the end."""
        node, out = 0, []
        for c in word:
            code = self.codes.get(c)
            if code is None:
                return [unknown]
            while (to := self.step(node, code)) < 0:
                if self.link[node] < 0:
                    return [unknown]
                out += self.pops[node]
                node = self.link[node]
            node = to
        while node != 1:
            if self.link[node] < 0:
                return [unknown]
            out += self.pops[node]
            node = self.link[node]
        return out


def piece_trie(vocab: DataFrame, piece: str = "piece", most: int = SENT_PIECES) -> PieceTrie:
    """The trie of a table of pieces, of which there are at most ``most``: it goes to every task."""
    rows = vocab.select(piece).where(f"{piece} IS NOT NULL").distinct().limit(most + 1).toArrow().column(0).to_pylist()
    if len(rows) > most:
        raise ValueError(f"a trie for every task holds at most {most} pieces")
    return PieceTrie(rows)


def wordpieces(tokens: Column, trie: PieceTrie) -> Column:
    """The pieces of every token of a token array, in order; null for a null array."""
    return split_words(tokens, trie.split)
