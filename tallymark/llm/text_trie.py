"""A compressed trie of whole texts whose terminals hold the least id of their text.

Edges carry byte strings, so a text takes as many steps as it has branching points, and what texts have in common is
kept once. A terminal holds the least id seen and the rows that have it; every other row is told its fate at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any


class Node:
    __slots__ = ("label", "children", "terminal")

    def __init__(self, label: bytes):
        self.label = label
        self.children: dict[int, Node] = {}
        self.terminal: Terminal | None = None


class Terminal:
    """The least id of a text, its rows by what tells them apart, and what the caller notes about the text."""

    __slots__ = ("least", "rows", "note")

    def __init__(self, least: int, note: Any):
        self.least, self.note = least, note
        self.rows: dict[Any, int] = {}


def common(label: bytes, text: bytes, at: int) -> int:
    """Length of the common prefix of ``label`` and ``text[at:]``, by halving."""
    low, high = 0, min(len(label), len(text) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if label[low:middle] == text[at + low : at + middle]:
            low = middle
        else:
            high = middle - 1
    return low


class TextTrie:
    def __init__(self) -> None:
        self.root, self.held = Node(b""), 0

    def _place(self, text: bytes) -> Node:
        """The node at which ``text`` ends."""
        node, at = self.root, 0
        while at < len(text):
            child = node.children.get(text[at])
            if child is None:
                child = node.children[text[at]] = Node(text[at:])
                self.held += len(child.label)
                return child
            if not text.startswith(child.label, at):
                shared = common(child.label, text, at)
                upper = Node(child.label[:shared])
                upper.children[child.label[shared]] = child
                node.children[text[at]] = upper
                child.label = child.label[shared:]
                child = upper
            node, at = child, at + len(child.label)
        return node

    def add(self, text: bytes, doc_id: int, row: Any, n: int = 1, note: Any = None) -> list[tuple[int, Any, int]]:
        """Insert ``n`` equal rows; returns the (id, row, number) that now have a smaller id before them."""
        node = self._place(text)
        now = node.terminal
        if now is not None and doc_id > now.least:
            return [(doc_id, row, n)]
        displaced = []
        if now is None or doc_id < now.least:
            if now is not None:
                displaced = [(now.least, r, k) for r, k in now.rows.items()]
            now = node.terminal = Terminal(doc_id, note)
        now.rows[row] = now.rows.get(row, 0) + n
        return displaced

    def walk(self) -> Iterator[tuple[bytes, Terminal]]:
        """(text, terminal) of every text held, in byte order."""
        stack = [(self.root, b"")]
        while stack:
            node, before = stack.pop()
            text = before + node.label
            if node.terminal is not None:
                yield text, node.terminal
            stack += [(node.children[first], text) for first in sorted(node.children, reverse=True)]
