"""Positions of brackets in a JSON text: trees of any depth and width without parsing them whole."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

TOKEN = re.compile(r'"([^"\\]*(?:\\.[^"\\]*)*)"(\s*:)?|[\[\]{}]', re.S)
SCALAR = re.compile(r'\s*("[^"\\]*(?:\\.[^"\\]*)*"|[^\s,\[\]{}"]+)', re.S)
LIST, NODE, OTHER = range(3)
NONE = -1


class Tree:
    """Objects of a nested list, parents before children: where each begins and ends, where its
    id and its list of children stand, and its parent. Sixty-four bytes an object."""

    def __init__(self):
        self.start, self.end, self.parent, self.low, self.high, self.id_low, self.id_high = (array("q") for _ in range(7))

    def open(self, at: int, parent: int) -> int:
        for column, value in zip((self.start, self.end, self.parent, self.low, self.high, self.id_low, self.id_high),
                                 (at, NONE, parent, NONE, NONE, NONE, NONE)):
            column.append(value)
        return len(self.start) - 1

    def identity(self, text: str, node: int) -> str | None:
        """The id as it is written; None if there is none, or an empty one."""
        raw = text[self.id_low[node]:self.id_high[node]] if self.id_low[node] != NONE else "null"
        return None if raw in ("null", '""') else raw

    def own(self, text: str, node: int) -> str:
        """The object with an empty list in place of its children."""
        if self.low[node] == NONE:
            return text[self.start[node]:self.end[node]]
        return f"{text[self.start[node]:self.low[node]]}[]{text[self.high[node]:self.end[node]]}"


def scan(text: str, children: str = "replies", root: str | None = None, deep: bool = True) -> Tree | None:
    """The tree of a JSON array of objects, or with ``root`` of one object whose children are under that key.

    One pass over the brackets and strings, with a stack as deep as the text is nested. Objects of an
    array under ``children`` are nodes, other values are skipped. A text that is no such array or
    object, or whose brackets do not match, gives None. Without ``deep`` objects below others are no
    nodes, but their brackets are matched all the same.
    """
    tree, stack, key = Tree(), [], ""
    kind = node = NONE  # the top of the stack
    names = {NONE: children, 0: root} if root else {}
    done = False
    for m in TOKEN.finditer(text):
        last = m.lastindex
        if last:
            if kind == NONE:
                return None
            if last == 2 and kind == NODE:
                key = m.group(1)
                if key == "id" and (value := SCALAR.match(text, m.end())):
                    tree.id_low[node], tree.id_high[node] = value.span(1)
            continue
        at = m.start()
        c = text[at]
        if c in "[{":
            if kind == NONE:
                if done or text[:at].strip() or c != ("{" if root else "["):
                    return None
                kind, node = (NODE, tree.open(at, NONE)) if root else (LIST, NONE)
            elif kind == LIST and c == "{" and (deep or node == NONE):
                kind, node = NODE, tree.open(at, node)
            elif kind == NODE and c == "[" and key == names.get(node, children):
                tree.low[node] = at
                kind = LIST
            else:
                kind, node = OTHER, c
            stack.append((kind, node))
            continue
        if kind == NONE:
            return None
        stack.pop()
        if kind == OTHER:
            matched = c == ("]" if node == "[" else "}")
        elif kind == LIST:
            matched = c == "]"
            if node != NONE:
                tree.high[node] = at + 1
                key = ""
        else:
            matched = c == "}"
            tree.end[node] = at + 1
        if not matched:
            return None
        kind, node = stack[-1] if stack else (NONE, NONE)
        done = not stack
        if done and text[at + 1:].strip():
            return None
    return tree if done else None


def walk(text: str) -> Iterator[tuple[int, str | None, str]]:
    """(place, parent, own) of every object in a list of comments, depth first.

    ``parent`` is the parent's id as written, None at the top. Objects without an id are left out
    with all below them.
    """
    tree = scan(text)
    if tree is None:
        return
    ids: list[str | None] = []  # None: left out
    for node in range(len(tree.start)):
        above = tree.parent[node]
        ids.append(None if above != NONE and ids[above] is None else tree.identity(text, node))
        if ids[node] is not None:
            yield node + 1, None if above == NONE else ids[above], tree.own(text, node)
