"""Names of a gazetteer in a text: a trie of tokens, the longest name at each place."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from zlib import crc32

#: Runs of word characters, runs of blanks, and every other character by itself.
TOKEN = re.compile(r"\w+|\s+|[^\w\s]")
BITS = 1 << 27  # of a filter: 16 MB of a worker
END = ""  # key, in a node, of the types of the name that ends there


def tokens_of(text: str) -> list[str]:
    """Tokens as names are compared by: any run of blanks is one blank."""
    return [" " if token.isspace() else token for token in TOKEN.findall(text)]


def spot(phrase: str, first: bool = False) -> int:
    """Bit of a phrase in a filter, or of the first token of one."""
    return crc32((phrase + "\0" if first else phrase).encode()) & (BITS - 1)


class Filter:
    """What may be a name: bits of all names and of their first tokens, in pieces, and the numbers of tokens.

    A name is never refused; of other phrases a share passes that grows with the number of names.
    """

    def __init__(self, pieces: Iterable[tuple[int, bytes]], sizes: Iterable[int]):
        self.bits, self.sizes = bytearray(BITS // 8), sorted(sizes)
        for number, piece in pieces:
            self.bits[number * len(piece):(number + 1) * len(piece)] = piece

    def holds(self, phrase: str, first: bool = False) -> bool:
        at = spot(phrase, first)
        return self.bits[at >> 3] >> (at & 7) & 1 == 1

    def phrases(self, text: str) -> list[str]:
        """Distinct runs of tokens of a text that may be names."""
        tokens, starts, found = tokens_of(text), {}, set()
        for at, token in enumerate(tokens):
            begins = starts.get(token)
            if begins is None:
                begins = starts[token] = self.holds(token, first=True)
            if begins:
                for size in self.sizes:
                    if at + size > len(tokens):
                        break
                    phrase = "".join(tokens[at:at + size])
                    if phrase not in found and self.holds(phrase):
                        found.add(phrase)
        return list(found)


class Trie:
    """Names as paths of tokens. A blank in a name stands for any run of blanks."""

    def __init__(self, names: Iterable[tuple[str, str]]):
        self.root: dict = {}
        for entity_type, name in names:
            node = self.root
            for token in tokens_of(name.strip()):
                node = node.setdefault(token, {})
            if node is not self.root:
                node.setdefault(END, set()).add(entity_type)

    def find(self, text: str) -> Iterator[tuple[str, int, int]]:
        """(type, start, end) of the longest name at each place; places within a found name are passed over."""
        tokens = list(TOKEN.finditer(text))
        at = 0
        while at < len(tokens):
            node, reach, found = self.root, at, None
            while reach < len(tokens):
                token = tokens[reach].group()
                node = node.get(" " if token.isspace() else token)
                if node is None:
                    break
                reach += 1
                if END in node:
                    found = (reach, node[END])
            if found is None:
                at += 1
                continue
            for entity_type in sorted(found[1]):
                yield entity_type, tokens[at].start(), tokens[found[0] - 1].end()
            at = found[0]
