"""Terms of several words in a text that is cut into runs of word characters and of others."""

from __future__ import annotations

from collections.abc import Iterable

WIDTH = 8  # runs; a longer term is looked up by its first ones


class Phrases:
    """Terms, each as the list of its runs.

    A term that stands between word borders is a sequence of whole runs of the text, so that it is
    found by hashing and no pattern is needed.
    """

    def __init__(self, terms: Iterable[list[str]]):
        self.short: dict[int, set[str]] = {}
        self.long: dict[str, list[tuple[int, str]]] = {}
        for runs in terms:
            if len(runs) <= WIDTH:
                self.short.setdefault(len(runs), set()).add("".join(runs))
            else:
                self.long.setdefault("".join(runs[:WIDTH]), []).append((len(runs), "".join(runs)))

    def find(self, runs: list[str], word_first: bool) -> list[str]:
        """Distinct terms that stand in a text, in order. Runs take turns, a word first or not."""
        # Before the first word and after the last one there is no border at the outer end.
        runs = runs[not word_first:]
        runs = runs[:len(runs) - (len(runs) % 2 == 0)]
        windows = lambda n: map("".join, zip(*(runs[i:] for i in range(n))))
        found: set[str] = set()
        for n, terms in self.short.items():
            found |= terms.intersection(windows(n))
        if self.long:
            found.update(term for i, head in enumerate(windows(WIDTH)) for n, term in self.long.get(head, ())
                         if "".join(runs[i:i + n]) == term)
        return sorted(found)
