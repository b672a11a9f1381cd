"""Token ids of whole texts with a tokenizer file, a repeated unit encoded once per worker."""

from __future__ import annotations

import functools
import re
import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

#: What the tokenizers' own patterns call white space (it is not what str.split() means by it).
SPACE = "\t-\r \x85\xa0  -     　"
#: White space at which a piece between blanks cannot be cut by line ends alone.
IRREGULAR = re.compile("\n|[" + SPACE.replace("\t-\r ", "\t\x0b-\r ") + "]|^$")
UNITS = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
KEPT_PIECES, KEPT_BYTES = 800_000, 16 << 20  # encoded pieces between blanks that a worker keeps, and their bytes
LONG_PIECE = 64  # bytes; longer pieces are not kept
SLICE_BYTES = 8 << 20  # text that is encoded at a time
MARKS = ".,;:!?"
CUT = "\x00"  # stands where a text is cut into pieces; texts that hold it are encoded whole
#: Byte-level vocabularies write printable bytes as themselves and the others, in order, from U+0100 on.
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_CHARACTERS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in PRINTABLE)}


class Encoder:
    """Ids as little-endian integers of the smallest of 2 or 4 bytes that holds the vocabulary.

    The patterns of the tokenizers served here never let a token cross from a non-space to a
    white-space run, so the ids of a text are those of its units (a run without white space with
    the one space before it, or the rest of a white-space run) in a row. Equality with encoding the
    whole text is tested. Strings of special tokens in a text are ordinary text.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model, self.normalizer = self.tokenizer.model, self.tokenizer.normalizer
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.form = "H" if self.dtype.itemsize == 2 else "I"
        #: White space is part of the ids, or only parts the words.
        self.spaced = bool(self.direct(" "))
        self.marks = {mark: self.direct(mark) for mark in MARKS + "\n"}
        letters = "ABCXYZ abcxyz 0189 .,;:!?'\"-"
        #: Whether normalising means no more to ASCII than lower case.
        self.lowers = bool(self.normalizer) and self.normalizer.normalize_str(letters) == letters.lower()
        self.known = self._table([])

    def _table(self, pieces: list[str]):
        """Pieces, which of them are irregular, starts and sizes of their ids, the ids in a row.

        Runs of ASCII letters, with a mark behind them or none, are most of what is new; they go straight
        to the vocabulary's merges, as ``word`` and ``unit`` would send them one by one.
        """
        tokenize, odd, sizes, ids = self.model.tokenize, [], [], []
        blank = chr(BYTE_CHARACTERS[32]) if self.spaced else ""
        marks = {mark: np.frombuffer(own, self.dtype).tolist() for mark, own in self.marks.items()}
        line = marks.pop("\n")
        plain = self.lowers or not self.normalizer
        for piece in pieces:
            before = len(ids)
            body, lead = (piece[1:], "") if piece[:1] == "\n" else (piece, blank)
            head, mark = (body, None) if body.isalpha() else (body[:-1], marks.get(body[-1:]))
            if plain and head.isascii() and head.isalpha() and (mark is not None or head is body):
                if body is not piece:
                    ids += line
                ids += [token.id for token in tokenize(lead + (head.lower() if self.lowers else head))]
                if mark is not None:
                    ids += mark
                odd.append(False)
            else:
                own = self._piece(piece, True)
                odd.append(own is None)
                if own:
                    ids += np.frombuffer(own, self.dtype).tolist()
            sizes.append(len(ids) - before)
        sizes = np.array(sizes, np.int64)
        return pa.array(pieces, pa.string()), np.array(odd, bool), np.cumsum(sizes) - sizes, sizes, np.array(ids, self.dtype)

    @staticmethod
    def _both(a, b):
        return (pa.concat_arrays([a[0], b[0]]), np.concatenate([a[1], b[1]]), np.concatenate([a[2], b[2] + len(a[4])]),
                np.concatenate([a[3], b[3]]), np.concatenate([a[4], b[4]]))

    def _bytes(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{self.form}", *ids)

    def direct(self, text: str) -> bytes:
        return self._bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def word(self, lead: str, word: str) -> bytes:
        """Ids of a run of letters, which the patterns keep whole: straight from the vocabulary's merges."""
        if self.lowers and word.isascii():
            word = word.lower()
        elif self.normalizer:
            whole, word = word, self.normalizer.normalize_str(word)
            if not word.isalpha():  # a letter that is written in lower case with a mark
                return self.direct(lead + whole)
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(BYTE_CHARACTERS)
        if lead:
            word = chr(BYTE_CHARACTERS[32]) + word
        return self._bytes([token.id for token in self.model.tokenize(word)])

    def unit(self, lead: str, unit: str) -> bytes:
        if unit.isalpha():
            return self.word(lead, unit)
        head = unit[:-1]
        if unit[-1:] in self.marks and (head.isascii() or not self.normalizer) and head.isalpha():
            # A letter run ends before punctuation, so both parts are encoded by themselves. (Lower
            # case can turn other letters into a letter and a mark, which would join the punctuation.)
            return self.word(lead, head) + self.marks[unit[-1]]
        return self.direct(lead + unit)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.spaced or any(map(text.__contains__, "\x1c\x1d\x1e\x1f")):
            return b"".join([self.unit("", u) for u in UNITS.findall(text)])
        return b"".join([self.unit("", u) for u in text.split()])

    def _piece(self, piece: str, led: bool) -> bytes | None:
        """Ids of what stands between two blanks or line ends; None if its white space needs the whole text.

        A piece behind a line end begins with it, and has no blank before it.
        """
        if not self.spaced:
            return self.encode(piece)
        if piece.isalpha():
            return self.word(" " if led else "", piece)
        if led and piece[0:1] == "\n":
            return None if IRREGULAR.search(piece[1:]) else self.marks["\n"] + self.unit("", piece[1:])
        return None if IRREGULAR.search(piece) else self.unit(" " if led else "", piece)

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text. Pieces met before are looked up as arrays, new ones are encoded once."""
        out, at = [], 0
        texts = texts.fill_null("")
        ends = np.cumsum(pc.binary_length(texts).to_numpy().astype(np.int64))
        while at < len(texts):
            reach = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE_BYTES, "right")))
            out += self._encode_slice(texts.slice(at, reach - at))
            at = reach
        return out

    def _encode_slice(self, texts: pa.Array) -> list[bytes]:
        given = texts
        if self.lowers:  # as the normaliser would later, but before equal pieces are told apart
            texts = pc.ascii_lower(texts)
        if self.spaced:
            texts = pc.replace_substring(pc.replace_substring(texts, " ", CUT), "\n", CUT + "\n")
        else:
            texts = pc.replace_substring(pc.replace_substring(texts, " ", CUT), "\n", CUT)
        split = pc.split_pattern(texts, CUT)
        begins = split.offsets.to_numpy().astype(np.int64)
        values = split.values
        codes = pc.index_in(values, self.known[0])
        table = self.known
        if codes.null_count:
            strange = values.filter(codes.is_null()).unique()
            long = pc.greater(pc.binary_length(strange), LONG_PIECE)
            # Long pieces stand behind the others, so that the table is cut where they begin.
            strange = pa.concat_arrays([strange.filter(pc.invert(long)), strange.filter(long)])
            pieces = strange.to_pylist()
            table = self._both(table, self._table(pieces))
            fresh = pc.add(pc.index_in(values, strange), len(self.known[0]))
            codes = pc.coalesce(codes, fresh)
            codes = codes.to_numpy().astype(np.int64)
            self._keep(table, codes, len(table[0]) - pc.sum(long).as_py())
        codes = np.asarray(codes, np.int64)
        _, irregular, starts, sizes, stored = table
        width = self.dtype.itemsize
        counts = sizes[codes]
        after = np.concatenate([[0], np.cumsum(counts)])
        source = np.repeat(starts[codes] - after[:-1], counts) + np.arange(after[-1])
        stream = stored[source].tobytes()
        odd = np.concatenate([[0], np.cumsum(irregular[codes])])[begins]
        # The first piece has no blank before it.
        edges = (after * width)[begins].tolist()
        seconds = (after * width)[np.minimum(begins[:-1] + 1, begins[1:])].tolist()
        if self.spaced:
            firsts = values.take(pa.array(begins[:-1])).to_pylist()
            strange = (np.diff(odd) > 0) | pc.match_substring(given, CUT).to_numpy(zero_copy_only=False)
            return [self.encode(given[i].as_py()) if whole else head + stream[seconds[i]:edges[i + 1]]
                    for i, (whole, head) in enumerate(zip(strange.tolist(), map(self._first, firsts)))]
        strange = pc.match_substring(given, CUT).to_numpy(zero_copy_only=False)
        return [self.encode(given[i].as_py()) if whole else stream[edges[i]:edges[i + 1]] for i, whole in enumerate(strange.tolist())]

    def _first(self, piece: str) -> bytes:
        """Ids of a text's first piece; those of an irregular one do not matter, as the text is encoded whole."""
        return self._piece(piece, False) or b""

    def _keep(self, table, codes: np.ndarray, count: int) -> None:
        """The table's first ``count`` pieces for the slices to come; if they are too many, those that this slice has."""
        pieces, odd, starts, sizes, stored = table
        kept = np.arange(len(pieces)) < count
        if count > KEPT_PIECES or pc.sum(pc.binary_length(pieces.slice(0, count))).as_py() > KEPT_BYTES:
            met = np.zeros(len(pieces), bool)
            met[codes] = True
            kept &= met
        sizes = np.where(kept, sizes, 0)[kept]
        source = np.repeat(starts[kept] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        self.known = (pieces.filter(pa.array(kept)), odd[kept], np.cumsum(sizes) - sizes, sizes, stored[source])


@functools.cache
def encoder(path: str) -> Encoder:
    """One per worker process, kept over tasks."""
    return Encoder(path)


def encoded(texts: pa.Array, path: str, end_id: int) -> tuple[list[bytes], np.dtype]:
    """Ids of each text and ``end_id`` behind them; a null text counts as empty."""
    coder = encoder(path)
    end = np.array([end_id], coder.dtype).tobytes()
    return [ids + end for ids in coder.encode_all(texts)], coder.dtype
