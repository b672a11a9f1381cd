import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from textpulse.llm.encode import Encoder

FILES = ("byte_bpe_50k.json", "word_bpe_49k.json")
CODERS = {name: (Encoder(public_tokenizers.path(name)), Tokenizer.from_file(public_tokenizers.path(name))) for name in FILES}
for _, whole in CODERS.values():
    whole.encode_special_tokens = True
PARTS = st.sampled_from(["a", "the", "The", " ", "  ", "\n", "\t", "\r\n", ".", ",", "...", "'s", "don't", "é", "Ñ", "ß", "é", "́", "Σ", "ΣΑΣ", "İ",
                         "漢字", "🙂", "1", "2024", "_", "\x1c", "\x85", "\xa0", " ", "　", "​", "K", "<|endoftext|>", "x" * 70, "-", "\x00"])


def check(text):
    for coder, whole in CODERS.values():
        want = whole.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(coder.encode(text), coder.dtype).tolist() == want


@settings(max_examples=400, deadline=None)
@given(st.lists(PARTS, max_size=12).map("".join))
def test_units_give_the_ids_of_the_whole_text(text):
    check(text)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40))
def test_any_text(text):
    check(text)


@pytest.mark.parametrize("text", [None, ""])
def test_nothing_gives_no_ids(text):
    assert all(coder.encode(text) == b"" for coder, _ in CODERS.values())


def test_generations(monkeypatch):
    monkeypatch.setattr("textpulse.llm.encode.KEPT_PIECES", 3)
    for name in FILES:
        coder, whole = Encoder(public_tokenizers.path(name)), CODERS[name][1]
        for text in ("one two three four. five six", "one two, three four", "six seven two three. one", "four five\nsix two"):
            got = coder.encode_all(pa.array([text, text.upper()]))
            assert [np.frombuffer(ids, coder.dtype).tolist() for ids in got] == [whole.encode(t).ids for t in (text, text.upper())]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.none() | st.lists(PARTS, max_size=8).map("".join), max_size=5))
def test_arrays(texts):
    for coder, whole in CODERS.values():
        got = [np.frombuffer(ids, coder.dtype).tolist() for ids in coder.encode_all(pa.array(texts, pa.string()))]
        assert got == [whole.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_slices(monkeypatch):
    monkeypatch.setattr("textpulse.llm.encode.SLICE_BYTES", 5)
    test_arrays()
