import random

import numpy as np

from cadenza.llm import common
from cadenza.llm.common import MemoEncoder


def ids(raw):
    return np.frombuffer(raw, "<u4").tolist()


def test_every_text_equals_the_library(byte_bpe, library, monkeypatch):
    rnd = random.Random(9)
    atoms = ["the", "Cat", "naïve", "straße.", "it's", "we'll,", "12", "3.5", "..", "a.b", "ſ", "日本", "😀", "\u0250x", "<|endoftext|>", "<|endof", "x" * 40, "end.", "é,", "'", "\x00"]
    blanks = [" "] * 12 + ["\n"] * 4 + ["  ", "\n\n", " \n", "\n ", "\t", "\u00a0", "\u00a0 ", "\u2003\u3000", "\x0b", "\x85", "\x1c", "\r\n", ""]
    texts = ["".join(rnd.choice(atoms) + rnd.choice(blanks) for _ in range(rnd.randint(0, 30))) for _ in range(1500)]
    texts = [rnd.choice(["", "", " ", "\n", "  "]) + t for t in texts] + ["", " ", "\n", "  ", "\n\n\n", "<|endoftext|>"]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    # A tiny memo starts afresh again and again, tiny groups hold one text each: nothing changes.
    for entries, group in ((500_000, 4_000_000), (40, 300), (4, 1)):
        monkeypatch.setattr(common, "GROUP_BYTES", group)
        encoder = MemoEncoder(byte_bpe, entries)
        for _ in range(2):
            assert [ids(x) for x in encoder.encode_batch(texts)] == want
    assert encoder.encode_batch([]) == [] and ids(encoder.encode("the Cat")) == library.encode("the Cat").ids


def test_null_is_empty(byte_bpe):
    import pyarrow as pa

    assert MemoEncoder(byte_bpe).encode_column(pa.array([None, "a", ""], pa.string()).slice(0, 2))[0] == b""
