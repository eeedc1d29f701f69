"""Pieces of texts are looked up a text at a time."""

from __future__ import annotations

import struct
import weakref
from pathlib import Path

import pytest

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")

from kiln.llm import tokens as T  # noqa: E402

FILE = Path(public_tokenizers.path("byte_bpe_50k.json")).read_text(encoding="utf-8")
TEXTS = ["The cat sat... on the mat", None, "", " ", "ab1 ab.c a,,b\n\nEnd  of\tit ", "über-größe été!? x\r\n y", "the cat ate; the cat", "...a !!\n?? $5 a b"]


class Pieces(list):
    pass


def test_a_texts_pieces_are_not_held_while_the_next_is_cut():
    encoder, held = T.Encoder(FILE, 2), []
    most = 0

    def cut():
        nonlocal most
        for text in TEXTS * 3:
            pieces = Pieces(T.PIECE.findall(text or ""))
            held.append(weakref.ref(pieces))
            yield pieces
            del pieces
            most = max(most, sum(r() is not None for r in held))

    got = encoder.join(cut())
    assert got == [struct.pack(f"<{len(x.ids)}I", *x.ids) for x in (encoder.tokenizer.encode(t or "", add_special_tokens=False) for t in TEXTS * 3)]
    assert most <= 1


def test_no_more_is_remembered_than_there_is_room(monkeypatch):
    monkeypatch.setattr(T, "REMEMBERED", 3)
    encoder = T.Encoder(FILE, 2)
    for texts in (TEXTS, TEXTS[::-1], TEXTS):
        want = [struct.pack(f"<{len(x.ids) + 1}I", *x.ids, 2) for x in (encoder.tokenizer.encode(t or "", add_special_tokens=False) for t in texts)]
        assert encoder.packed(texts) == want and len(encoder.known) == 3
    assert b"".join(encoder.long(TEXTS[5])) == encoder.packed([TEXTS[5]])[0]


class Counting:
    """A tokenizer that counts the texts it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.given = tokenizer, 0

    def encode_batch_fast(self, texts, **more):
        self.given += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **more)


def alone(encoder, pieces):
    return {p: struct.pack(f"<{len(x.ids)}I", *x.ids) for p, x in ((p, encoder.tokenizer.encode(p, add_special_tokens=False)) for p in pieces)}


def test_pieces_that_are_no_spaced_words_are_encoded_in_runs():
    encoder = T.Encoder(FILE, 2)
    pieces = [f(i) for i in range(3000) for f in ("Wört{}".format, " {}ab's".format, "x_{}'ll-<|endoftext|>".format, " 日本{}\x1c".format)]
    assert all(T.PIECE.findall(p) == [p] for p in pieces)
    want = alone(encoder, pieces)
    encoder.tokenizer = Counting(encoder.tokenizer)
    assert encoder.encoded(pieces) == want
    assert encoder.tokenizer.given <= 2 * len(pieces) // T.RUN


def test_white_space_before_or_after_a_piece_changes_nothing():
    encoder = T.Encoder(FILE, 2)
    pieces = ["\n", "  ", "\t", "\t a", "  b", " \n c", "　d", " ", "e", " f", "'s", " 's", "...", "\x1c", " \x1c", "​", "<|endoftext|>", " <|endoftext|>", "/9" * 200, " " + "ü" * 300]
    assert encoder.encoded(pieces) == alone(encoder, pieces)
    assert encoder.encoded([]) == {}


def test_runs_whose_tokens_do_not_end_with_pieces_are_encoded_alone():
    from tokenizers import AddedToken, Tokenizer

    tokenizer = Tokenizer.from_str(FILE)
    tokenizer.add_special_tokens([AddedToken("<sep>", lstrip=True, rstrip=True)])
    encoder = T.Encoder(tokenizer.to_str(), 2)
    pieces = ["a1", "<sep>", " <sep>", "b<sep>c", " d"]
    assert encoder.encoded(pieces) == alone(encoder, pieces)


def test_the_tokenizer_starts_no_threads_unless_told_to(monkeypatch):
    monkeypatch.delenv("TOKENIZERS_PARALLELISM", raising=False)
    T.Encoder(FILE, 2)
    assert T.os.environ["TOKENIZERS_PARALLELISM"] == "false"
    monkeypatch.setenv("TOKENIZERS_PARALLELISM", "true")
    T.Encoder(FILE, 2)
    assert T.os.environ["TOKENIZERS_PARALLELISM"] == "true"
