"""Exact tokenisation of whole texts by a public tokenizer, with its work done once a piece.

The word-level vocabulary's tokenizer cuts a normalised text into pieces and merges each by itself.
Texts of Latin, Greek and Cyrillic letters are cut here, and a frequent piece is merged once a
process and a table look-up after that. As the tokenizer never joins characters across ASCII white
space, other words go through the library one by one. A tokenizer with another normaliser or
pre-tokenizer encodes whole texts by the library.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from array import array

import numpy as np

from harvestry.llm.workers import kept

#: Distinct pieces kept by a process, some 70 MB; beyond it the table starts anew.
MAX_PIECES = 400_000

#: Bytes of letters from U+0500 on: some were added to Unicode lately, and libraries may not agree on them.
_FAR = bytes(range(0xD4, 0x100))
#: The pre-tokenizer's pieces of a text without such letters: endings, runs of letters, single digits, runs of other signs.
#: Superscripts and fractions count as digits there; the separators of ASCII are no white space.
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_²³¹¼½¾]+|[\d²³¹¼½¾]|(?:[^\w \t-\r\x85\xa0]|_)+").findall

# The normaliser and pre-tokenizer for which words may be encoded one by one.
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_SPLIT = {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}
_PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": _SPLIT, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


def byte_letters() -> list[str]:
    """The printable stand-in of each byte value in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves, the rest for the code points from 256 on.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, spare = [], 256
    for b in range(256):
        out.append(chr(b) if b in plain else chr(spare))
        spare += b not in plain
    return out


class PieceEncoder(dict):
    """Maps a piece, as the pre-tokenizer cuts it, to the bytes of its ids, little-endian unsigned integers of width bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.kind, self.code = f"<u{self.width}", "H" if self.width == 2 else "I"
        self.letters = byte_letters()
        about = json.loads(self.tokenizer.to_str())
        self.special = [t["content"].encode() for t in about["added_tokens"]]
        spaced = [t for t in about["added_tokens"] if t["normalized"] or any(c.isspace() for c in t["content"])]
        self.by_word = about["normalizer"] == _NORMALIZER and about["pre_tokenizer"] == _PRE_TOKENIZER and about["model"]["type"] == "BPE" and not spaced

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= MAX_PIECES:
            self.clear()
        mapped = piece if piece.isascii() and piece.isprintable() else "".join(map(self.letters.__getitem__, piece.encode()))
        out = self[piece] = array(self.code, [t.id for t in self.model.tokenize(mapped)]).tobytes()
        return out

    def by_pieces(self, text: bytes) -> bytes | None:
        """The ids of a text that holds only what this class and the library surely agree on, else None."""
        if len(text.translate(None, _FAR)) != len(text) or any(t in text for t in self.special):
            return None
        try:
            said = text.decode()
        except UnicodeDecodeError:
            return None
        if not said.isascii() and ("Σ" in said or not unicodedata.is_normalized("NFC", said)):
            return None
        return b"".join(map(self.__getitem__, _PIECES(said.lower())))

    def by_library(self, text: bytes) -> bytes:
        return array(self.code, self.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids).tobytes()

    def encode(self, text: bytes | None) -> bytes:
        """The ids of a whole text (null: none), in width bytes each."""
        if not text:
            return b""
        if not self.by_word:
            return self.by_library(text)
        out = self.by_pieces(text)
        if out is None:  # only the words at fault go through the library
            out = b"".join(self.by_library(w) if (ids := self.by_pieces(w)) is None else ids for w in text.split())
        return out

    def wide(self, text: bytes | None, end_id: int | None = None) -> np.ndarray:
        """The ids of a whole text (null: none), then end_id, as unsigned 32-bit integers."""
        ids = np.frombuffer(self.encode(text), self.kind)
        out = np.empty(len(ids) + (end_id is not None), "<u4")
        out[: len(ids)] = ids
        if end_id is not None:
            out[-1] = end_id
        return out


def encoder(path: str) -> PieceEncoder:
    """The process's encoder for the vocabulary file at path."""
    return kept(("tokens", path), lambda: PieceEncoder(path))
