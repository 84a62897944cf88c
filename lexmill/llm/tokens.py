"""Token ids of texts as little-endian 32-bit bytes, equal to the tokenizers library's on the whole text.

Both vocabularies split a text into pre-tokens before any merge. Where a cut at white space is certain to be
a pre-token border, pieces are encoded once and kept in a bounded table; any text with rarer white space,
special tokens' strings or characters that normalisation could join goes whole to the library.
"""

from __future__ import annotations

import re
import struct
import unicodedata

from tokenizers import Tokenizer

#: Entries of the table of pieces (about 200 bytes each); it starts afresh when full.
TABLE = 1_500_000
#: ASCII controls, and the first UTF-8 bytes of rarer white space, that the pieces' cuts don't cover.
_CONTROLS = b"\x1c\x1d\x1e\x1f"
_OTHER_SPACE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_LEADS = (b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a", b"\xe2\x80", b"\xe2\x81", b"\xe3\x80")
#: Byte-level texts are cut at single spaces and single line feeds only.
_LOOSE = (b"  ", b"\n\n", b" \n", b"\n ")
_PUNCTUATION = b".,;:!?"


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for themselves, others from 256 on."""
    printable = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {b: chr(b) for b in printable}
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + len(out) - len(printable))
    return [out[b] for b in range(256)]


def _pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class _Pieces(dict):
    def __init__(self, learn):
        super().__init__()
        self.learn = learn

    def __missing__(self, piece: bytes) -> bytes:
        if len(self) >= TABLE:
            self.clear()
        out = self[piece] = self.learn(piece)
        return out


class Encoder:
    """kind "byte": byte-level BPE, where a space belongs to the word after it; "word": white space is dropped."""

    def __init__(self, path: str, kind: str):
        self.tok = Tokenizer.from_file(path)
        #: Strings of added tokens: a text with one goes whole to the library, which gives them their single ids.
        self.added = [b"<|", *sorted({t.content.encode() for t in self.tok.get_added_tokens_decoder().values()} - {b""})]
        self.model = self.tok.model
        self.kind = kind
        self.letters = {k: x for k, x in enumerate(_byte_letters())}
        self.known = _Pieces(self._learn)

    def whole(self, text: str) -> bytes:
        return _pack(self.tok.encode(text, add_special_tokens=False).ids)

    def encode(self, raw: bytes) -> bytes:
        if any(x in raw for x in self.added) or len(raw.translate(None, _CONTROLS)) != len(raw):
            return self.whole(raw.decode("utf-8", "replace"))
        if not raw.isascii():
            text = raw.decode("utf-8", "replace")
            if any(x in raw for x in _LEADS) and _OTHER_SPACE.search(text) or self.kind == "word" and not unicodedata.is_normalized("NFC", text):
                return self.whole(text)
        if self.kind == "word":
            return b"".join(map(self.known.__getitem__, raw.lower().split()))
        if not raw:
            return b""
        if raw[0] in b" \n" or raw[-1] in b" \n" or any(x in raw for x in _LOOSE) or len(raw.translate(None, b"\t\x0b\x0c\r")) != len(raw):
            return self.whole(raw.decode("utf-8", "replace"))
        # a space opens the piece that it stands before, and a line feed is a piece
        pieces = raw.replace(b" ", b"\0 ").replace(b"\n", b"\0\n\0").split(b"\0") if b"\0" not in raw else None
        return self.whole(raw.decode("utf-8", "replace")) if pieces is None else b"".join(map(self.known.__getitem__, pieces))

    def _learn(self, piece: bytes) -> bytes:
        """Ids of a piece: one pre-token of letters goes to the model at once, others to the whole tokenizer."""
        word = piece[1:] if self.kind == "byte" and piece[:1] == b" " else piece
        text = word.decode("utf-8", "replace")
        if text.isalpha() and (self.kind == "byte" or text == text.lower()):
            spelt = piece.decode("latin-1").translate(self.letters)
            return _pack([t.id for t in self.model.tokenize(spelt)])
        bare = piece.rstrip(_PUNCTUATION)
        if bare != piece and bare and text.rstrip(_PUNCTUATION.decode())[-1:].isalpha():
            # a letter and a mark of punctuation never share a pre-token
            return self.known[bare] + self.known[piece[len(bare) :]]
        return self.whole(piece.decode("utf-8", "replace"))
