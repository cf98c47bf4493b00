"""Token ids of whole texts through the tokenizers library, with the ids of pieces kept.

Both tokenizer files here split a text into pieces first and merge inside a piece only, so the ids of a text are the ids of
its pieces in a row. Pieces repeat; each is encoded by the library once and looked up from then on. The split is done
here for texts of Latin characters (up to U+017F), where the classes of the library's patterns can be spelled out; any other
text, and one that may hold a special token, goes to the library whole.
"""

from __future__ import annotations

import os
import re
from array import array

# The split patterns of the two tokenizer files, their Unicode classes written out up to U+017F.
_L = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ſ"
_N = "0-9\xb2\xb3\xb9\xbc-\xbe"
_S = "\t\n\x0b\x0c\r \x85\xa0"
_ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"
SPLITS = {
    "byte_bpe_50k.json": re.compile(f"{_ENDINGS}| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+"),
    "word_bpe_49k.json": re.compile(f"{_ENDINGS}|[{_L}]+|[{_N}]|[^{_S}{_L}{_N}]+"),
}
LOWERED = {"word_bpe_49k.json"}


def _alphabet() -> dict[int, str]:
    """Byte-level alphabet: printable Latin-1 bytes are themselves, the others the characters from U+0100 on in ascending order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return {b: chr(256 + k) for k, b in enumerate(others)}


_ALPHABET = _alphabet()
_LATIN = re.compile("[\x00-ſ]*")
#: Pieces kept at a time: bounds the memory of a worker, not the result.
KEPT_PIECES = 500_000


class Encoder:
    """encode(texts) gives each text's ids as little-endian unsigned 32-bit integers in bytes."""

    def __init__(self, path: str, kept: int = KEPT_PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        name = os.path.basename(path)
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.split, self.lower, self.kept = SPLITS.get(name), name in LOWERED, kept
        self.ids: dict[str, bytes] = {}

    def _library(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _piece(self, piece: str) -> bytes:
        """Ids of one piece by the library's merges; its bytes are spelled in the byte alphabet that the merges are written in."""
        return array("I", [t.id for t in self.model.tokenize(piece.encode().decode("latin-1").translate(_ALPHABET))]).tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        texts = [t or "" for t in texts]
        cut = [None] * len(texts)
        if self.split:
            for i, t in enumerate(texts):
                if "<|" not in t and _LATIN.fullmatch(t):
                    cut[i] = self.split.findall(t.lower() if self.lower else t)
        new = [p for p in set().union(*(c for c in cut if c)) if p not in self.ids]
        if len(self.ids) + len(new) > self.kept:
            self.ids = {}
            new = list(set().union(*(c for c in cut if c)))
        self.ids.update((p, self._piece(p)) for p in new)
        whole = iter(self._library([t for t, c in zip(texts, cut) if c is None]))
        return [next(whole) if c is None else b"".join(map(self.ids.__getitem__, c)) for c in cut]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of a file, loaded once."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
