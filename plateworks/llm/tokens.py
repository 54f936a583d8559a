"""Token ids of a public tokenizer, computed word by word with memoisation.

``encode`` returns exactly what the tokenizers library returns for the whole text. The
vocabulary splits text by a published pattern before it merges bytes, and merges never
cross a split, so each distinct piece needs merging once; the library's own merge model
does that. Texts with characters beyond U+024F go through the library whole, because
there the classes of letters and digits depend on the library's Unicode version.
"""

from __future__ import annotations

import array
import functools
import re
import sys

import numpy as np

#: Distinct pieces of a generation that a worker remembers (some 200 bytes each); there are two.
MEMO_PIECES = 150_000

# Letters, digits and white space up to U+024F, as the published pattern sees them.
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_DIGITS = "0-9²³¹¼-¾"
_SPACES = "\t-\r \u0085 "
_PIECES = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[{_DIGITS}]+| ?[^{_SPACES}{_LETTERS}{_DIGITS}]+"
    f"|[{_SPACES}]+(?![^{_SPACES}])|[{_SPACES}]+"
)
_BEYOND = re.compile("[^\0-ɏ]")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[int, str]:
    """The published printable letter of each byte: itself where printable, else the next from U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(0x100 + k) for k, b in enumerate(rest)}


class _Memo(dict):
    """Ids by piece, in two generations: when the young one is full it becomes the old one, from which pieces that come again move on."""

    def __init__(self, model, letters):
        self.model, self.letters, self.old = model, letters, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            shown = piece.encode().decode("latin1").translate(self.letters)
            ids = array.array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()
        if len(self) >= MEMO_PIECES:
            self.old = dict(self)
            self.clear()
        self[piece] = ids
        return ids


class Encoder:
    """Encodes texts to little-endian unsigned 32-bit ids."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.memo = _Memo(self.tokenizer.model, _byte_letters())
        assert sys.byteorder == "little" and array.array("I").itemsize == 4

    def encode(self, text: str) -> bytes:
        if _BEYOND.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        return b"".join(map(self.memo.__getitem__, _PIECES.findall(text)))


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)



def id_type(path: str) -> str:
    """The narrowest unsigned type that holds every id of the vocabulary."""
    return "<u2" if encoder(path).vocabulary <= 1 << 16 else "<u4"
