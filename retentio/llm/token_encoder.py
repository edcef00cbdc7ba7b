"""Token ids of whole texts by the tokenizers library, one piece at a time.

A text is cut at white space; a piece's ids do not depend on its
neighbours, so recent pieces and words are remembered (a cache only: a miss
gives the same ids). Plain pieces, of code points below U+0250, are cut
into words here and each word goes to the library's BPE model. Any other
piece (later letters, marks, special tokens) goes through the library whole.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache

from tokenizers import Tokenizer

from .bpe import _ODD, _SPACES, PLAIN, byte_symbols

#: entries of a worker's memo, in two generations; some 200 bytes each
MEMO = 1_000_000
#: longer pieces are not remembered
LONGEST = 64
#: a bit mask: places of the filter that tells a piece's first sight
SEEN = (1 << 23) - 1

# Fixed value: the words of the tokenizer file's Split pattern, written for
# code points below U+0250, where Python and the library know the same letters.
_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_²³¹¼½¾]+|[\d²³¹¼½¾]|(?:[^\s\w]|_)+")
_BYTES = dict(enumerate(byte_symbols()))


class TokenEncoder:
    """Encodes as Tokenizer.encode(text, add_special_tokens=False).ids."""

    def __init__(self, document: str, memo: int = MEMO):
        self.library = Tokenizer.from_str(document)
        self.library.no_truncation()
        self.library.no_padding()
        self.bpe = self.library.model
        self.half = max(1, memo // 2)
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.seen = bytearray(SEEN + 1)

    def _put(self, key: str, ids: bytes) -> None:
        """Remember what is seen for the second time: half of all different
        pieces come once."""
        at = hash(key) & SEEN
        if not self.seen[at]:
            self.seen[at] = 1
            return
        if len(key) > LONGEST:
            return
        if len(self.recent) >= self.half:
            self.older = dict(self.recent)
            self.recent.clear()
        self.recent[key] = ids

    def _word(self, word: str) -> bytes:
        ids = self.recent.get(word) or self.older.get(word)
        if ids is None:
            symbols = word if word.isascii() else word.encode().decode("latin-1").translate(_BYTES)
            ids = array("I", [t.id for t in self.bpe.tokenize(symbols)]).tobytes()
        self._put(word, ids)
        return ids

    def piece(self, piece: str) -> bytes:
        """Ids of a stretch without white space."""
        ids = self.older.get(piece)
        if ids is None:
            if "<|" in piece or not PLAIN.fullmatch(piece):
                ids = array("I", self.library.encode(piece, add_special_tokens=False).ids).tobytes()
            else:
                lower = piece.lower()
                if lower.isalpha():
                    ids = self._word(lower)
                else:
                    ids = b"".join(map(self._word, _WORDS.findall(lower)))
        self._put(piece, ids)
        return ids

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        pieces = filter(None, _SPACES.split(text)) if _ODD.search(text) else text.split()
        known, new = self.recent.get, self.piece
        return b"".join([known(p) or new(p) for p in pieces])


@lru_cache(maxsize=2)
def encoder_of(document: str) -> TokenEncoder:
    return TokenEncoder(document)
