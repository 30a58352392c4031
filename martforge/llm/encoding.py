"""Whole texts to token ids with the ``tokenizers`` library inside tasks.

The byte-level and the word-end vocabularies split a text by a fixed pattern
before merging, so its ids are the ids of the pattern's pieces in order. Pieces
repeat; each Python worker keeps the ids of the ``MEMO`` pieces (or as many as asked for) used last and has
the library's model merge the others. Texts with characters for which Python's
classes differ from the library's, and texts that normalisation would change
across pieces, go to the library whole.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from array import array
from collections.abc import Callable

from martforge.llm.common import HELD

#: Pieces kept per Python worker, about 120 MB.
MEMO = 600_000
#: The split patterns of the two vocabularies, in Python's classes.
_SPACED = re.compile(r"'(?:s|t|re|ve|m|ll|d)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
_BARE = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[^\W\d_]+|\d|(?:[^\s\w]|_)+")
#: Separators that are white space to Python alone, and what lies beyond U+FFFF.
_CONTROLS, _FAR = "\x1c\x1d\x1e\x1f", re.compile("[\U00010000-\U0010ffff]")
_ENCODERS: dict[tuple[str, int | None], Encoder] = {}
HELD.append(_ENCODERS.clear)


def _odd(lowers: bool) -> re.Pattern:
    """Characters that Python counts to another class than Unicode's L, N and White_Space do, up to U+FFFF.

    If the vocabulary lower-cases, also those whose lower case is several characters or depends on their neighbours.
    """
    odd = []
    for code in range(1 << 16):
        c = chr(code)
        kind, word = unicodedata.category(c), c.isalnum()
        if (word and not c.isdecimal() and kind[0] != "L") or (not word and kind[0] in "LN") or lowers and (len(c.lower()) > 1 or c == "\u03a3"):
            odd.append(re.escape(c))
    return re.compile(f"[{''.join(odd)}]")


def _byte_letters() -> str:
    """The letter by which byte-level vocabularies write each byte: itself if visible, else the next from U+0100 on."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in visible]
    return "".join(chr(b) if b in visible else chr(256 + hidden.index(b)) for b in range(256))


class Memo(dict):
    """Ids of the pieces used of late, made when first asked for unless ``older`` has them.

    When it holds half of MEMO, it becomes the older one of a new memo.
    """

    def __init__(self, make: Callable[[str], bytes], older: dict[str, bytes]):
        super().__init__()
        self.make, self.older = make, older

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = self.make(piece)
        self[piece] = ids
        return ids


class Encoder:
    def __init__(self, path: str, most: int | None = None):
        self.most = most
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True  # such strings in a text are ordinary text
        with open(path, encoding="utf-8") as f:
            plan = json.load(f)
        cuts = json.dumps(plan.get("pre_tokenizer") or {})
        self.normal = bool(plan.get("normalizer"))
        if plan["model"].get("end_of_word_suffix") and "Removed" in cuts:
            self.pieces = _BARE
        elif '"use_regex": true' in cuts and '"add_prefix_space": false' in cuts and not self.normal:
            self.pieces = _SPACED
        else:
            self.pieces = None
        self.odd = _odd(self.normal)
        self.letters = _byte_letters()
        self.model = self.library.model
        self.memo = Memo(self.piece, {})

    def whole(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts from the library (array codes: unsigned, native 32 bits, little-endian here)."""
        return [array("I", x.ids).tobytes() for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def piece(self, text: str) -> bytes:
        """Ids of one piece: the library's merges alone, as nothing is left to normalise or split."""
        written = text if text.isalnum() and text.isascii() else text.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(written)]).tobytes()

    def cut(self, text: str) -> list[str] | None:
        """The pieces of a text, normalised, or None if it has to be encoded whole."""
        if self.pieces is None or any(c in text for c in _CONTROLS):
            return None
        if not text.isascii():
            if _FAR.search(text) or self.odd.search(text) or (self.normal and not unicodedata.is_normalized("NFC", text)):
                return None
        return self.pieces.findall(text.lower() if self.normal else text)

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text; null is empty."""
        out = []
        for text in texts:
            pieces = self.cut(text or "")
            if len(self.memo) > (self.most or MEMO) // 2:
                self.memo.older = {}
                self.memo = Memo(self.piece, self.memo)
            out.append(self.whole([text])[0] if pieces is None else b"".join(map(self.memo.__getitem__, pieces)))
        return out


def encoder(path: str, most: int | None = None) -> Encoder:
    """The encoder of this Python worker, loaded once; it keeps ``most`` pieces, or MEMO."""
    if (path, most) not in _ENCODERS:
        _ENCODERS[path, most] = Encoder(path, most)
    return _ENCODERS[path, most]
