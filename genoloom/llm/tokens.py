"""Token ids of whole texts with a public ``tokenizers`` vocabulary.

The vocabularies used here treat white space as a hard boundary: normalisation and
pre-tokenisation never join what ASCII white space separates. So a text's ids are the ids of its
white-space pieces one after another, and each worker looks a piece up once and remembers it. A
piece of Latin-1 letters with closing marks behind it is two pre-tokens at most; it is given to the
vocabulary's model as such, which saves the general normaliser. Everything else takes the whole
tokeniser. ``tests/llm`` holds this against encoding whole texts.
"""

from __future__ import annotations

import codecs
import ctypes
import gc
import os
from array import array
from collections.abc import Callable, Iterable, Iterator
from itertools import filterfalse

import numpy as np

REMEMBERED = 500_000  # pieces a worker remembers; bounds its memory, not the result
SLICE_CHARS = 2_000_000  # texts of about this length are split into pieces at a time


CLOSING = b".,;:!?"  # marks that a word of letters may end with in the short way


def _byte_letters() -> str:
    """The byte-level alphabet: printable bytes stand for themselves, the others follow from U+0100."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in shown)}
    return "".join(others.get(b, chr(b)) for b in range(256))


class PieceEncoder:
    """Encode texts through a remembered table of white-space pieces."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        small = self._tokenizer.get_vocab_size() <= 1 << 16
        self.width = np.dtype("<u2" if small else "<u4")
        self._code = "H" if small else "I"
        self._known: dict[bytes, bytes] = {}
        self._remembered = remembered
        self._letters = _byte_letters()
        self._marks: dict[bytes, bytes] = {}

    def _word(self, letters: bytes) -> bytes:
        """Ids of one pre-token in lower case."""
        shown = codecs.charmap_decode(letters, "strict", self._letters)[0]
        return array(self._code, [t.id for t in self._model.tokenize(shown)]).tobytes()

    def _learn(self, pieces: set[bytes]) -> None:
        fresh = list(filterfalse(self._known.__contains__, pieces))
        if len(self._known) + len(fresh) > self._remembered:
            self._known, fresh = {}, pieces
        known, marks, rest = self._known, self._marks, []
        for piece in fresh:
            letters = piece.rstrip(CLOSING)
            if not letters.isalpha():  # bytes: ASCII letters only
                text = letters.decode()
                if not text.isalpha() or max(text) >= "\u0100":
                    rest.append(piece)
                    continue
                ids = known.get(letters) or self._word(text.lower().encode())
            else:
                ids = known.get(letters) or self._word(letters.lower())
            if closing := piece[len(letters) :]:
                if closing not in marks:
                    if len(marks) > 10_000:
                        marks.clear()
                    marks[closing] = self._word(closing)
                ids += marks[closing]
            known[piece] = ids
        for at in range(0, len(rest), 20_000):
            part = rest[at : at + 20_000]
            found = self._tokenizer.encode_batch_fast([p.decode() for p in part], add_special_tokens=False)
            known.update((p, array(self._code, e.ids).tobytes()) for p, e in zip(part, found, strict=True))

    def encode(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """Ids of each text, a null as the empty text; texts are taken in slices to bound memory.

        A-Z are lower-cased first, as the vocabulary does anyway, unless the text may hold the name of
        a special token, which is told by its letters.
        """
        for part in slices(texts):
            pieces = [t.encode().split() if "<|" in t else t.encode().lower().split() for t in part]
            self._learn(set().union(*pieces))
            known = self._known.__getitem__
            for p in pieces:
                yield np.frombuffer(b"".join(map(known, p)), self.width)


def values(column) -> Iterator:
    """Values of an Arrow column one by one, so that a batch of texts is not held twice."""
    return (v.as_py() for v in column)


def slices(texts: Iterable[str | None], chars: int = SLICE_CHARS) -> Iterator[list[str]]:
    """Consecutive texts of about ``chars`` characters together; a longer text comes alone."""
    part, size = [], 0
    for t in texts:
        t = t or ""
        if part and size + len(t) > chars:
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t)
    if part:
        yield part


_HELD: dict[tuple, object] = {}


def held(make: Callable | None = None, *args):
    """What a worker remembers between tasks: ``make(*args)``, or nothing.

    One thing at a time, so the tables of an earlier stage do not add to a later one's memory; what
    they leave goes back to the system where the C library can do that.
    """
    key = (make, *args)
    if key not in _HELD:
        _HELD.clear()
        gc.collect()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
            trim(0)
        _HELD[key] = make(*args) if make else None
    return _HELD[key]


def encoder(path: str) -> PieceEncoder:
    """The worker's encoder of a vocabulary."""
    return held(PieceEncoder, path)
