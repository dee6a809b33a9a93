"""Token ids of whole texts with a public tokenizer; a piece seen before is looked up."""

from __future__ import annotations

import itertools
import os
import re
from array import array

import numpy as np

#: Bytes of pieces that a Python worker remembers, about; others are encoded each time they occur.
KEPT_BYTES, ENTRY_BYTES = 128 << 20, 180

_TWO_SPACES, _PUNCTUATION = re.compile(r"\s\s|\0"), re.compile(r"[\W_][.,]")
_CUT = re.compile(r"(?<=\S)(?= \S)")


def _byte_chars() -> dict[int, int]:
    """Characters that byte-level BPE writes for bytes: printable Latin-1 ones stand for themselves, the others follow U+0100 on."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    hidden = [b for b in range(256) if b not in shown]
    return {b: b for b in shown} | {b: 256 + i for i, b in enumerate(hidden)}


_BYTE_CHARS = _byte_chars()


def pieces(text: str) -> list[str]:
    """Parts whose ids, one after another, are those of the text.

    Holds for byte-level BPE over words with their leading space and for word BPE
    without spaces: both first take runs of letters, of other visible characters or of
    white space apart, so no token (nor normalisation) spans a cut between a visible
    character and a single white space behind it, between a line break and the word
    behind it, or between a letter or digit and a stop or comma.
    """
    if text[:1].isspace() or text[-1:].isspace() or _TWO_SPACES.search(text):
        return _CUT.split(text)
    text = text.replace(" ", "\0 ").replace("\n", "\0\n\0")
    if not _PUNCTUATION.search(text.replace("\0", "")):
        text = text.replace(".", "\0.").replace(",", "\0,")
    return text.split("\0")


def _sound(piece: str) -> bool:
    """Whether cuts around the piece hold wherever it occurs, but perhaps before a stop or comma."""
    core = piece[1:] if piece[:1] == " " else piece
    return piece == "\n" or (core != "" and not core[0].isspace() and not core[-1].isspace() and not _TWO_SPACES.search(piece))


class Encoder:
    """Ids as little-endian unsigned 32-bit integers, equal to those of ``Tokenizer.encode``."""

    _by_path: dict[str, Encoder] = {}

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}  # sound pieces that end in a letter or digit, stops, commas and line breaks
        self.other: dict[str, bytes] = {}  # pieces that don't stand where a stop or comma follows, or of texts not cut at all spaces
        self.kept = 0
        self.direct = self._way()

    @classmethod
    def of(cls, path: str) -> Encoder:
        """One per Python worker, so that its pieces serve all the worker's tasks."""
        if path not in cls._by_path:
            cls._by_path[path] = cls(path)
        return cls._by_path[path]

    @classmethod
    def forget(cls) -> None:
        """Frees the pieces of all tokenizers of the worker; the tokenizers stay."""
        for encoder in cls._by_path.values():
            encoder.known, encoder.other, encoder.kept = {}, {}, 0

    def _word(self, piece: str) -> bytes | None:
        """Ids of a word of Latin letters, perhaps after a space, by the tokenizer's model alone; None for other pieces.

        Such a word is one unit of what the model sees: normalising lower-cases it at most
        and pre-tokenising leaves it whole, its bytes written as characters.
        """
        core = piece[1:] if piece[:1] == " " else piece
        if not core.isalpha() or not (core.isascii() or (max(core) < "\u0250" and "\u0130" not in core)):
            return None
        text = (core if self.drops_space else piece) if not self.lowers else (core if self.drops_space else piece).lower()
        text = text.replace(" ", "\u0120") if text.isascii() else text.encode().decode("latin-1").translate(_BYTE_CHARS)
        return array("I", [t.id for t in self.tokenizer.model.tokenize(text)]).tobytes()

    def _way(self) -> bool:
        """Finds how words reach the model, by words that the whole tokenizer has encoded; False where no way fits."""
        probes = [" Hello", "hello", " WORLDS", "Unbelievably", " \u00e9t\u00e9", "\u00c0B\u00f1", " \u0141\u00f3d\u017a", " qxzvkjw"]
        want = [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch(probes, add_special_tokens=False)]
        for self.lowers in (False, True):
            for self.drops_space in (False, True):
                try:
                    if [self._word(p) for p in probes] == want:
                        return True
                except Exception:  # a model that takes no such units  # noqa: BLE001
                    return False
        return False

    def _new(self, parts: list[str], where: dict[str, bytes]) -> dict[str, bytes]:
        """Ids of parts, each encoded as a text of its own; kept while there is room."""
        found = {p: self._word(p) for p in parts} if self.direct else dict.fromkeys(parts)
        rest = [p for p, ids in found.items() if ids is None]
        for at in range(0, len(rest), 2048):
            some = rest[at : at + 2048]
            e = self.tokenizer.encode(some, is_pretokenized=True, add_special_tokens=False)
            of = np.array(e.word_ids, np.int64)  # which of the parts, ascending
            ids, cuts = np.array(e.ids, "<u4").tobytes(), (4 * np.searchsorted(of, np.arange(len(some) + 1))).tolist()
            found.update((p, ids[i:j]) for p, (i, j) in zip(some, itertools.pairwise(cuts), strict=True))
        if self.kept < KEPT_BYTES:
            self.kept += ENTRY_BYTES * len(parts) + sum(map(len, parts)) + sum(map(len, found.values()))
            where.update(found)
        return found

    def _join(self, parts: list[str]) -> bytes:
        """Ids of any parts of a text, one after another."""
        out = list(map(self.other.get, parts))
        if None in out:
            found = self._new(list(dict.fromkeys([p for p, ids in zip(parts, out, strict=True) if ids is None])), self.other)
            out = [found[p] if ids is None else ids for p, ids in zip(parts, out, strict=True)]
        return b"".join(out)

    def __call__(self, text: str | None) -> bytes:
        """Cuts the text everywhere first; only pieces not yet known are looked at, as they tell whether the cuts hold."""
        if not text:
            return b""
        if "\0" in text or ".." in text or ".," in text or ",." in text or ",," in text:
            return self._join(pieces(text))
        parts = text.replace(" ", "\0 ").replace("\n", "\0\n\0").replace(".", "\0.").replace(",", "\0,").split("\0")
        out = list(map(self.known.get, parts))
        if None in out:
            lost = [i for i, ids in enumerate(out) if ids is None]
            new = list(dict.fromkeys([parts[i] for i in lost]))
            odd = [p for p in new if not p[-1:].isalnum() and p not in (".", ",", "\n")]
            if odd and (not all(map(_sound, odd)) or _PUNCTUATION.search(text)):
                return self._join(pieces(text))
            if not all(map(_sound, new)):
                return self._join(pieces(text))
            found = self._new([p for p in new if p not in self.other and p not in odd], self.known)
            lacking = [p for p in odd if p not in self.other]
            found |= self._new(lacking, self.other)
            for i in lost:
                p = parts[i]
                out[i] = found[p] if p in found else self.other[p]
        return b"".join(out)
