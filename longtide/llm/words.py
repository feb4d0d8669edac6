"""Words of a text as they are compared: without case, punctuation, markup, look-alikes and invisible characters."""

from __future__ import annotations

import html
import re
import unicodedata

import numpy as np
import xxhash

# Letters of other scripts that look like Latin ones.
LOOKALIKES = str.maketrans({
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h", "в": "b", "к": "k", "м": "m", "н": "h", "т": "t", "ӏ": "l", "ո": "n", "ց": "g", "ԛ": "q", "ԝ": "w",
    "α": "a", "ο": "o", "ρ": "p", "ν": "v", "ι": "i", "κ": "k", "τ": "t", "υ": "u", "χ": "x", "η": "n", "ε": "e", "γ": "y", "ω": "w", "ı": "i", "ɑ": "a", "ɡ": "g", "ⅼ": "l",
})
_TAG = re.compile(r"<!--.*?-->|</?[a-zA-Z][^<>]{0,200}>", re.S)
_LINK = re.compile(r"!?\[([^\[\]]*)\]\([^()\s]*\)")
_BROKEN = re.compile(r"(?<=[^\W\d_])[-­‐]\n[ \t>]*(?=[^\W\d_])")
_THOUSANDS = re.compile(r"(?<![\d.,])(\d{1,3})((?:[ \u00a0\u2009\u202f]\d{3})+)(?!\d)")
_MAY_BREAK, _MAY_GROUP, _DIGITS = re.compile(r"[-\u00ad\u2010]\n"), re.compile(r"\d[ \u00a0\u2009\u202f]\d{3}"), re.compile(r"\D")


class _Folding(dict):
    """Code point -> what is left of it: its compatibility form without marks, invisible characters and punctuation, in lower
    case, look-alikes as the Latin letter. Filled in as characters occur; there are no more than code points."""

    def __missing__(self, point: int) -> str:
        parts = (c for c in unicodedata.normalize("NFKD", chr(point)) if unicodedata.category(c) not in ("Cf", "Mn", "Me"))
        out = "".join(parts).lower().translate(LOOKALIKES)
        self[point] = out = "".join(c for c in out if c.isalnum() or c.isspace())
        return out


_FOLD = _Folding()


def words_of(text: str | None) -> list[str]:
    """The words of a text: markup, entities and links resolved, compatibility forms and look-alikes folded, invisible
    characters and punctuation dropped (32.6 and 326 are the same word), lower case. Null and empty texts have none."""
    if not text:
        return []
    if "<" in text:
        text = _TAG.sub(" ", text)
    if "&" in text:
        text = html.unescape(text)
    if "](" in text:
        text = _LINK.sub(r"\1", text)
    if _MAY_BREAK.search(text):
        text = _BROKEN.sub("", text)
    if _MAY_GROUP.search(text):
        text = _THOUSANDS.sub(lambda m: _DIGITS.sub("", m[0]), text)
    return text.translate(_FOLD).split()


_SENTENCE = re.compile(r"(?<=[.!?])[\"'”’)]*\s+|\n+")


def sentences_of(text: str | None) -> list[str]:
    """Sentences of a text, in order, each as it stands."""
    return [s for s in _SENTENCE.split(text or "") if s.strip()]


def word_id(word: str) -> int:
    """A 63-bit number of a word, never 0; the same in every process."""
    return (xxhash.xxh3_64_intdigest(word) >> 1) or 1


class WordIds(dict):
    """word -> ``word_id`` of words that ``wanted`` may hold, 0 for others. ``wanted``: a bitmap of 2 ** k bits by the low bits of ids; a
    word that shares its bit with a wanted one keeps its id, which does no harm. Emptied when it has grown large."""

    MOST = 2_000_000

    def __init__(self, wanted: np.ndarray):
        self.bits, self.mask = wanted, len(wanted) * 8 - 1

    def __missing__(self, word: str) -> int:
        if len(self) > self.MOST:
            self.clear()
        n = word_id(word)
        at = n & self.mask
        self[word] = n = n if self.bits[at >> 3] >> (at & 7) & 1 else 0
        return n

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))


def bitmap(ids: np.ndarray, bits: int) -> np.ndarray:
    """The ids' low bits as a bitmap of ``bits`` (a power of two) bits."""
    at = ids & (bits - 1)
    out = np.zeros(bits, dtype=bool)
    out[at] = True
    return np.packbits(out, bitorder="little")
