"""Garbled text from wrong character encodings (problem 2).

Every candidate decoding of a value is given a description length: what it takes to say which chain of encodings was
undone, and what the words of the result cost under per-language zstandard dictionaries. The shortest description wins;
if that is the text as it stands, it is left unchanged.

A zstandard frame has whole bytes only, which cannot tell letters of a short unseen name apart (u with a double
acute or with a tilde cost two bytes either way). The length of a word is therefore its compressed size plus a code length
of its letter pairs under the same language, both learnt from the same words."""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.skew import fits_broadcast, spread
from ..session import ship, staged, widened

# The letters beyond ASCII of each language's alphabet (lower case).
ALPHABETS = {
    "de": "äöüß",
    "fr": "àâæçèéêëîïôœùûüÿ",
    "es": "áéíñóúü",
    "pt": "àáâãçéêíóôõú",
    "et": "äöõüšž",
    "pl": "ąćęłńóśźż",
    "cs": "áčďéěíňóřšťúůýž",
    "hu": "áéíóöőúüű",
    "ro": "ăâîșțşţ",
    "tr": "âçğıiîöşüû̇",
    "vi": "àáâãèéêìíòóôõùúýăđĩũơưạảấầẩẫậắằẳẵặẹẻẽếềểễệỉịọỏốồổỗộớờởỡợụủứừửữựỳỵỷỹ",
    "nordic": "åäöøæ",
}
# Code blocks of the other scripts.
SCRIPTS = {"el": "Ͱ-Ͽἀ-῿", "ru": "А-яЁё", "ar": "؀-ۿ", "cjk": "々぀-ヿ㐀-䶿一-鿿", "ko": "가-힣"}
#: Signs that belong to no language and stand in clean text.
SIGNS = "Ø–—‑‐’‘“”„…€£¥§°±×·•«»¡¿½¼¾²³µ©®™№‰−   、。（）：，・％"
# Words of one letter beyond ASCII in these languages.
ONE_LETTER = set("àáéèőöüôởувксоиая")
# Names of encodings. What a text was wrongly read as, and what it was written in.
READ_AS = ["cp1252", "latin-1", "iso8859-15", "cp1250", "iso8859-2", "cp1251", "cp1254", "cp1257", "cp1253", "mac-roman", "cp437", "cp850", "cp852", "koi8-r", "cp866", "iso8859-5", "gb18030", "big5", "shift_jis", "euc-kr"]
WRITTEN_IN = ["utf-8", "cp1252", "cp1250", "cp1251", "cp1253", "cp1254", "cp1256", "cp1257", "iso8859-2", "iso8859-5", "koi8-r", "cp866", "mac-roman", "cp437", "cp850", "cp852", "gb18030", "shift_jis", "euc-jp", "big5", "cp1258"]
#: Readers whose undefined bytes were often lost.
LOSSY = {"cp1252", "latin-1"}
MULTIBYTE = {"gb18030", "big5", "shift_jis", "euc-kr", "euc-jp", "utf-8"}

#: Words per language from which the dictionaries are built: the most frequent ones over the whole catalogue.
MODEL_WORDS = 6_000
#: Longer words are priced but not learnt.
LEARNT_CHARS = 60
#: Parts of a language whose words are ranked at first.
RANK_PARTS = 64
#: A language with less than this share of the words is taken for chance.
MIN_SHARE = 0.004
#: Bits of a mark that stands for bytes which were lost on the way.
LOST_BITS, LONE_LOST_BITS = 11.0, 6.0
#: A word is known, and priced by its frequency, from this share of all counted words (and from two) on.
KNOWN_SHARE = 4e-5
#: Bits of a word of one letter that was never seen.
LONE_BITS = 6.0
#: Bits of a blank that does not break the line.
SPACE_BITS = 5.0
#: What a word costs: bits for each byte of its zstandard frame, for each letter that a language lacks, for each letter of an unseen
#: script beside ASCII letters, and the weight of its letter pairs' code.
BYTE_BITS, MISSING_BITS, MIXED_BITS, LETTER_WEIGHT = 4.0, 6.0, 12.0, 0.7
#: Bits that name a chain: one undone step of UTF-8 read as a single-byte encoding, or of one such encoding for another.
CHAIN_BITS, BOTH_KINDS_BITS = {True: 5.0, False: 7.0}, 6.0
#: Bits that name a chain which its source is known for; bits and words that make it known, and the most that one word counts.
USUAL_BITS, USUAL_GAIN, USUAL_WORDS, MOST_BITS = 1.0, 40.0, 4, 20.0
#: A word that one step turns into one so many times as frequent is not learnt.
GARBLED_TIMES, LONE_TIMES = 15, 6
#: Characters that are priced at once. A longer run without blanks is decoded whole; its price is the sum over such parts.
LONG_WORD = 300
#: Steps of a chain at most.
STEPS = 4

_SPLIT = re.compile(r"([ \t\r\n()\[\],:;/|=]+)")
_CONTROL = re.compile("[\x80-\x9f�]")
#: Sequences of UTF-8, the last byte or two of which may be lost; and bytes that are no part of one.
_SEQUENCE, _STRAY = re.compile(rb"[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{1,2}|[\xf0-\xf4][\x80-\xbf]{1,3}"), re.compile(rb"[\x80-\xff]")
_COMPLETE = re.compile(rb"[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3}")
#: A sign between letters that words do not have there.
_MISPLACED = re.compile("[A-Za-z][" + re.escape("".join(c for c in SIGNS if c not in "–—‑‐’‘·\u00ad\u00a0\u2009\u202f\u3000")) + "][A-Za-z]")
#: Two letters beyond ASCII in a row, without which nothing is UTF-8 read as something else.
_PAIR = re.compile("[^\x00-\x7f]{2}")
WORD_SPLIT_JVM = r"[ \t\r\n()\[\],:;/|=]+"


def language_of(word: str) -> str | None:
    """The first language whose letters a clean word could be made of; ``signs`` for a word of nothing but signs, None for
    a mixture of scripts or a case that changes back to capitals."""
    letters = [c for c in word if c.isalpha() and not c.isascii() and c not in SIGNS]
    if any(not c.isalpha() and not c.isascii() and c not in SIGNS and not "\u0300" <= c <= "\u036f" and c != "\u00ad" for c in word):
        return None
    core = word.strip("“”„«»‘’'\"‑–—\u00a0\u2009¿¡")
    if letters and any(not (c.isalpha() and c not in SIGNS or c.isdecimal()) and not "\u0300" <= c <= "\u036f" and c not in "-‑–'’.%&_（）·、\u00ad" for c in core):
        return None
    plain = any(c.isalpha() and c.isascii() for c in word)
    if not letters:
        return None if _MISPLACED.search(word) else "signs"
    if re.search(r"[^\W\d_]", word) and any(a.islower() and b.isupper() for a, b in zip(word, word[1:], strict=False)):
        return None
    low = {c.lower()[0] for c in letters}
    for name, block in SCRIPTS.items():
        if all(re.match(f"[{block}]", c) for c in low):
            return None if plain else name
    for name, alphabet in ALPHABETS.items():
        if low <= set(alphabet):
            return name
    return None


class Lengths:
    """Description lengths of words, in bits, under dictionaries trained from ``words``: language -> word -> count."""

    def __init__(self, words: dict[str, dict[str, int]]):
        size = sum(map(len, words.values()))
        words = {lang: w for lang, w in words.items() if len(w) >= MIN_SHARE * size}
        self.langs = sorted(words)
        self.total, self.count = sum(sum(w.values()) for w in words.values()), Counter()
        for w in words.values():
            self.count.update(w)
        least = max(2, KNOWN_SHARE * self.total)
        self.count = {w: n for w, n in self.count.items() if n >= least}
        self.zstd, self.empty, self.pairs, self.known = {}, {}, {}, {}
        self.alphabet = set(SIGNS) | {chr(i) for i in range(128)}
        for lang, counts in words.items():
            ordered = sorted(counts, key=lambda w: (counts[w], w))  # zstandard finds what stands last at the least cost
            d = zstandard.ZstdCompressionDict(" ".join(ordered).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.zstd[lang] = zstandard.ZstdCompressor(level=19, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False)
            self.empty[lang] = len(self.zstd[lang].compress(b""))
            self.pairs[lang] = _pair_bits(counts)
            self.known[lang] = {c for w in counts for c in w + w.lower() + w.upper()}
            self.alphabet |= self.known[lang]
        self._priced = lru_cache(200_000)(self._short)

    def word(self, word: str, cap: float = math.inf) -> float:
        """The bits of a word of any length, or ``cap`` if they are not less; a long run without blanks is the sum of its parts."""
        if len(word) <= LONG_WORD:
            return self._priced(word) if cap == math.inf else self._short(word, cap)
        return sum(self._priced(word[i : i + LONG_WORD]) for i in range(0, len(word), LONG_WORD))

    def _short(self, word: str, cap: float = math.inf) -> float:
        """The least of the languages that have all its letters; any other language pays for each letter it lacks."""
        if word == "�":
            return LONE_LOST_BITS
        if len(pieces := [x for x in re.split("[\u00a0\u2009\u202f]", word) if x]) > 1 or (pieces and pieces[0] != word):
            return sum(map(self.word, pieces)) + SPACE_BITS * (len(word) - sum(map(len, pieces)))
        known_bits = 3.0 + math.log2(self.total / n) if (n := self.count.get(word)) else math.inf
        best, found = min(known_bits, cap), known_bits < math.inf
        extra = LOST_BITS * word.count("�")
        word = word.replace("�", "")
        raw, foreign = word.encode(), [c for c in word if not c.isascii()]
        if len(word) == 1 and word not in SIGNS and not found:
            extra += LONE_BITS
        if len(foreign) < len(word) and any(c.isascii() and c.isalpha() for c in word):
            extra += MIXED_BITS * sum(c.isalpha() and c not in self.alphabet and not ("\u00c0" <= c < "\u0250" or "\u1e00" <= c < "\u1f00") for c in foreign)
        if not word.islower():
            extra += LETTER_WEIGHT * 6 * sum(a.islower() and b.isupper() for a, b in zip(word, word[1:], strict=False))
        x = f"^{word.lower()}$"
        two = [x[i : i + 2] for i in range(len(x) - 1)]
        for missing, lang in sorted((sum(c not in self.known[lang] for c in foreign), lang) for lang in self.langs):
            if missing and missing < len(foreign) and found:
                continue
            found, fixed = True, MISSING_BITS * missing + extra
            pair, after, letter, unseen = self.pairs[lang]
            bits, limit = 0.0, (best - fixed) / LETTER_WEIGHT
            for g in two:
                b = pair.get(g)
                bits += after.get(g[0], _LOG3) + letter.get(g[1], unseen) if b is None else b
                if bits >= limit:
                    break
            else:
                best = min(best, fixed + LETTER_WEIGHT * bits + BYTE_BITS * max(0, len(self.zstd[lang].compress(raw)) - self.empty[lang]))
        return best if found else min(cap, 8.0 * len(raw))  # nothing was learnt


_LOG3 = math.log2(3)


def _pair_bits(counts: dict[str, int]) -> tuple[dict[str, float], dict[str, float], dict[str, float], float]:
    """The code of letter pairs in bits: of pairs that were seen, and the two parts (letter before, letter) and the part of a new
    letter of which those of other pairs are made."""
    after: dict[str, Counter] = defaultdict(Counter)
    for w, n in counts.items():
        x = f"^{w.lower()}$"
        for a, b in zip(x, x[1:], strict=False):
            after[a][b] += 1 + math.log2(n)
    total = sum((c for c in after.values()), Counter())
    n = sum(total.values())
    share = {b: (c + 0.02) / (n + 4) for b, c in total.items()}
    sums = {a: sum(c.values()) for a, c in after.items()}
    pair = {a + b: -math.log2((c + 3 * share[b]) / (sums[a] + 3)) for a, cs in after.items() for b, c in cs.items()}
    return pair, {a: math.log2(c + 3) for a, c in sums.items()}, {b: -math.log2(3 * p) for b, p in share.items()}, -math.log2(3 * 0.02 / (n + 4))


@lru_cache(64)
def _bytes_of(encoding: str) -> dict[str, bytes]:
    """Character -> byte of a single-byte encoding; bytes that it leaves undefined stand for the control characters of the
    same number, as lenient readers take them."""
    out = {}
    for b in range(256):
        try:
            c = bytes([b]).decode(encoding)
        except UnicodeDecodeError:
            c = chr(b)
        out.setdefault(c, bytes([b]))
    for b in range(0x80, 0xA0):
        out.setdefault(chr(b), bytes([b]))
    return out


def undo(word: str, read_as: str, written_in: str) -> str | None:
    """The word before it, written in one encoding, was read as another; None where that cannot be."""
    try:
        raw = word.encode(read_as) if read_as in MULTIBYTE else b"".join(map(_bytes_of(read_as).__getitem__, word))
        out = raw.decode(written_in)
    except (UnicodeError, KeyError):
        return None
    return out if out != word else None


def _lossy(raw: bytes, read_as: str) -> bool:
    """Could these bytes be UTF-8 of which some were lost? A lone first byte of a dash or quotation mark; or sequences enough
    beside stray bytes, which should be first bytes that lost what follows."""
    if raw == b"\xe2":
        return read_as in LOSSY
    sequences, strays = len(_SEQUENCE.findall(raw)), _STRAY.findall(_SEQUENCE.sub(b"", raw))
    if read_as not in LOSSY:
        return sequences >= max(4, 3 * len(strays))
    if sequences < 2 and not _COMPLETE.search(raw):
        return False
    return sequences >= len(strays) or sequences >= 1 and all(0xC2 <= x[0] <= 0xF4 for x in strays)


def steps(word: str, alphabet: set[str], crossed: bool = False, follow: bool = False) -> dict[tuple[str, str], str]:
    """All single steps that give something made of known letters; after a step between single-byte encodings (``crossed``) only those
    to whole UTF-8. A letter by itself says nothing about another letter, nor a sign about a letter; ``follow`` gives what they
    would become all the same. Readers that agree on a word give the same result, each under its name."""
    out, lossy = {}, {}
    seen_raw: dict[bytes, str] = {}
    only_signs = not follow and all(c.isascii() or c in SIGNS for c in word) and not _MISPLACED.search(word)
    for a in READ_AS:
        try:
            raw = word.encode(a) if a in MULTIBYTE else b"".join(map(_bytes_of(a).__getitem__, word))
        except (UnicodeError, KeyError):
            continue
        if raw in seen_raw:
            for found in (out, lossy):
                found.update({(a, b): found[seen_raw[raw], b] for b in WRITTEN_IN if (seen_raw[raw], b) in found and b != a})
            continue
        seen_raw[raw] = a
        for b in WRITTEN_IN[:1] if crossed else WRITTEN_IN:
            if b == a or b != "utf-8" and (a in MULTIBYTE or only_signs):
                continue
            try:
                new = raw.decode(b)
            except UnicodeDecodeError as e:
                if b == "utf-8" and not crossed and a not in MULTIBYTE and _lossy(raw, a):
                    lossy[a, b] = raw.decode(b, "replace")
                elif b in MULTIBYTE and b != "utf-8" and len(raw) > 6 and e.start == len(raw) - 1 and alphabet.issuperset(new := raw[:-1].decode(b)):
                    lossy[a, b] = new + "�"  # the last byte was lost
                continue
            if new == word:
                continue
            if len(word) == len(new) == 1 and new not in SIGNS and not follow:
                continue
            if b == "utf-8" or "\u00a0" not in new and all(c in alphabet or "̀" <= c <= "ͯ" for c in new):
                out[a, b] = new
    return out if any(b == "utf-8" for _, b in out) else out | lossy


Step = tuple[str, str]


def chain_bits(chain: tuple[Step, ...]) -> float:
    """Bits that name a chain; more if its steps are of both kinds."""
    kinds = [b == "utf-8" for _, b in chain]
    return sum(CHAIN_BITS[k] for k in kinds) + (BOTH_KINDS_BITS if len(set(kinds)) > 1 else 0.0)


def chains(word: str, alphabet: set[str], most: int = STEPS) -> dict[tuple[Step, ...], str]:
    """All chains of at most ``most`` steps, each with what it makes of the word. At most one step is between single-byte encodings, as
    two in a row are one or none; any step may cost bits that a later one saves."""
    out: dict[tuple[Step, ...], str] = {}
    front, seen = [((), word, False)], {(word, False)}
    while front:
        later = []
        for chain, text, crossed in front:
            if len(chain) == most or crossed and not _PAIR.search(text):
                continue
            for step, new in steps(text, alphabet, crossed).items():
                longer = (*chain, step)
                out[longer] = new
                state = (new, crossed or step[1] != "utf-8")
                if state not in seen and not new.isascii() and "�" not in new:
                    seen.add(state)
                    later.append((longer, *state))
        front = later
    return out


def gains(word: str, lengths: Lengths) -> dict[tuple[Step, ...], tuple[str, float]]:
    """Every chain that shortens the description of a word: what it makes of it, and the bits saved (the chain not yet paid). A single
    character saves nothing by itself, but follows the words around it."""
    now, out = lengths.word(word), {}
    if len(word) == 1:
        out = {(step,): (new, 0.0) for step, new in steps(word, lengths.alphabet, follow=True).items() if "�" not in new and lengths.word(new, now) < now}
    made = lengths.chains(word)
    price = {new: lengths.word(new, now) for new in set(made.values())}
    for chain, new in made.items():
        if (g := now - price[new]) > 0:
            out[chain] = (new, g)
    return out


def restored(value: str, tables: dict[str, dict[tuple[Step, ...], tuple[str, float]]], usual: frozenset = frozenset()) -> tuple[str, list[Step], float]:
    """The value with the shortest description, the steps that lead to it (none: left unchanged), and the bits saved; ``tables``:
    the gains of its words; ``usual``: chains that its source is known for, which cost little to name. The best chain is undone in
    all words that it shortens; words that it leaves may have another."""
    price = lambda c: USUAL_BITS if c in usual else chain_bits(c)
    parts, steps_, saved = _SPLIT.split(value), [], 0.0
    left = [i for i, w in enumerate(parts) if tables.get(w)]
    while left:
        sums: dict[tuple[Step, ...], float] = defaultdict(float)
        for i in left:
            for chain, (_, g) in tables[parts[i]].items():
                sums[chain] += g
        rank = lambda c: (sums[c] - price(c), -len(c), [(-READ_AS.index(a), -WRITTEN_IN.index(b)) for a, b in c])
        best = max(sums, key=rank)
        if (net := sums[best] - price(best)) <= 0:
            break
        hit = [i for i in left if best in tables[parts[i]]]
        for i in hit:
            parts[i] = tables[parts[i]][best][0]
        left = [i for i in left if i not in set(hit)]
        steps_ += best
        saved += net
    return "".join(parts), steps_, saved


def restore(value: str, lengths: Lengths) -> tuple[str, list[str], float]:
    """``restored`` of a single value, its words priced on the spot."""
    tables = {w: gains(w, lengths) for w in set(_SPLIT.split(value)) if not w.isascii()}
    text, undone, saved = restored(value, tables)
    return text, [f"{a}>{b}" for a, b in undone], saved


def broken(value: str) -> bool:
    """Characters that no publisher writes: controls of the C1 range, and the mark of a byte that could not be read."""
    return bool(_CONTROL.search(value))


class Judge:
    """Letter-pair bits of words as if neither they nor their own count had been learnt: what a frequent word costs by its looks."""

    def __init__(self, words: dict[str, dict[str, int]]):
        self.own = {w: (lang, 1 + math.log2(n)) for lang, ws in words.items() for w, n in ws.items()}
        self.after, self.total, self.known = {}, {}, {}
        for lang, ws in words.items():
            after: dict[str, Counter] = defaultdict(Counter)
            for w, n in ws.items():
                x = f"^{w.lower()}$"
                for p, q in zip(x, x[1:], strict=False):
                    after[p][q] += 1 + math.log2(n)
            self.after[lang] = {p: (c, sum(c.values())) for p, c in after.items()}
            self.total[lang] = sum(after.values(), Counter())
            self.known[lang] = {c for w in ws for c in w + w.lower() + w.upper()}
        self.size = {lang: sum(t.values()) for lang, t in self.total.items()}
        self.alphabet = set(SIGNS) | {chr(i) for i in range(128)} | {c for k in self.known.values() for c in k}

    def bits(self, word: str) -> float:
        x, foreign = f"^{word.lower()}$", [c for c in word if not c.isascii()]
        pairs, before, behind = Counter(zip(x, x[1:], strict=False)), Counter(x[:-1]), Counter(x[1:])
        lang_of, weight = self.own.get(word, (None, 0.0))
        best = 12.0 * len(x)
        for lang, after in self.after.items():
            k, bits = weight if lang == lang_of else 0.0, MISSING_BITS * sum(c not in self.known[lang] for c in foreign)
            for p, q in zip(x, x[1:], strict=False):
                seen, of = after.get(p, ({}, 0.0))
                share = (max(self.total[lang].get(q, 0.0) - k * behind[q], 0.0) + 0.02) / (self.size[lang] + 4)
                bits -= math.log2((max(seen.get(q, 0.0) - k * pairs[p, q], 0.0) + 3 * share) / (max(of - k * before[p], 0.0) + 3))
                if bits >= best:
                    break
            best = min(best, bits)
        return best

    def gains(self, word: str) -> dict[tuple[Step, ...], float]:
        """What every chain would save or cost, at most ``MOST_BITS`` either way."""
        now, made = self.bits(word), chains(word, self.alphabet)
        price = {new: self.bits(new) for new in set(made.values())}
        return {c: max(-MOST_BITS, min(MOST_BITS, now - price[new])) for c, new in made.items() if new != word}


def garble_of_more_frequent(word: str, count: dict[str, int], alphabet: set[str], times: int = GARBLED_TIMES) -> bool:
    """Does one undone step turn the word into one that is ``times`` as frequent, or does it show lost bytes? A garble that occurs
    often enough would otherwise be learnt as a word of its own."""
    if word.lower() in ONE_LETTER:
        return False
    new = steps(word, alphabet).values()
    return "�" in new or max((count.get(x, 0) for x in new), default=0) >= (times if len(word) > 1 else LONE_TIMES) * count[word]


def train(words: dict[str, dict[str, int]]) -> Lengths:
    lengths = Lengths(words)
    lengths.chains = lru_cache(30_000)(lambda w: chains(w, lengths.alphabet))
    return lengths


def _in_worker(token: str, make):
    """The model of this Python worker, kept between its tasks."""
    if token not in _TRAINED:
        _TRAINED.clear()
        _TRAINED[token] = make()
    return _TRAINED[token]


_TRAINED: dict[str, object] = {}


def counted_words(values: DataFrame) -> DataFrame:
    """The words beyond ASCII of ``values`` (``by``, ``value``): ``word``, in how many different values of a source it stands (``n``), and
    the one source that has it (``only``; null if several have)."""
    words = values.filter(F.col("value").rlike("[^\\x00-\\x7F]")).select(F.coalesce("by", F.lit("")).alias("by"), "value").distinct()
    words = words.select("by", F.explode(F.array_distinct(F.split("value", WORD_SPLIT_JVM))).alias("word")).filter(F.col("word").rlike("[^\\x00-\\x7F]"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.when(F.min("by") == F.max("by"), F.min("by")).alias("only"))


def frequent_words(counted: DataFrame, per_language: int = MODEL_WORDS) -> DataFrame:
    """Of each language the ``per_language`` most frequent words of at most ``LEARNT_CHARS`` characters: ``lang``, ``word``, ``n``. Ranked by
    parts of a language first, so that no task sorts all its words."""

    def named(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b["lang"] = b["word"].map(language_of)
            yield b[b["lang"].notna()]

    known = counted.filter(F.char_length("word") <= LEARNT_CHARS).select("word", "n").mapInPandas(named, "word string, n bigint, lang string")
    order = [F.col("n").desc(), F.col("word")]
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("word"), F.lit(RANK_PARTS))).orderBy(*order)
    some = known.withColumn("rn", F.row_number().over(part)).filter(F.col("rn") <= per_language)
    return some.withColumn("rn", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rn") <= per_language).select("lang", "word", "n")


def _by_language(rows) -> dict[str, dict[str, int]]:
    out: dict[str, dict[str, int]] = defaultdict(dict)
    for lang, word, n in rows:
        out[lang][word] = n
    return dict(out)


def usual_chains(counted: DataFrame, shared, token: str) -> DataFrame:
    """Sources that are read wrong as a rule: ``only``, ``chain``, and ``word``, every word that it garbles. Judged by all words that no
    other source has and that stand in two values or more: undoing the chain must make those that it changes shorter on the
    whole, and most of them, and by more than naming it among all sources and chains costs."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        judge = _in_worker("judge" + token, lambda: Judge(shared.value))
        for b in batches:
            got = [(o, w, " ".join(f"{x}>{y}" for x, y in c), g) for o, w in zip(b["only"], b["word"], strict=True) for c, g in judge.gains(w).items()]
            yield pd.DataFrame(got, columns=["only", "word", "chain", "gain"])

    own = counted.filter(F.col("only").isNotNull() & (F.col("n") >= 2) & (F.char_length("word") <= LEARNT_CHARS)).select("only", "word")
    each = staged(widened(own).mapInPandas(run, "only string, word string, chain string, gain double"), "judged")
    per = each.groupBy("only", "chain").agg(F.sum("gain").alias("bits"), F.count_if(F.col("gain") > 0).alias("better"), F.count(F.lit(1)).alias("n"))
    usual = per.filter((F.col("bits") >= USUAL_GAIN) & (F.col("better") >= USUAL_WORDS) & (F.col("better") >= 0.75 * F.col("n"))).select("only", "chain")
    return each.filter("gain > 0").join(usual, ["only", "chain"]).select("only", "chain", "word")


def model_words(counted: DataFrame, per_language: int = MODEL_WORDS) -> tuple[dict[str, dict[str, int]], DataFrame | None]:
    """What the dictionaries are trained on: language -> word -> in how many values it stands, without words that are garbles of
    more frequent ones or of a source that is read wrong throughout; and those sources with their chains (None if there are none).
    What is collected is bounded by ``per_language``."""
    spark = counted.sparkSession
    ship(spark)
    top = staged(frequent_words(counted, per_language), "frequent")
    words = _by_language(top.collect())
    shared, token = spark.sparkContext.broadcast(words), uuid.uuid4().hex

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = {w: n for ws in shared.value.values() for w, n in ws.items()}
        alphabet = set(SIGNS) | {c for w in count for c in w + w.lower() + w.upper()} | {chr(i) for i in range(128)}
        for b in batches:
            yield b[[not garble_of_more_frequent(w, count, alphabet) for w in b["word"]]]

    kept = widened(top).mapInPandas(run, top.schema)
    usual = staged(usual_chains(counted, shared, token), "usual")
    if usual.isEmpty():
        return _by_language(kept.collect()), None
    return _by_language(kept.join(usual.select("word"), "word", "left_anti").select("lang", "word", "n").collect()), usual.select("only", "chain").distinct()


def word_gains(counted: DataFrame, shared, token: str) -> DataFrame:
    """Every word that some chain shortens: ``word``, ``chains`` (names, results and bits saved). Each different word is priced once."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lengths = _in_worker(token, lambda: train(shared.value))
        for b in batches:
            got = [(w, [{"chain": " ".join(f"{x}>{y}" for x, y in c), "new": new, "gain": g} for c, (new, g) in table.items()]) for w in b["word"] if (table := gains(w, lengths))]
            yield pd.DataFrame(got, columns=["word", "chains"])

    return counted.select("word").repartition(max(counted.sparkSession.sparkContext.defaultParallelism, counted.rdd.getNumPartitions())).mapInPandas(run, "word string, chains array<struct<chain:string,new:string,gain:double>>")


def _steps_of(name: str) -> tuple[Step, ...]:
    return tuple(tuple(x.split(">")) for x in name.split(" ")) if name else ()


def garbled(df: DataFrame, key: str, fields: list[str], *, by: str | None = None, per_language: int = MODEL_WORDS) -> DataFrame:
    """The garbled values among ``fields`` of ``df``: ``key``, ``field``, ``value``, ``restored`` (null where the text cannot
    be brought back whole), ``chain`` (the steps undone, in order; empty where none is known), ``saved_bits``.

    A value is garbled if some chain of decodings gives a shorter description, or if it holds marks of lost bytes or
    control characters. One row per different (key, field, value), so copies of a row count once. Nulls, empty and
    plain ASCII values are never garbled. The dictionaries are trained on the words of all values of these fields,
    so a table without text gives no rows. ``by``: a column whose values name sources; one that is read wrong as a rule is recognised
    by all its words together. Very long values are worked through word by word. Other columns are ignored."""
    source = F.col(by).cast("string") if by else F.lit(None).cast("string")
    long = df.select(F.col(key).alias("k"), source.alias("by"), F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields])).alias("x")).select("k", "by", "x.field", "x.value")
    long = long.filter(F.col("value").rlike("[^\\x00-\\x7F]")).distinct()
    counted = staged(counted_words(long), "words")
    words, usual = model_words(counted, per_language)
    token = uuid.uuid4().hex
    shared = df.sparkSession.sparkContext.broadcast(words)  # at most per_language words of each known language
    priced = staged(word_gains(counted, shared, token), "gains")
    split = F.array_distinct(F.split("value", WORD_SPLIT_JVM))
    asked = long.select(F.coalesce("by", F.lit("")).alias("by"), "value").distinct().select("by", "value", F.explode(split).alias("word")).filter(F.col("word").rlike("[^\\x00-\\x7F]"))
    if fits_broadcast(priced.select("word")):
        hit = asked.join(F.broadcast(priced), "word")
    else:
        a, b = spread(asked, priced, ["word"])
        hit = a.join(b, ["word", "__salt"]).drop("__salt")
    hit = hit.groupBy("by", "value").agg(F.collect_list(F.struct("word", "chains")).alias("tables"))  # the words of one value
    hit = hit.withColumn("usual", F.array().cast("array<string>")) if usual is None else hit.join(usual.groupBy(F.col("only").alias("by")).agg(F.collect_set("chain").alias("usual")), "by", "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for source_, value, tables, known in zip(b["by"], b["value"], b["tables"], b["usual"], strict=True):
                table = {t["word"]: {_steps_of(c["chain"]): (c["new"], c["gain"]) for c in t["chains"]} for t in tables}
                text, undone, bits = restored(value, table, frozenset(map(_steps_of, known if known is not None else ())))
                if undone:
                    out.append((source_, value, None if broken(text) else text, [f"{x}>{y}" for x, y in undone], bits))
            yield pd.DataFrame(out, columns=["by", "value", "restored", "chain", "saved_bits"])

    found = hit.mapInPandas(run, "by string, value string, restored string, chain array<string>, saved_bits double")
    lost = F.col("value").rlike("[\x80-\x9f�]")
    out = long.withColumn("by", F.coalesce("by", F.lit(""))).join(found, ["by", "value"], "left").filter(F.col("chain").isNotNull() | lost)
    return out.select(F.col("k").alias(key), "field", "value", "restored", F.coalesce("chain", F.array().cast("array<string>")).alias("chain"), F.coalesce("saved_bits", F.lit(0.0)).alias("saved_bits")).distinct()
