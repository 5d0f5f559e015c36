"""Token ids and prefix counts by the tokenizers library, with word memos.

Both vocabularies split a text into words before any merge, so a word's ids
never depend on its neighbours.  Each Python worker therefore keeps the
library's answer per word and asks it again only for words it has not seen;
the memos hold a bounded number of words (two generations).  The splits used
here are those at which the vocabularies' own patterns always split:

* ``WordIds`` (lower-casing vocabulary that drops white space): at spaces and
  line feeds.
* ``PrefixCounts`` (byte-level vocabulary): before a single space that stands
  between two characters that are not white space.
"""

from __future__ import annotations

import os
import re
import struct

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Words kept per generation of a memo; a worker holds two generations.
MEMO_WORDS = 150_000

#: White space as the vocabularies' patterns see it, two or more.
_SPACE_RUN = re.compile("[\t-\r \x85\xa0  -     　]{2,}")
_SAFE_SPLIT = re.compile(r"(?<=\S) (?=\S)")
#: 1: space or line feed, 2: other white space, 0: the rest (by code point).
_KIND = np.zeros(0x3002, np.uint8)
_KIND[[*range(9, 14), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = 2
_KIND[[10, 32]] = 1
#: Pieces whose prefixes the pattern splits differently from the whole.
_CONTRACTIONS = ("'re", "'ve", "'ll")
#: ASCII punctuation that never joins the letters before it (an apostrophe may begin a contraction).
_PUNCTUATION = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")
#: Packers of lists of up to 63 ids.
_PACK = [struct.Struct(f"<{n}I").pack for n in range(64)]


class _Memo(dict):
    """``memo[word]`` computes on a miss; keeps two generations of words."""

    def __init__(self, compute, limit: int):
        super().__init__()
        self.compute, self.limit, self.old = compute, limit, {}

    def __missing__(self, word):
        value = self.old.get(word)
        if value is None:
            value = self.compute(word)
        self.keep(word, value)
        return value

    def keep(self, word, value):
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[word] = value


class WordIds:
    """Token ids of whole texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, limit: int = 2 * MEMO_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.memo = _Memo(self._word, limit)
        self.stems = _Memo(self._stem, limit)
        self.tails = _Memo(self._library, 1000)
        self.letters = _Memo(self._letter, 5000)

    def _library(self, word: str) -> bytes:
        return self._pack(self.tokenizer.encode(word, add_special_tokens=False).ids)

    @staticmethod
    def _pack(ids: list[int]) -> bytes:
        return _PACK[len(ids)](*ids) if len(ids) < len(_PACK) else struct.pack(f"<{len(ids)}I", *ids)

    def _letter(self, c: str) -> str:
        """A Latin letter in the model's alphabet; empty if it isn't one letter after normalisation."""
        plain = self.tokenizer.normalizer.normalize_str(c)
        return self.tokenizer.pre_tokenizer.pre_tokenize_str(plain)[0][0] if len(plain) == 1 and plain.isalpha() else ""

    def _stem(self, stem: str) -> bytes:
        """Lower-case letters only: one piece, which the model takes normalised; empty if that is not certain."""
        if stem.isascii():
            piece = stem
        elif max(stem) < "\u0250":  # precomposed Latin letters never combine with each other
            letters = list(map(self.letters.__getitem__, stem))
            if "" in letters:
                return b""
            piece = "".join(letters)
        else:
            return b""
        return self._pack([t.id for t in self.model.tokenize(piece)])

    def _word(self, word: str) -> bytes:
        stem = word.rstrip(_PUNCTUATION)
        ids = self.stems[stem.lower()] if stem.isalpha() else b""
        if not ids:
            return self._library(word)
        return ids + self.tails[word[len(stem):]] if len(stem) < len(word) else ids

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        words = text.replace("\n", " ").split(" ")
        parts = list(map(self.memo.get, words))
        memo, at = self.memo, -1
        for _ in range(parts.count(None)):
            at = parts.index(None, at + 1)
            parts[at] = memo[words[at]]
        return b"".join(parts)


class PrefixCounts:
    """Exact number of tokens of every prefix of a text (byte-level BPE).

    ``counts(text)[i]`` is the library's token count of ``text[:i]`` for i
    from 0 to the number of code points.

    Inside one piece the counts come from a dynamic program: the encoding of
    a prefix ends in the one vocabulary entry that stays apart from the last
    entry of the encoding before it, so
    ``count[j] = count[j - len(entry)] + 1``.  Whether two neighbouring
    entries stay apart is the library's own answer for their concatenation.
    """

    def __init__(self, path: str, limit: int = MEMO_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = re.compile("|".join(sorted((re.escape(t.content) for t in added), key=len, reverse=True)) or r"(?!)")
        self.vocab = set(self.tokenizer.get_vocab(with_added_tokens=False))
        lengths: dict[str, set[int]] = {}
        for t in self.vocab:
            lengths.setdefault(t[-3:], set()).add(len(t))
        #: Lengths of the entries that end in three bytes, longest first, and the short ones.
        self.lengths = {tail: (*sorted((n for n in ns if n > 2), reverse=True), 2, 1) for tail, ns in lengths.items() if len(tail) == 3}
        self.apart = _Memo(self._apart, limit)
        self.space = self.split(" ")[0][0]
        self.char = _Memo(lambda c: self.split(c)[0][0], 5000)
        self.begun = _Memo(None, 2 * limit)
        self.first = _Memo(lambda w: self._word("", w) if w[0].isalpha() else self._chunk(w), limit // 10)
        self.later = _Memo(lambda w: self._word(" ", w), 2 * limit)  # long texts bring new words at every size of input

    def _apart(self, pair: str) -> bool:
        """Whether two entries, given with a space between, stay apart (or one is its own encoding)."""
        return " ".join(t.value for t in self.model.tokenize(pair.replace(" ", ""))) == pair.lstrip(" ")

    def _piece(self, s: str) -> list[int]:
        """Counts after each byte of one piece in the byte alphabet.

        Words that begin alike share the steps of the beginning, which are
        kept (count and length of the last entry, a byte each) for every
        second length.
        """
        vocab, apart, lengths, short = self.vocab, self.apart, self.lengths, (2, 1)
        kept, old, n = self.begun, self.begun.old, len(s)
        make = bytearray if n <= 200 else list
        counts, sizes = make(b"\0"), make(b"\0")
        for j in range(min(n, 24) & ~1, 0, -2):
            start = s[:j]
            known = kept.get(start) or old.get(start)
            if known:
                counts, sizes = make(known[:j + 1]), make(known[j + 1:])
                break
        for j in range(len(counts), n + 1):
            for size in lengths.get(s[j - 3:j], short) if j > 2 else short:
                at = j - size
                if at < 0:
                    continue
                t = s[at:j]
                if t in vocab and apart[f"{s[at - sizes[at]:at]} {t}"]:
                    counts.append(counts[at] + 1)
                    sizes.append(size)
                    break
            else:
                raise ValueError("the vocabulary lacks a byte")
            if not j & 1 and j <= 24:
                kept.keep(s[:j], bytes(counts + sizes))
        return list(counts)[1:]

    def _stem(self, stem: str) -> list[int]:
        """Prefix counts of letters, after a space if there is one."""
        space, letters = (self.space, stem[1:]) if stem[0] == " " else ("", stem)
        if letters.isascii():
            return self._piece(space + letters)
        mapped = [space] * bool(space) + list(map(self.char.__getitem__, letters))
        counts, at, out = self._piece("".join(mapped)), -1, []
        for m in mapped:
            at += len(m)
            out.append(counts[at])
        return out

    def _word(self, space: str, word: str) -> bytes:
        """Prefix counts of what stands between two splits; ``space`` begins it.

        A word that begins with a line feed has that instead of the space; a
        line feed between two other characters is one token.
        """
        base = 0
        if word[0] == "\n":
            space, word, base = "", word[1:], 1
        stem = word.rstrip(".,")
        if stem.isalpha():
            counts = self._stem(space + stem)
            if len(stem) < len(word):
                last = counts[-1]
                counts += [last + c for c in self._piece(word[len(stem):])]
        else:
            counts = np.frombuffer(self._chunk(space + word), "<u4").tolist()
        if base:
            counts = [1] + [1 + c for c in counts]
        return struct.pack(f"<{len(counts)}I", *counts)

    def _segment(self, text: str) -> list[int]:
        """Counts of the prefixes of a text without special strings."""
        out: list[int] = []
        for piece, (a, b) in self.split(text):
            base, part = (out[-1] if out else 0), text[a:b]
            if part in _CONTRACTIONS:
                counts = [1, 2, self._piece(piece)[-1]]
            else:
                counts = self._piece(piece)
                if not part.isascii():
                    ends = np.cumsum([len(c.encode()) for c in part])
                    counts = [counts[e - 1] for e in ends]
            out += [base + c for c in counts]
        for run in _SPACE_RUN.finditer(text):  # a prefix that ends in white space keeps it in one piece
            a, b = run.span()
            base = out[a - 1] if a else 0
            mapped = [self.split(c)[0][0] for c in text[a:b]]
            counts = self._piece("".join(mapped))
            ends = np.cumsum([len(m) for m in mapped])
            out[a:b] = [base + counts[e - 1] for e in ends]
        return out

    def _chunk(self, text: str) -> bytes:
        out: list[int] = []
        at = 0
        for hit in self.special.finditer(text):
            if hit.end() == hit.start():
                continue
            base = out[-1] if out else 0
            head = self._segment(text[at:hit.start()])
            before = head[-1] if head else 0
            partial = [len(self.tokenizer.encode(text[at:j], add_special_tokens=False).ids) for j in range(hit.start() + 1, hit.end())]
            out += [base + c for c in [*head, *partial, before + 1]]
            # head[-1] holds when the special string follows: it ends the segment there
            at = hit.end()
        base = out[-1] if out else 0
        out += [base + c for c in self._segment(text[at:])]
        return np.array(out, "<u4").tobytes()

    def counts(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(1, np.uint32)
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = _KIND[np.minimum(points, len(_KIND) - 1)]
        gaps = np.flatnonzero(kind == 1)
        alone = not (kind[0] or kind[-1]) and not (kind[gaps - 1].any() or kind[gaps + 1].any())
        if alone and not self.special.search(text):  # every space and line feed stands between two other characters
            words = text.replace("\n", " \n").split(" ")
        else:
            words = _SAFE_SPLIT.split(text)
            gaps = np.cumsum([len(w) + 1 for w in words])[:-1] - 1
        parts = list(map(self.later.get, words))
        parts[0] = self.first[words[0]]
        if None in parts:
            later = self.later
            parts = [later[w] if x is None else x for w, x in zip(words, parts, strict=True)]
        out = np.empty(len(points) + 1, np.uint32)
        out[0] = 0
        out[1:] = np.frombuffer(b"".join(parts), "<u4")
        bases = np.cumsum(out[gaps], dtype=np.uint32)  # tokens before each gap
        if len(gaps):
            out[1 + gaps[0]:] += np.repeat(bases, np.diff(np.append(gaps, len(points))))
        return out


_CODERS: dict[tuple, object] = {}


def coder(kind: type, path: str):
    """This worker's coder of a vocabulary file, kept between tasks."""
    key = (kind, path)
    if key not in _CODERS:
        _CODERS[key] = kind(path)
    return _CODERS[key]
