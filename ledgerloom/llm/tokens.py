"""Whole texts to token ids with the tokenizers library, words memoised.

Both vocabularies split a text into words before merging, so the ids of a text
are the ids of its words one after another. Words repeat far more often than
texts, so a process keeps the ids of the words it has met (bounded: two
generations of ``MEMO_WORDS``), and only new words go through the library. Texts
that hold the string of one of the file's named tokens go through it whole.
"""

from __future__ import annotations

import gc
import os
import re
import sys
from array import array
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

assert array("I").itemsize == 4 and sys.byteorder == "little"

MEMO_WORDS = 300_000
# A text without white space in a row, and without a stop or comma after anything
# but a letter or number, can be cut before every blank, stop and comma and
# around every line break by plain replacement.
_PLAIN_NOT = re.compile(r"\s\s|[\W_][.,]|[\x00\x01]")
# The same question of the bytes, by their classes: white space, marks, stops,
# letters and numbers, bytes outside ASCII, and those that may begin a white space
# or sign there.
_CLASS = bytearray(b"H" * 256)
for _c in range(128):
    _CLASS[_c] = ord("S" if chr(_c).isspace() else "L" if chr(_c).isalnum() else "T" if chr(_c) in ".," else "M")
for _c in (0, 1, 0xC2, *range(0xE1, 0xE4)):
    _CLASS[_c] = ord("O")
_CLASS = bytes(_CLASS)
# A blank starts a word if no other white space is next to it; texts that have
# such white space are cut by the slower pattern.
_TIGHT = re.compile(r" \s| \Z")
_CUT = re.compile(r"(?= \S)")
_OVER_LATIN1 = re.compile("[^\x00-\xff]")
_TAIL = ".,;:!?#*$%&|"
# Byte-level pieces spell a byte as the character of its number, or, where that
# is no visible one, as the next from U+0100 on.
_HIDDEN = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 255 and b != 173)]
_BYTE_LETTERS = {b: 256 + i for i, b in enumerate(_HIDDEN)}
_BLANK = chr(_BYTE_LETTERS[32])
_CUTS = pa.large_list(pa.large_string())


def plain(text: str) -> bool:
    """Whether ``text`` can be cut by plain replacement; False also where
    finding out would take a closer look at characters outside ASCII."""
    raw = text.encode("utf-8", "surrogatepass")
    kind = raw.translate(_CLASS)
    if b"O" in kind:
        return not _PLAIN_NOT.search(text)
    if b"SS" in kind or b"ST" in kind or b"MT" in kind or b"TT" in kind:
        return False
    at = kind.find(b"HT")               # a stop after a character outside ASCII: letters U+00C0 to U+00FF
    while at >= 0:
        if raw[at - 1] != 0xC3 or raw[at] in (0x97, 0xB7):
            return False
        at = kind.find(b"HT", at + 1)
    return True


class WordEncoder:
    """One tokenizer file with its memo. Ids are little-endian unsigned 32-bit."""

    _own: dict[str, "WordEncoder"] = {}
    #: A word of ASCII letters is one piece, spelled with this before it; capitals too, if ``cased``.
    lead, cased = "", False

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        #: Strings that the file names as tokens: a text is cut at them before anything else.
        self.named = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    @classmethod
    def get(cls, name: str) -> "WordEncoder":
        """The process's encoder of a public vocabulary file (by file name) or
        of a tokenizer file anywhere on the machine (by absolute path)."""
        if name not in cls._own:
            if not os.path.isabs(name):
                import public_tokenizers
                path = public_tokenizers.path(name)
            else:
                path = name
            cls._own[name] = cls(path)
        return cls._own[name]

    def names_token(self, text: str) -> bool:
        """Whether the text, or what ``words`` makes of it, holds a named token's string."""
        return any(x in text for x in self.named)

    def words(self, text: str) -> str | list[str]:
        """Names of pieces whose ids, one after another, are the text's: a list,
        or one string that is to be cut at every blank."""
        raise NotImplementedError

    def parts(self, word: str) -> tuple[str, ...] | None:
        """A piece as other pieces with the same ids, one after another; None
        if it is looked up as it is."""
        return None

    @staticmethod
    def spelled(word: str) -> str:
        """The piece that a name stands for."""
        return word

    @staticmethod
    def symbols(word: str) -> str | None:
        """What normalising and cutting make of a piece, where that is plain:
        the library's model takes it at once. None: the whole library does it."""
        return None

    def _learn(self, words: Iterable[str]) -> None:
        young, old, parts = self.young, self.old, self.parts
        symbols, tokenize, lead, cased = self.symbols, self.tokenizer.model.tokenize, self.lead, self.cased
        todo: set[str] = set()
        joined, new = [], []
        for w in words:
            if w in old:
                young[w] = old[w]
            elif w.isalpha() and w.isascii() and (cased or w.islower()):
                young[w] = array("I", [t.id for t in tokenize(lead + w)]).tobytes()
            elif (x := symbols(w)) is not None:         # then it has no parts
                young[w] = array("I", [t.id for t in tokenize(x)]).tobytes()
            elif w[-1:].isalpha() and w.islower() and "\n" not in w or (x := parts(w)) is None:
                todo.add(w)
            else:
                joined.append(w)
                for p in x:
                    if p in old:
                        young[p] = old[p]
                    elif p not in young:
                        todo.add(p)
        for w in todo:
            if w in young:
                continue
            if (x := symbols(w)) is None:
                new.append(w)
            else:
                young[w] = array("I", [t.id for t in tokenize(x)]).tobytes()
        for k in range(0, len(new), 4096):
            part = new[k:k + 4096]
            young.update(zip(part, self._ids(list(map(self.spelled, part)))))
        for w in joined:
            young[w] = b"".join(map(young.__getitem__, parts(w)))

    def _ids(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece. The library cuts at a named token before anything
        else, so pieces with one between them are encoded in one call."""
        fast = self.tokenizer.encode_batch_fast
        if self.named:
            ids = np.array(fast([self.named[0].join(pieces)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.append(np.flatnonzero(ids == self.tokenizer.token_to_id(self.named[0])), len(ids)).tolist()
            if len(ends) == len(pieces):
                raw = ids.tobytes()
                return [raw[4 * a:4 * z] for a, z in zip([0, *(z + 1 for z in ends)], ends)]
        return [array("I", e.ids).tobytes() for e in fast(pieces, add_special_tokens=False)]

    def encode(self, texts: list[str | None], end: int, kind: str = "<u4") -> list[bytes]:
        """Ids of each text with ``end`` after them, as numbers of ``kind``
        (which must hold every id)."""
        gc.disable()        # many small objects, no cycles
        try:
            return self._encode(texts, end, np.dtype(kind))
        finally:
            gc.enable()

    def _encode(self, texts: list[str | None], end: int, kind: np.dtype) -> list[bytes]:
        if len(self.young) > MEMO_WORDS:
            self.old, self.young = self.young, {}
        last = np.array([end], kind).tobytes()
        out = [last] * len(texts)
        spaced, listed = [], []             # texts cut at every blank, and texts cut otherwise
        for i, t in enumerate(texts):
            if not t:
                continue
            if self.names_token(t):                 # rare: by the library as a whole
                out[i] = np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, kind).tobytes() + last
                continue
            cut = self.words(t)
            (spaced if isinstance(cut, str) else listed).append((i, cut))
        at = [i for i, _ in spaced + listed]
        if not at:
            return out
        cuts = pa.concat_arrays([pc.split_pattern(pa.array([x for _, x in spaced], pa.large_string()), " ").cast(_CUTS),
                                 pa.array([x for _, x in listed], _CUTS)])
        coded = cuts.flatten().dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()      # a batch's distinct words
        ids = list(map(self.young.get, words))
        if new := [k for k, x in enumerate(ids) if x is None]:
            self._learn([words[k] for k in new])
            for k in new:
                ids[k] = self.young[words[k]]
        flat = np.frombuffer(b"".join(ids), "<u4").astype(kind, copy=False)
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        first = np.cumsum(size) - size
        place = coded.indices.to_numpy()
        n = size[place]
        ends = np.concatenate(([0], np.cumsum(n)))
        raw = flat[np.arange(ends[-1]) + np.repeat(first[place] - ends[:-1], n)].tobytes()
        edges = (kind.itemsize * ends[cuts.offsets.to_numpy()]).tolist()
        for i, a, z in zip(at, edges, edges[1:]):
            out[i] = raw[a:z] + last
        return out


class ByteLevelEncoder(WordEncoder):
    """Byte-level BPE: a blank belongs to the word after it. A piece's name is
    the piece without its leading blank, or \\0 or \\1 and a piece without one."""

    lead, cased = _BLANK, True

    def words(self, text: str) -> str | list[str]:
        if plain(text):
            return "\1" + text.replace(",", " \0,").replace(".", " \0.").replace("\n", " \0\n \1")
        if not _TIGHT.search(text):
            cut = text.split(" ")
            return ["\1" + cut[0], *(w if w[:1] not in ("\0", "\1") else "\1 " + w for w in cut[1:])]
        return ["\1" + w for w in _CUT.split(text) if w]

    @staticmethod
    def spelled(word: str) -> str:
        return word[1:] if word[:1] in ("\0", "\1") else " " + word

    @staticmethod
    def symbols(word: str) -> str | None:
        """A blank and letters are one piece; its bytes are spelled as letters."""
        first = word[:1] == "\0" or word[:1] == "\1"
        bare = word[1:] if first else word
        if not bare.isalpha():
            return None
        if not bare.isascii():
            if _OVER_LATIN1.search(bare):
                return None
            bare = bare.encode().decode("latin-1").translate(_BYTE_LETTERS)
        return bare if first else _BLANK + bare

    def parts(self, word: str) -> tuple[str, ...] | None:
        """Letters, then ASCII marks: always apart before merging."""
        if "\n" in word:
            return None
        stem = word.rstrip(_TAIL)
        if len(stem) < len(word) and stem and stem[-1].isalpha():
            return stem, "\0" + word[len(stem):]
        return None


class WhiteSpaceEncoder(WordEncoder):
    """BPE with word ends, white space dropped and letters lower-cased: words
    are apart at white space, and letters from marks."""

    def names_token(self, text: str) -> bool:
        return super().names_token(text) or super().names_token(text.lower())

    def words(self, text: str) -> str | list[str]:
        if plain(text):
            if text.isascii() or not _OVER_LATIN1.search(text):     # lower-casing is one to one there
                text = text.lower().replace(",", " ,").replace(".", " .")
        return text.replace("\n", " ")

    @staticmethod
    def symbols(word: str) -> str | None:
        """Lower-case letters of Latin-1 are one piece and stay as they are."""
        if not (word.isalpha() and word.islower()) or _OVER_LATIN1.search(word):
            return None
        return word if word.isascii() else word.encode().decode("latin-1").translate(_BYTE_LETTERS)

    def parts(self, word: str) -> tuple[str, ...] | None:
        if _OVER_LATIN1.search(word):       # a letter may become a letter and a mark there
            return None
        stem = word.rstrip(_TAIL)
        if not stem or not (low := stem.lower())[-1].isalpha():
            return None
        if not stem.isascii():
            low = stem
        if len(stem) < len(word):
            return low, word[len(stem):]
        return None if low == word else (low,)
