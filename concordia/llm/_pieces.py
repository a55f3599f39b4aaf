"""Encode texts piece by piece at boundaries that cannot change the ids.

A text is cut where no match of the vocabularies' splitting patterns can span the cut (see
`cuts`; a match may begin with a space, never end after it), so the ids of the pieces, end to end, are the ids of the text. Pieces repeat,
as words do: each slice encodes its distinct pieces only, and a worker remembers the ids of
MOST_PIECES of them.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable

import numpy as np
import regex

from concordia.llm import _text as X

#: Pieces in each of the two generations that a worker remembers (about 200 bytes each); longer ones than MOST_BYTES are not kept.
MOST_PIECES, MOST_BYTES = 150_000, 48
#: No cut before a space that one of these bytes follows: white space, or the first byte of a character that may be.
_NO_CUT = np.zeros(256, bool)
_NO_CUT[[*range(0x09, 0x0E), *range(0x1C, 0x21), 0xC2, 0xE1, 0xE2, 0xE3]] = True


_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK = np.zeros(256, bool)
_MARK[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
_PLAIN = _LETTER | _MARK


def cuts(s: X.Slice) -> np.ndarray:
    """Where the pieces of a slice begin: at each document's first byte, at a space that an ordinary character
    follows, at an ASCII punctuation mark after a Latin letter, and around a lone line feed between such."""
    data = s.data
    at = np.zeros(len(data) + 1, bool)
    at[s.offsets[:-1]] = True
    if len(data) > 1:
        at[:-2] |= (data[:-1] == 0x20) & ~_NO_CUT[data[1:]]
        letter = _LETTER[data]
        letter[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        at[1:-1] |= letter[:-1] & _MARK[data[1:]]
        feed = np.flatnonzero(data[1:-1] == 10) + 1
        feed = feed[_PLAIN[data[feed - 1]] & _PLAIN[data[feed + 1]]]
        at[feed] = True
        at[feed + 1] = True
    return np.flatnonzero(at[:-1])


#: Where a match of the rank files' pattern begins in any script: a space before a character of a word, number, mark or
#: symbol; a mark after a letter or number.
_BOUNDARY = regex.compile(r" (?=[\p{L}\p{N}\p{P}\p{S}])|(?<=[\p{L}\p{N}])(?=\p{P})")


def halves(text: str, most: int) -> list[str]:
    """A long text in parts of at least `most` characters that end at safe boundaries.

    A run of letters (or of digits, of marks, of white space) without such a place is one match and stays whole."""
    out, at = [], 0
    while len(text) - at > most and (cut := _BOUNDARY.search(text, at + most)):
        out.append(text[at : cut.start()])
        at = cut.start()
    return [*out, text[at:]]


class Ids:
    """The ids of whole documents. `encode_many` turns distinct pieces into the bytes of their ids (32 bits each);
    `special` has the strings that are one id each wherever a text holds them."""

    def __init__(self, encode_many: Callable[[list[str]], list[bytes]], special: dict[bytes, int] | None = None):
        self.encode_many, self.known, self.old = encode_many, {}, {}
        self.special = {k: array("I", [v]).tobytes() for k, v in (special or {}).items()}
        self.find = re.compile(b"|".join(map(re.escape, sorted(self.special, key=lambda x: (-len(x), x))))).finditer

    def begins(self, s: X.Slice, data: bytes) -> np.ndarray:
        """Where the pieces begin: at the cuts, but special strings are pieces of their own."""
        begin = cuts(s)
        if not any(x in data for x in self.special):
            return begin
        at = np.zeros(len(data) + 1, bool)
        at[begin] = True
        for a, b in zip(s.offsets[:-1].tolist(), s.offsets[1:].tolist()):
            for found in self.find(data[a:b]):
                start, end = a + found.start(), a + found.end()
                at[start + 1 : end] = False
                at[start] = at[end] = True
        return np.flatnonzero(at[:-1])

    def of(self, s: X.Slice) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all documents of the slice end to end, offsets of each document)."""
        data = s.data.tobytes()
        begin = self.begins(s, data)
        if not len(begin):
            return np.zeros(0, np.uint32), np.zeros(s.n + 1, np.int64)
        end = np.append(begin[1:], len(data))
        first, which = X.distinct(s.data, begin, end)
        found = [data[a:b] for a, b in zip(begin[first].tolist(), end[first].tolist())]
        if len(self.known) > MOST_PIECES:
            self.known, self.old = {}, self.known
        values = list(map(self.known.get, found))
        new = [i for i, v in enumerate(values) if v is None]
        if self.special:
            for i in new:
                values[i] = self.special.get(found[i])
            new = [i for i in new if values[i] is None]
        if self.old:
            for i in new:
                if (v := self.old.get(found[i])) is not None:
                    values[i] = self.known[found[i]] = v
            new = [i for i in new if values[i] is None]
        for i, v in zip(new, self.encode_many([found[i].decode() for i in new])):
            values[i] = v
            if len(found[i]) <= MOST_BYTES:
                self.known[found[i]] = v
        flat = np.frombuffer(b"".join(values), np.uint32)
        length = np.array([len(v) for v in values], np.int64) // 4
        at = (np.cumsum(length) - length)[which]
        length = length[which]
        upto = np.zeros(len(length) + 1, np.int64)
        np.cumsum(length, out=upto[1:])
        ids = flat[np.arange(upto[-1]) + np.repeat(at - upto[:-1], length)]
        return ids, upto[np.searchsorted(begin, s.offsets)]


def _byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b if b in own else next(rest)) for b in range(256)]


def _encode_many(path: str, pattern: str) -> Callable[[list[str]], list[bytes]]:
    """The tokenizers library's normaliser and BPE model on distinct pieces and words.

    Its whole pipeline spends most time on offsets that nobody reads here; splitting by the file's own pattern
    and asking the model for each distinct word gives the same ids (tests hold the two together)."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        steps = json.load(f)["pre_tokenizer"]
    steps = steps.get("pretokenizers", [steps])
    splits = [x["pattern"]["Regex"] for x in steps if x["type"] == "Split"]
    find = regex.compile(splits[0] if splits else pattern).findall
    letters = dict(enumerate(_byte_letters()))
    tokenize = t.model.tokenize
    normalize = t.normalizer.normalize_str if t.normalizer else None

    def many(pieces: list[str]) -> list[bytes]:
        if normalize:
            pieces = [p.lower() if p.isascii() else normalize(p) for p in pieces]
        return [array("I", [x.id for w in find(p) for x in tokenize(w.encode().decode("latin-1").translate(letters))]).tobytes() for p in pieces]

    return many


_LOADED: dict[tuple, object] = {}


def once(key: tuple, make: Callable):
    """What `make` gives, kept by this worker."""
    if key not in _LOADED:
        _LOADED[key] = make()
    return _LOADED[key]


def _special(path: str) -> dict[bytes, int]:
    """The file's special strings and their ids, as the library cuts them out of the raw text."""
    with open(path, encoding="utf-8") as f:
        added = json.load(f)["added_tokens"]
    if any(x["normalized"] or x["single_word"] or x["lstrip"] or x["rstrip"] for x in added):
        raise ValueError("added tokens that are normalised, whole words or strip spaces aren't covered")
    return {x["content"].encode(): x["id"] for x in added}


def tokenizer_ids(path: str, pattern: str, special_strings: bool = True) -> Ids:
    """Ids of a `tokenizers` file of a byte-level BPE; `pattern` splits texts where the file names none itself.

    With special_strings the strings of the file's special tokens become their ids, as the library has it by itself;
    without, they are ordinary text (its `encode_special_tokens`)."""
    return once(("tokenizers", path, special_strings), lambda: Ids(_encode_many(path, pattern), _special(path) if special_strings else {}))
