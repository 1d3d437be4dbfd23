"""Token ids by the ``tokenizers`` library, with the ids of recurring words kept in the worker.

Both public byte-pair vocabularies cut a text at white space before anything else happens, so the ids of a text are
the ids of its units (a word, for one of them with the white space before it) one after the other, and the ids of a
unit those of its pieces. Where white space stays with words, a mark after a letter begins a unit too, as every piece
of letters ends there. The distinct units of a slice of texts are looked up once; the library's model encodes a
piece that is new. Whatever this does not cover (odd white space, letters beyond Latin, the vocabulary's own special
tokens spelt out in a text, a vocabulary with other rules) is encoded by the library as a whole.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np
import pyarrow as pa
import regex

from .common import text_steps, worker_state
from .words import Words

#: Units and ids of units that a worker keeps at most, of which the half used last stays; and pieces, whose full cache starts anew.
UNITS_KEPT, IDS_KEPT, PIECES_KEPT = 600_000, 4_000_000, 150_000
# Fixed value: how byte-level vocabularies of this family cut a text.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
_MAYBE_ODD = re.compile(b"[\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a|\xe2[\x80\x81]|\xe3\x80")
_BEYOND_LATIN = re.compile("[^\x00-ɏ]")


class Kept(dict):
    """A dictionary that makes a missing value and starts anew when it is full."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key):
        value = self.make(key)
        if len(self) >= self.most:
            self.clear()
        self[key] = value
        return value


def byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte: itself where it is printable, else the next letter from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Units:
    """The ids of units by fingerprint, in flat arrays: where the ids of each lie in ``ids``, and the slice that used it last."""

    def __init__(self):
        self.codes, self.ids = np.zeros(0, np.uint64), np.zeros(0, "<u4")
        self.begin, self.size, self.used = (np.zeros(0, np.int32) for _ in range(3))
        self.slice = 0

    def find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``codes`` are known, and at what places those are."""
        at = np.searchsorted(self.codes, codes)
        known = np.zeros(len(codes), bool)
        inside = at < len(self.codes)
        known[inside] = self.codes[at[inside]] == codes[inside]
        self.slice += 1
        self.used[at[known]] = self.slice
        return known, at[known]

    def add(self, codes: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> None:
        """New units in ascending order, with their ids one after the other."""
        at = np.searchsorted(self.codes, codes)
        self.codes, self.size = np.insert(self.codes, at, codes), np.insert(self.size, at, sizes)
        self.begin = np.insert(self.begin, at, len(self.ids) + np.cumsum(sizes) - sizes)
        self.used = np.insert(self.used, at, self.slice)
        self.ids = np.concatenate([self.ids, ids])
        if len(self.codes) > UNITS_KEPT or len(self.ids) > IDS_KEPT:
            order = np.argsort(-self.used, kind="stable")[: UNITS_KEPT // 2]
            keep = np.sort(order[np.cumsum(self.size[order], dtype=np.int64) <= IDS_KEPT // 2])
            self.ids = self.ids[ranges(self.begin[keep], self.size[keep])]
            self.codes, self.size, self.used = self.codes[keep], self.size[keep], self.used[keep]
            self.begin = (np.cumsum(self.size) - self.size).astype(np.int32)


def ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers from each ``begin`` on, ``size`` of them, one range after the other."""
    size = size.astype(np.int64)
    return np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def letter_bytes(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to letters from A to z and from U+00C0 to U+023F; other letters are not told."""
    flags = ((data | 32) >= 97) & ((data | 32) <= 122)
    if len(data) > 1:
        lead, next_ = data[:-1], data[1:]
        pair = (lead >= 0xC3) & (lead <= 0xC8) & (next_ >= 0x80) & (next_ <= 0xBF)
        pair &= (lead != 0xC3) | ((next_ != 0x97) & (next_ != 0xB7))
        flags[:-1] |= pair
        flags[1:] |= pair
    return flags


class Encoder:
    """``encode`` gives the ids of a column of texts: flat unsigned 32-bit numbers, and how many each text has."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        added = sorted({t.content for t in self.whole.get_added_tokens_decoder().values()})
        self.added = re.compile("|".join(map(re.escape, added)), re.IGNORECASE) if added else None
        self.added_bytes = re.compile("|".join(map(re.escape, added)).encode(), re.IGNORECASE) if added else None
        self.added_lower = [x.encode().lower() for x in added]
        self.model, self.letters = self.whole.model, byte_letters()
        self.letter_codes = np.array([ord(self.letters[b]) for b in range(256)], "<u4")
        self.spaces, pattern, self.lower = self._rules(json.loads(self.whole.to_str()))
        self.cut = regex.compile(pattern).findall if pattern else None
        self.pieces = Kept(self._piece, PIECES_KEPT)
        self.units = Units()

    @staticmethod
    def _rules(spec: dict) -> tuple[str, str, bool]:
        """Where white space goes (``dropped``, ``leading`` a word, or ``whole``: not known), how a unit is cut, and whether in lower case."""
        cut, normal = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
        if cut.get("type") == "ByteLevel" and cut.get("use_regex") and not cut.get("add_prefix_space") and normal is None:
            return "leading", BYTE_LEVEL_PATTERN, False
        steps = cut.get("pretokenizers", [])
        kinds = [x["type"] for x in (normal or {}).get("normalizers", [])]
        if [x["type"] for x in steps] == ["Split", "ByteLevel"] and steps[0]["behavior"] == "Removed" and steps[0]["invert"] and kinds == ["NFC", "Replace", "Lowercase"]:
            pattern = steps[0]["pattern"].get("Regex", "")
            if pattern and "(?" not in pattern and not steps[1].get("use_regex") and not steps[1].get("add_prefix_space"):
                return "dropped", pattern, True
        return "whole", "", False

    def ids(self, text: str) -> list[int]:
        return self.whole.encode(text, add_special_tokens=False).ids

    def _tokens(self, spelt: str) -> bytes:
        return array("I", [t.id for t in self.model.tokenize(spelt)]).tobytes()

    def _piece(self, piece: str) -> bytes:
        return self._tokens(piece.encode().decode("latin-1").translate(self.letters))

    def _unit(self, unit: str) -> bytes:
        """The ids of a unit of letters up to U+024F, which are their own composed form, and plain white space."""
        unit = unit.lower() if self.lower else unit
        space = unit[0] == " "
        if (unit[1:] if space else unit).isalpha():
            # A run of letters is one piece; most words are, and most of them come once.
            return self._tokens(("Ġ" + unit[1:] if space else unit) if unit.isascii() else unit.encode().decode("latin-1").translate(self.letters))
        return b"".join([self.pieces[p] for p in self.cut(unit)])

    def _odd_unit(self, unit: str) -> bytes:
        if self.cut is None or _BEYOND_LATIN.search(unit) or _ODD_SPACE.search(unit) or (self.added and self.added.search(unit)):
            return np.array(self.ids(unit), "<u4").tobytes()
        return self._unit(unit)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        steps = [self._step(texts) for texts in text_steps(column)]
        return np.concatenate([np.zeros(0, "<u4"), *[ids for ids, _ in steps]]), np.concatenate([np.zeros(0, np.int64), *[n for _, n in steps]])

    def _step(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        words = Words(column)
        data, first, last = words.data.tobytes(), words.bounds[:-1], words.bounds[1:]
        start, end, doc = words.start, words.end, words.doc
        letter = letter_bytes(words.data)
        if self.spaces == "leading":
            # From the end of the word before, or of the text's beginning; what white space is left at a text's end is a unit too.
            edge = np.zeros(len(data) + 1, bool)
            edge[words.bounds] = edge[end] = True
            mark = (words.data > 32) & (words.data < 127) & ~letter & ((words.data < 48) | (words.data > 57))
            edge[1:-1] |= letter[:-1] & mark[1:]
            edges = np.flatnonzero(edge)
            start, end = edges[:-1], edges[1:]
            doc = np.repeat(np.arange(len(first)), np.diff(np.searchsorted(edges, words.bounds)))
        # Bytes that may belong to anything but plain white space and letters up to U+024F.
        doubtful = np.concatenate([[0], np.cumsum((words.data >= 0xC9) | (words.data == 0xC2) | ((words.data >= 0x1C) & (words.data <= 0x1F)))])
        odd = np.zeros(len(first), bool)
        if self.spaces == "whole":
            odd[:] = True
        else:
            lower = data.lower()
            spelt = any(x in lower for x in self.added_lower)
            if spelt or (doubtful[-1] and _MAYBE_ODD.search(data)):
                for i, (a, b) in enumerate(zip(first.tolist(), last.tolist(), strict=True)):
                    odd[i] = _MAYBE_ODD.search(data, a, b) is not None and _ODD_SPACE.search(data[a:b].decode()) is not None
                    odd[i] |= spelt and self.added_bytes.search(data, a, b) is not None
        if odd.any():
            keep, alone = ~odd[doc], np.flatnonzero(odd)
            start, end, doc = np.concatenate([start[keep], first[alone]]), np.concatenate([end[keep], last[alone]]), np.concatenate([doc[keep], alone])
            order = np.argsort(doc, kind="stable")
            start, end, doc = start[order], end[order], doc[order]
        codes, where, which = np.unique(words.range_codes(start, end), return_index=True, return_inverse=True)
        known, at = self.units.find(codes)
        new = np.flatnonzero(~known)
        begin, stop = start[where[new]], end[where[new]]
        slow = (doubtful[stop] > doubtful[begin]) | (self.cut is None) | odd[doc[where[new]]]
        fresh, sizes_new = self._new_units(words.data, data, letter, begin, stop, slow)
        source = np.concatenate([self.units.ids, fresh])
        begins, sizes = np.zeros(len(codes), np.int64), np.zeros(len(codes), np.int64)
        begins[known], sizes[known] = self.units.begin[at], self.units.size[at]
        begins[new], sizes[new] = len(self.units.ids) + np.cumsum(sizes_new) - sizes_new, sizes_new
        short = stop - begin <= 200
        self.units.add(codes[new[short]], sizes_new[short], fresh if short.all() else fresh[np.repeat(short, sizes_new)])
        lengths = sizes[which]
        return source[ranges(begins[which], lengths)], np.bincount(doc, weights=lengths, minlength=len(first)).astype(np.int64)

    def _new_units(self, data: np.ndarray, raw: bytes, letter: np.ndarray, begin: np.ndarray, stop: np.ndarray, slow: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the units at these places of ``data``, one unit after the other, and how many each has."""
        fresh, ends = array("I"), []
        plain, spelt, tokens = np.zeros(len(begin), bool), "", self.model.tokenize
        if self.spaces == "leading" and len(begin):
            # Letters alone, or after one blank, are one piece; most new units are, and all of them are spelt at once.
            others = np.concatenate([[0], np.cumsum(~letter)])
            word = begin + (data[begin] == 32)
            plain = ~slow & (word < stop) & (others[stop] == others[word])
            spelt = self.letter_codes[data].tobytes().decode("utf-32-le")
        for a, b, is_plain, by_rule in zip(begin.tolist(), stop.tolist(), plain.tolist(), (~slow).tolist(), strict=True):
            if is_plain:
                fresh.extend([t.id for t in tokens(spelt[a:b])])
            else:
                fresh.frombytes((self._unit if by_rule else self._odd_unit)(raw[a:b].decode()))
            ends.append(len(fresh))
        return np.frombuffer(fresh, "<u4") if fresh else np.zeros(0, "<u4"), np.diff(np.array(ends, np.int64), prepend=0)


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file."""
    return worker_state(f"encoder {path}", lambda: Encoder(path))
