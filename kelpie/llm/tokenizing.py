"""Token ids of whole texts from a public tokenizer file, with a bounded table of pieces.

Cutting a text where the tokenizer itself always cuts gives the same ids as encoding
it whole, so a piece's ids are looked up when it has been seen before.  All of a
chunk's new pieces are encoded in a few calls: laid side by side they are cut apart
again by the tokenizer, and its ids tell where each ends.  Where no cut is safe, the
library gets the whole text.  Cutting and looking up are array work; Python sees
distinct pieces only."""

from __future__ import annotations

import json
import os
import re
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from kelpie.llm.pieces import Classes, PieceTable, bytes_before, code_points, piece_starts

END_ID = 1
GENERATION = 200_000    # pieces in one of the two generations of the table
_SIDE_BY_SIDE = 1000    # pieces that the library gets in one text


def public_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _blanks(path: str) -> str:
    """What the tokenizer does with blanks: ``dropped`` before words are cut,
    ``leading`` (a blank starts the next word), or ``other``."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    norm, pre = spec.get("normalizer"), spec.get("pre_tokenizer") or {}
    if any(re.search(r"\s", t["content"]) or t["single_word"] or t["lstrip"] or t["rstrip"]
           for t in spec.get("added_tokens", [])):
        return "other"
    steps = pre.get("pretokenizers", [])
    if steps and steps[0]["type"] == "Split" and steps[0]["behavior"] == "Removed" and steps[0]["invert"] \
            and norm and norm["type"] == "Sequence" \
            and all(n["type"] in ("NFC", "Replace", "Lowercase") for n in norm["normalizers"]):
        return "dropped"
    if norm is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space"):
        return "leading"
    return "other"


class Encoder:
    """Encodes chunks of whole texts to ids."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")    # Spark's tasks are the parallelism
        from tokenizers import Tokenizer
        self._tok = Tokenizer.from_file(path)
        self._blanks = _blanks(path)
        self._table = PieceTable(self._learn, GENERATION)
        self._special = "|".join(map(re.escape, (t.content for t in self._tok.get_added_tokens_decoder().values())))
        tokens = [""] * self.vocabulary
        for token, i in self._tok.get_vocab(with_added_tokens=True).items():
            tokens[i] = token
        if self._blanks == "leading":
            self._kinds = Classes(self._tok)
            self._bytes = np.array([len(t) for t in tokens], np.int64)      # a letter stands for each byte
        elif self._blanks == "dropped":
            self._ends = np.array([t.endswith("</w>") for t in tokens])

    @property
    def vocabulary(self) -> int:
        return self._tok.get_vocab_size(with_added_tokens=True)

    @property
    def _old(self) -> dict[bytes, int]:
        return self._table.old

    def _run(self, texts: list[str]) -> list:
        return getattr(self._tok, "encode_batch_fast", self._tok.encode_batch)(texts, add_special_tokens=False)

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self._run(texts)]

    # --- new pieces

    def _learn(self, new: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces that the table doesn't know."""
        beside = np.array([self._side_by_side(p) for p in new], bool)
        width, flats = np.zeros(len(new), np.int64), {}
        at = np.flatnonzero(beside)
        for i in range(0, len(at), _SIDE_BY_SIDE):
            those = at[i:i + _SIDE_BY_SIDE]
            found = self._together([new[k] for k in those.tolist()])
            if found is None:
                beside[those] = False
            else:
                width[those] = found[1]
                flats[int(those[0])] = found[0]
        alone = np.flatnonzero(~beside)
        flat = np.zeros(0, np.uint32)
        if len(alone):
            each = [np.frombuffer(x, "<u4") for x in self._whole([new[k].decode("utf-8", "surrogatepass") for k in alone.tolist()])]
            width[alone] = [len(x) for x in each]
            flat = np.concatenate(each)
        place = np.concatenate([[0], np.cumsum(width)])
        out = np.zeros(place[-1], np.uint32)
        out[np.repeat(~beside, width)] = flat
        if flats:
            out[np.repeat(beside, width)] = np.concatenate([flats[k] for k in sorted(flats)])
        return out, width

    def _side_by_side(self, piece: bytes) -> bool:
        """Whether the tokenizer cuts the piece from its neighbours and its ids show where it ends."""
        if self._blanks == "leading":
            return not piece.isspace() and (piece[:1] != b" " or not piece[1:2].isspace())
        return piece.isascii() or _CALM_TEXT.fullmatch(piece) is not None

    def _together(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of many pieces by one call; None if no ids end where the pieces do.  (Where they do,
        no merge has crossed an edge, so they are the ids of the pieces alone.)"""
        if self._blanks == "dropped":
            ids = np.array(self._run([b" ".join(pieces).decode()])[0].ids, np.uint32)
            last = np.flatnonzero(self._ends[ids])
            return (ids, np.diff(last, prepend=-1)) if len(last) == len(pieces) else None
        # a blank before a piece parts it from the one before; others get a line feed for that
        joined = b"".join([p if p[:1] == b" " else b"\n" + p for p in pieces])
        ids = np.array(self._run([joined.decode("utf-8", "surrogatepass")])[0].ids, np.uint32)
        ends = np.concatenate([[0], np.cumsum(self._bytes[ids])])           # bytes before each id, and in all
        size = np.array([len(p) for p in pieces])
        fed = np.array([p[:1] != b" " for p in pieces], np.int64)
        stop = np.cumsum(size + fed)
        first, last = np.searchsorted(ends, stop - size), np.searchsorted(ends, stop)
        if ends[-1] != stop[-1] or (ends[first] != stop - size).any() or (ends[last] != stop).any():
            return None
        own = np.ones(len(ids), bool)
        own[first[fed > 0] - 1] = False
        return ids[own], last - first

    # --- cutting

    def _cut(self, data: bytes, ends: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
        """Pieces of the texts that end at the bytes ``ends`` (with a 0 before): (the pieces' bytes, their edges
        there, the number of pieces before each text)."""
        if self._blanks == "leading":
            points = code_points(data)
            size = bytes_before(points)
            at = ends if len(size) == len(data) + 1 else np.searchsorted(size, ends)
            starts = piece_starts(points, self._kinds(points), at[:-1][np.diff(at) > 0])
            edges = np.append(size[starts], len(data))
            return data, edges, np.searchsorted(edges[:-1], ends)
        return cut_words(np.frombuffer(data, np.uint8), ends)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one behind the other, and where each text's begin (one more entry: the end)."""
        if self._blanks == "other":
            odd = np.ones(len(texts), bool)
        elif self._special:
            odd = pc.match_substring_regex(texts, self._special, ignore_case=True).to_numpy(zero_copy_only=False).astype(bool)
        else:
            odd = np.zeros(len(texts), bool)
        plain = pc.if_else(pa.array(odd), "", texts) if odd.any() else texts
        size = pc.binary_length(plain).to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        data = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(plain)], pa.int32()), plain), "")[0].as_buffer().to_pybytes()
        data, edges, first = self._cut(data, ends)
        ids, each = self._table.ids(data, edges)
        start = np.concatenate([[0], np.cumsum(each)])[first]
        if odd.any():
            return self._with_odd(texts, odd, ids, start)
        return ids, start

    def _with_odd(self, texts, odd, ids, start):
        """The same with the texts that the library has to see whole."""
        at = np.flatnonzero(odd)
        whole = dict(zip(at.tolist(), self._whole([texts[i].as_py() for i in at.tolist()])))
        parts = [np.frombuffer(whole[i], "<u4") if i in whole else ids[start[i]:start[i + 1]] for i in range(len(texts))]
        return np.concatenate([np.zeros(0, np.uint32), *parts]), np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int64)


# the kind of each byte where blanks are dropped: mark, letter, digit, blank, part of a longer character
_KIND = np.zeros(256, np.int8)
_KIND[[*range(65, 91), *range(97, 123)]] = 1
_KIND[48:58] = 2
_KIND[[9, 10, 11, 12, 13, 32]] = 3
_KIND[128:] = 4
# Latin letters that normalization leaves alone but for their case
_CALM = np.array([c >= 0xC0 and chr(c).isalpha() and unicodedata.is_normalized("NFC", chr(c)) and len(chr(c).lower()) == 1
                  and ord(chr(c).lower()) < 0x250 and unicodedata.is_normalized("NFC", chr(c).lower()) for c in range(0x250)])
_CALM_TEXT = re.compile(rb"(?:[\x00-\x7f]|" + b"|".join(
    bytes([lead]) + b"[" + b"".join(re.escape(bytes([0x80 | c & 63])) for c in range((lead & 31) << 6, ((lead & 31) + 1) << 6)
                                    if c < 0x250 and _CALM[c]) + b"]"
    for lead in range(0xC3, 0xC9)) + rb")*")


def cut_words(data: np.ndarray, ends: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """As :meth:`Encoder._cut` for tokenizers that drop blanks.  Words of ASCII and
    plain Latin letters are cut into runs of letters, digits one by one, runs of marks, and an English ending
    with the ``'`` before it; words with other characters, which normalization may change, stay whole."""
    n = len(data)
    kind = _KIND[data]
    lead = np.flatnonzero((data >= 0xC3) & (data < 0xCA))
    if len(lead):
        point = (data[lead].astype(np.int64) & 31) << 6 | data[lead + 1] & 63
        lead = lead[_CALM[np.minimum(point, 0x24F)] & (point < 0x250)]
        kind[lead] = kind[lead + 1] = 1
    opens = np.zeros(n + 4, bool)
    opens[ends] = opens[n] = True
    blank = kind == 3
    word = np.zeros(n + 4, bool)                        # a word begins, or a blank run, or a text
    word[:n] = opens[:n]
    word[1:n] |= blank[1:] != blank[:-1]
    number = np.cumsum(word[:n]) - 1
    wide = np.zeros(number[-1] + 1 if n else 0, bool)
    wide[number[kind == 4]] = True
    narrow = ~wide[number] if n else np.zeros(0, bool)
    start = word.copy()
    start[1:n] |= narrow[1:] & ((kind[1:] != kind[:-1]) | (kind[1:] == 2))
    quote = np.flatnonzero((data == 39) & start[:n] & ~opens[1:n + 1] & narrow)
    if len(quote):
        ahead = np.concatenate([data | 32, np.zeros(4, np.uint8)])          # marks don't become letters by that
        letter = np.concatenate([kind == 1, np.zeros(4, bool)])
        a = np.where(letter[quote + 1], ahead[quote + 1], 0)
        b = np.where(letter[quote + 2] & ~opens[quote + 2], ahead[quote + 2], 0)
        two = np.isin(a, [ord(c) for c in "stmd"])
        three = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
        for k, those in ((2, quote[two]), (3, quote[three])):
            for d in range(1, k):
                start[those + d] = False
            start[those + k] = True
        start |= word                                   # an ending stops where its word does
    keep = ~blank
    before = np.concatenate([[0], np.cumsum(keep)])
    first = np.flatnonzero(start[:n] & keep)
    return data[keep].tobytes(), np.append(before[first], before[-1]), np.searchsorted(first, ends)


def runs(texts: pa.Array, most: int = 4 << 20) -> Iterator[tuple[int, pa.Array]]:
    """(first row, texts): consecutive texts, about ``most`` bytes at a time; null becomes empty; no text is cut."""
    texts = pc.fill_null(texts, "")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    first = 0
    while first < len(texts):
        base = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, base + most, "right")))
        yield first, texts.slice(first, last - first)
        first = last


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The task's encoder; one per worker process and file, kept between tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
