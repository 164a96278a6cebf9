"""Byte-level BPE as a streaming transducer with bounded lookahead.

**Sufficient lookahead.**  Take two texts that agree up to byte x and apply the merge
list rule by rule.  Let q be the end of the tokens that both have in common in
the end, and t the last token that both once had at q.  They parted at q when a rule (t, v)
merged t in one of them only; so at t's end the token differed before, and that
difference came, by the same argument, from an earlier rule (t', v') with t' on the
left spine of v (v, its left part, the left part of that, ...), or t's end is x
or beyond.  Hence x - q is at most the greatest sum of left parts along such a
chain of rules, which one pass over the list computes (:attr:`MergeList.lookahead`; it
asks that each rule's parts are bytes or results of earlier rules).  Tokens that
end more than so many bytes before the end of what has been read are
final, whatever follows; and what is behind them is encoded as if it stood alone.

**Encoding.**  :class:`Transducer` cuts the text into pieces as the pre-tokenizer does (a
state machine over character classes), merges each closed piece, and hands out the stable
tokens of a piece that is still open.  It holds one block of text, one window
of an open piece and a bounded table of merged pieces, however long the text.
Pieces are merged many at a time: all pieces of one length are a matrix of ids,
and each round merges the best pair of every row.

**Decoding.**  :class:`TextState` turns the bytes of tokens into text as they come; it
holds back at most the three bytes of an unfinished character.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from kelpie.llm.common import columns, not_null_text
from kelpie.llm.pieces import SPACE, Classes, PieceTable, bytes_before, code_points, piece_starts

BLOCK = 1 << 20         # characters fed at a time
WINDOW = 4096           # bytes of an open piece that are merged at a time, besides the lookahead
SHORT = 40              # longest piece, in bytes, that is merged in a matrix
KNOWN = 200_000         # merged pieces that the table holds
_NONE = np.int32(2**31 - 1)


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable
    Latin-1 stands for itself, the others follow from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    others = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + k): b for k, b in enumerate(others)}}


class MergeList:
    """Vocabulary and merges of a byte-level BPE tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or not pre.get("use_regex", True) \
                or pre.get("add_prefix_space") or spec["normalizer"] or model.get("dropout") \
                or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix") or model.get("ignore_merges"):
            raise ValueError(f"{path} is not a plain byte-level BPE tokenizer")
        for t in spec["added_tokens"]:
            if t["single_word"] or t["lstrip"] or t["rstrip"]:
                raise ValueError(f"{path}: added token {t['content']!r} takes its surroundings")
        letter, vocab = _byte_letters(), model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.spelling: list[bytes] = [b""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in vocab.items():
            self.spelling[i] = bytes(letter[c] for c in token)
        for token, i in self.special.items():
            self.spelling[i] = token.encode()
        self.byte_id = np.zeros(256, np.int32)
        for c, b in letter.items():
            self.byte_id[b] = vocab[c]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.left = np.array([vocab[a] for a, _ in pairs], np.int64)
        self.right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.result = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self.lookahead = self._sufficient_lookahead()
        self._vocabulary = len(self.spelling)
        self._table()

    def _sufficient_lookahead(self) -> int:
        """Greatest sum of left parts, in bytes, along a chain of rules in which each
        rule's left part is on the left spine of the next rule's right part."""
        reach: dict[int, int] = {}              # left part -> longest chain of earlier rules that ends with it
        spine: dict[int, int] = {}              # result -> its left part
        made = set(self.byte_id.tolist())
        for a, b, c in zip(self.left.tolist(), self.right.tolist(), self.result.tolist()):
            if a not in made or b not in made or c in made:
                raise ValueError("a merge whose parts aren't bytes or earlier results, or whose result isn't new")
            most, t = 0, b
            while t is not None:
                most, t = max(most, reach.get(t, 0)), spine.get(t)
            reach[a] = max(reach.get(a, 0), most + len(self.spelling[a]))
            spine[c] = a
            made.add(c)
        return max(reach.values(), default=0)

    # rank of a pair: an open-addressing table for arrays, a dict for single pairs
    def _table(self) -> None:
        key = self.left * self._vocabulary + self.right
        bits = max(4, int(len(key)).bit_length() + 2)
        self._shift, self._mask = np.uint64(64 - bits), (1 << bits) - 1
        self._keys, self._ranks = np.full(1 << bits, -1, np.int64), np.full(1 << bits, _NONE, np.int32)
        rest, at = np.arange(len(key)), self._slot(key)
        while len(rest):
            free = self._keys[at] < 0
            first = np.zeros(len(rest), bool)
            first[np.unique(at, return_index=True)[1]] = True
            put = free & first
            self._keys[at[put]], self._ranks[at[put]] = key[rest[put]], rest[put]
            rest, at = rest[~put], (at[~put] + 1) & self._mask
        self._pair = dict(zip(key.tolist(), range(len(key))))

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self._shift).astype(np.int64)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``_NONE`` if no rule merges it."""
        key = a.astype(np.int64).ravel() * self._vocabulary + b.ravel()
        out = np.full(len(key), _NONE, np.int32)
        rest, at = np.arange(len(key)), self._slot(key)
        while len(rest):
            held = self._keys[at]
            hit = held == key[rest]
            out[rest[hit]] = self._ranks[at[hit]]
            more = ~hit & (held >= 0)
            rest, at = rest[more], (at[more] + 1) & self._mask
        return out.reshape(a.shape)

    def merge(self, data: bytes) -> list[int]:
        """Ids of one piece: best rank first, leftmost among equals."""
        ids: list[int | None] = self.byte_id[np.frombuffer(data, np.uint8)].tolist()
        n, v, pair, result = len(ids), self._vocabulary, self._pair, self.result
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := pair.get(ids[i] * v + ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue                                # one of the two has been merged since
            ids[i], ids[j] = int(result[r]), None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := pair.get(ids[i] * v + ids[k])) is not None:
                    heapq.heappush(heap, (r, i, ids[i], ids[k]))
            if (h := before[i]) >= 0 and (r := pair.get(ids[h] * v + ids[i])) is not None:
                heapq.heappush(heap, (r, h, ids[h], ids[i]))
        return [t for t in ids if t is not None]

    def merge_equal(self, ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Rows of one length: (which rows, their ids), as many ids each."""
        rows, out = np.arange(len(ids)), []
        rank = self.ranks(ids[:, :-1], ids[:, 1:])
        while len(rows):
            width = ids.shape[1]
            if width == 1:
                out.append((rows, ids))
                break
            j = rank.argmin(1)
            best = rank[np.arange(len(rows)), j]
            done = best == _NONE
            if done.any():
                out.append((rows[done], ids[done]))
                going = ~done
                rows, ids, rank, j, best = rows[going], ids[going], rank[going], j[going], best[going]
            m = np.arange(len(rows))
            keep = np.ones(ids.shape, bool)
            keep[m, j + 1] = False
            ids = ids[keep].reshape(len(rows), width - 1)
            ids[m, j] = self.result[best]
            keep = np.ones(rank.shape, bool)
            keep[m, j] = False
            rank = rank[keep].reshape(len(rows), width - 2)
            has = np.flatnonzero(j < width - 2)         # the pair that now begins at j, and the one that ends there
            rank[has, j[has]] = self.ranks(ids[has, j[has]], ids[has, j[has] + 1])
            has = np.flatnonzero(j > 0)
            rank[has, j[has] - 1] = self.ranks(ids[has, j[has] - 1], ids[has, j[has]])
        return out


class Transducer:
    """Encodes texts; one per worker process and file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.merges, self.kinds = MergeList(path), Classes(Tokenizer.from_file(path))
        self._table = PieceTable(self._learn, KNOWN)

    def _learn(self, new: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of closed pieces: (flat, how many each)."""
        length = np.fromiter(map(len, new), np.int64, len(new))
        data = np.frombuffer(b"".join(new), np.uint8)
        at = np.concatenate([[0], np.cumsum(length)])
        width, found = np.zeros(len(new), np.int64), []
        for n in np.unique(length).tolist():
            those = np.flatnonzero(length == n)
            if n > SHORT:
                for k in those.tolist():
                    ids = np.concatenate([np.array(x, np.int32) for x in self._open_piece([new[k]])])
                    width[k] = len(ids)
                    found.append((np.array([k]), ids[None]))
                continue
            for rows, ids in self.merges.merge_equal(self.merges.byte_id[data[at[those][:, None] + np.arange(n)]]):
                width[those[rows]] = ids.shape[1]
                found.append((those[rows], ids))
        place = np.concatenate([[0], np.cumsum(width)])
        flat = np.zeros(place[-1], np.uint32)
        for rows, ids in found:
            flat[place[rows][:, None] + np.arange(ids.shape[1])] = ids
        return flat, width

    def _open_piece(self, parts) -> Iterator[list[int]]:
        """Ids of one piece that comes in parts: tokens as soon as they are stable."""
        held = b""
        for part in parts:
            for i in range(0, len(part), WINDOW):
                held += part[i:i + WINDOW]
                if len(held) > WINDOW + self.merges.lookahead:
                    stable, done = [], 0
                    for t in self.merges.merge(held):
                        n = len(self.merges.spelling[t])
                        if done + n > len(held) - self.merges.lookahead:
                            break
                        stable.append(t)
                        done += n
                    held = held[done:]
                    yield stable
        yield self.merges.merge(held) if held else []

    def batch(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of whole short texts without special tokens, cut and merged together."""
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        data = b"".join(raw)
        points = code_points(data)
        size = bytes_before(points)
        ends = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        starts = piece_starts(points, self.kinds(points), ends[:-1][np.diff(ends) > 0])
        ids, each = self._table.ids(data, np.concatenate([size[starts], size[-1:]]))
        before = np.concatenate([[0], np.cumsum(each)])
        cut = before[np.searchsorted(starts, ends)]
        return [ids[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]

    def stream(self, blocks) -> Iterator[np.ndarray]:
        """Ids of one text that comes in blocks, as soon as they are stable."""
        marks = self.merges.special
        if not marks:
            yield from self._plain(blocks)
            return
        waiting, ended = iter(blocks), False
        held = ""
        while not ended:
            found: list[str] = []

            def until_mark():
                """Blocks up to the next special token."""
                nonlocal held, ended
                while True:
                    at, mark = min(((held.find(m), m) for m in marks if m in held), default=(-1, None),
                                   key=lambda x: (x[0], -len(x[1])))
                    if mark is not None:
                        found.append(mark)
                        text, held = held[:at], held[at + len(mark):]
                        yield text
                        return
                    keep = max(k for m in marks for k in range(len(m)) if held.endswith(m[:k]))
                    text, held = held[:len(held) - keep], held[len(held) - keep:]
                    yield text
                    more = next(waiting, None)
                    if more is None:
                        text, held, ended = held, "", True
                        yield text
                        return
                    held += more

            yield from self._plain(until_mark())
            if found:
                yield np.array([marks[found[0]]], np.uint32)

    def _plain(self, blocks) -> Iterator[np.ndarray]:
        """:meth:`stream` without special tokens."""
        tail, waiting = "", iter(blocks)
        block = next(waiting, None)
        while block is not None:
            following = next(waiting, None)
            text, last = tail + block, following is None
            data = text.encode("utf-8", "surrogatepass")
            points = code_points(data)
            kind = self.kinds(points)
            starts = piece_starts(points, kind, np.zeros(min(1, len(points)), np.int64))
            n, safe = len(starts), len(starts)
            if not last:        # a piece is closed when something follows it, and three characters follow a quote
                while safe and ((starts[safe] if safe < n else len(points)) >= len(points)
                                or points[starts[safe - 1]] == 39 and starts[safe - 1] + 3 > len(points)):
                    safe -= 1
            size = bytes_before(points)
            edges = np.append(starts, len(points))
            if safe:
                yield self._table.ids(data, size[edges[:safe + 1]])[0]
            tail = text[edges[safe]:]
            if len(tail) > WINDOW and not last:
                # an open run: its tokens leave as they become stable
                rest: list[str] = []
                parts = self._run(tail, int(kind[-1]), following, waiting, rest)
                for ids in self._open_piece(parts):
                    yield np.array(ids, np.uint32)
                tail, following = rest if len(rest) == 2 else ("", None)
            block = following

    def _run(self, tail: str, kind: int, block: str | None, waiting, rest: list) -> Iterator[bytes]:
        """The parts of an open run of one class; ``rest`` gets the text behind it and the next block."""
        keep = kind == SPACE                   # the last blank may belong to the next piece
        held = tail
        while block is not None:
            yield held[:len(held) - keep].encode("utf-8", "surrogatepass")
            held = held[len(held) - keep:]
            other = np.flatnonzero(self.kinds(code_points(block.encode("utf-8", "surrogatepass"))) != kind)
            if len(other):
                run = held + block[:other[0]]
                yield run[:len(run) - keep].encode("utf-8", "surrogatepass")
                rest += [run[len(run) - keep:], block[other[0]:]]
                return
            held, block = held + block, next(waiting, None)
        yield held.encode("utf-8", "surrogatepass")

    def encode(self, texts: list[str]) -> Iterator[Iterator[np.ndarray]]:
        """For each text in order its ids in parts."""
        marks, held, size = list(self.merges.special), [], 0
        for t in texts:
            whole = len(t) <= BLOCK and not any(m in t for m in marks)
            if held and (not whole or size + len(t) > BLOCK):
                yield from (iter((ids,)) for ids in self.batch(held))
                held, size = [], 0
            if whole:
                held.append(t)
                size += len(t)
            else:
                yield self.stream(t[i:i + BLOCK] for i in range(0, len(t), BLOCK))
        if held:
            yield from (iter((ids,)) for ids in self.batch(held))


class TextState:
    """Bytes of tokens to text, as they come."""

    def __init__(self):
        self._held = b""

    def feed(self, data: bytes) -> str:
        data = self._held + data
        cut = len(data)
        for back in range(1, min(3, cut) + 1):
            lead = data[-back]
            if lead >= 0xC0:                    # a character begins here; it waits if it isn't whole
                if back < (2 if lead < 0xE0 else 3 if lead < 0xF0 else 4):
                    cut -= back
                break
            if lead < 0x80:
                break
        self._held = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def finish(self) -> str:
        text, self._held = self._held.decode("utf-8", "replace"), b""
        return text


def decode(merges: MergeList, parts) -> Iterator[str]:
    """Text of ids that come in parts, special tokens included; ids without a token give nothing."""
    state, spelling = TextState(), merges.spelling
    for ids in parts:
        yield state.feed(b"".join([spelling[i] for i in ids.tolist() if i < len(spelling)]))
    yield state.finish()


_made: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    if path not in _made:
        _made[path] = Transducer(path)
    return _made[path]


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and ids (little-endian unsigned 32-bit integers) of every whole text of
    ``docs`` (doc_id, text), equal to the library's with its special tokens recognised
    in the text and none added.  A null text is empty and has no ids.  Each row is
    encoded by itself: null and repeated ids and rows give a row each.  Other columns
    are ignored; an empty table gives no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = [np.concatenate([np.zeros(0, np.uint32), *x]) for x in transducer(path).encode(b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(x) for x in ids], pa.int64()),
                 pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary())], ["doc_id", "n_tokens", "ids"])

    return _source(docs).mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of ``encoded`` (doc_id, ids as :func:`encode_documents` gives them); null ids are none.
    Bytes that are no UTF-8 become U+FFFD, as in the library."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = ["".join(decode(transducer(path).merges, [np.frombuffer(x or b"", "<u4")])) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return columns(encoded, doc_id="long", ids="binary").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 per document: encoded, hashed and decoded
    part by part, so no more of a long text than a block is held as ids.  Rows as in :func:`encode_documents`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            machine, rows = transducer(path), []
            for parts in machine.encode(b.column(1).to_pylist()):
                seen = [0, hashlib.sha256(), hashlib.sha256()]

                def counted():
                    for ids in parts:
                        seen[0] += len(ids)
                        seen[1].update(ids.astype("<u4").tobytes())
                        yield ids

                for text in decode(machine.merges, counted()):
                    seen[2].update(text.encode("utf-8", "surrogatepass"))
                rows.append((seen[0], seen[1].hexdigest(), seen[2].hexdigest()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array([r[k] for r in rows], t) for k, t in
                                enumerate((pa.int64(), pa.string(), pa.string())))],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _source(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _source(docs: DataFrame) -> DataFrame:
    return columns(docs, doc_id="long", text="string").withColumn("text", not_null_text())
