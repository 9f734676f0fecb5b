"""Packing token sequences with the sum-of-squares rule.

Documents come one by one.  The open windows are known by their fill level
only: ``counts[h]`` of them hold h tokens.  A document goes to the level that
leaves the sum of the squared counts least, which keeps a few windows open at
every level, so that a fitting one is there for most documents.  What is left
open at the end of a task is cut and joined to whole windows, and the last
rest to windows whose sizes are powers of two, which need no padding.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from evenkeel.llm.common import WordHash, column, mixed, tidy, utf8, whole_text

WINDOW = 4096
END = 2
#: Windows that a task keeps open; beyond it the open ones are cut and joined.
MOST_OPEN = 4096
#: Stretches of text a worker remembers the ids of, at 50 bytes each, about.
REMEMBERED = 250_000
#: Bytes of text that are looked at together.
WINDOW_BYTES = 1 << 20
_SPACES = re.compile(rb"[\t-\r ]")

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


# What the tokenizer's pattern tells apart in ASCII, after it has lower-cased: runs of letters, single digits, runs of
# anything else.  An apostrophe can begin a contraction, a bar is in the names of special tokens, and other bytes are
# parts of letters or marks: words with them are looked at whole.
_SPACE, _LETTER, _DIGIT, _MARK, _WHOLE = range(5)
_KIND = np.full(256, _MARK, np.uint8)
_KIND[[0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20]] = _SPACE
_KIND[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1)]] = _LETTER
_KIND[ord("0") : ord("9") + 1] = _DIGIT
_KIND[[ord("'"), ord("|")]] = _WHOLE
_KIND[128:] = _WHOLE
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_HASHES = (WordHash(0x9E3779B97F4A7C15), WordHash(0xC2B2AE3D27D4EB4F))


class WordEncoder:
    """Ids of texts by a tokenizer that drops white space, lower-cases, and cuts as ``word_bpe`` does.

    All stretches of a window of text that the tokenizer takes by themselves are
    found and hashed together; each distinct one that is not known is encoded
    once, many in one call.  Known ones are remembered in arrays of fixed size,
    by 128 bits of hash.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.forget()

    def forget(self) -> None:
        self.one, self.other = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.begin, self.size, self.used = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        found: list[list[np.ndarray]] = [[] for _ in texts]
        for parts, of in _windows(texts):
            for doc, ids in zip(of, self._window(parts), strict=True):
                found[doc].append(ids)
        return [ids[0] if len(ids) == 1 else np.concatenate(ids) if ids else np.zeros(0, np.uint32) for ids in found]

    def _window(self, parts: list[bytes]) -> list[np.ndarray]:
        raw = np.frombuffer(b"\n".join([*parts, b""]), np.uint8)
        kind = _KIND[raw]
        inner = np.concatenate([[False], kind != _SPACE, [False]])
        edges = np.flatnonzero(inner[1:] != inner[:-1])
        word, word_end = edges[::2], edges[1::2]
        special = np.concatenate([[0], np.cumsum(kind == _WHOLE)])
        whole = special[word_end] > special[word]
        inside = np.zeros(len(raw) + 1, np.int8)
        inside[word[whole]] += 1
        inside[word_end[whole]] -= 1
        inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
        begins = np.zeros(len(raw) + 1, bool)
        begins[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        begins[:-1] &= ~inside & (kind != _SPACE)
        begins[word] = True
        start = np.flatnonzero(begins)
        end = np.flatnonzero(inner[1:-1] & (begins[1:] | ~inner[2:])) + 1
        text = np.where(inside, raw, _LOWER[raw])
        rows = self._rows(text, start, end)
        size = self.size[rows]
        at = np.cumsum(size)
        ids = self.ids[np.arange(at[-1] if len(at) else 0) + np.repeat(self.begin[rows] - at + size, size)]
        lengths = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
        tokens = np.searchsorted(start, np.cumsum(lengths))
        cuts = np.concatenate([[0], at])[tokens]
        self._trim()
        return np.split(ids, cuts[:-1]) if len(cuts) else []

    def _rows(self, text: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The row of each stretch among the known ones, which then have all of them."""
        one, other = (h(text, start, end) for h in _HASHES)
        distinct, first, of = np.unique(one, return_index=True, return_inverse=True)
        if (other != other[first][of]).any():  # two stretches share a hash: both hashes in one
            one = mixed(one ^ mixed(other))
            distinct, first, of = np.unique(one, return_index=True, return_inverse=True)
        second = other[first]
        at = np.searchsorted(self.one, distinct)
        at[at == len(self.one)] = 0
        known = (self.one[at] == distinct) & (self.other[at] == second) if len(self.one) else np.zeros(len(distinct), bool)
        if len(self.one) and ((self.one[at] == distinct) & ~known).any():  # one that is known shares a hash with a new one
            self.forget()
            known[:] = False
        new = np.flatnonzero(~known)
        if len(new):
            content = text.tobytes()
            self._learn([content[s:e] for s, e in zip(start[first[new]].tolist(), end[first[new]].tolist(), strict=True)], distinct[new], second[new])
            at = np.searchsorted(self.one, distinct)
        self.used[at] += 1
        return at[of]

    def _learn(self, stretches: list[bytes], one: np.ndarray, other: np.ndarray) -> None:
        ids, sizes = [], []
        for i in range(0, len(stretches), 500):
            some = [s.decode("utf-8", "replace") for s in stretches[i : i + 500]]
            encoded = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            begin = np.cumsum([0, *(len(s) + 1 for s in some)])
            place = np.array([o[0] for o in encoded.offsets], np.int64)
            ids.append(np.array(encoded.ids, np.uint32))
            sizes.append(np.bincount(np.searchsorted(begin, place, side="right") - 1, minlength=len(some)))
        size = np.concatenate(sizes)
        begin = len(self.ids) + np.cumsum(size) - size
        self.ids = np.concatenate([self.ids, *ids])
        order = np.argsort(all_one := np.concatenate([self.one, one]), kind="stable")
        self.one = all_one[order]
        self.other, self.begin, self.size, self.used = (
            np.concatenate(pair)[order] for pair in
            ((self.other, other), (self.begin, begin), (self.size, size), (self.used, np.zeros(len(one), np.int64)))
        )

    def _trim(self) -> None:
        """Beyond what may be remembered, only the half that was met most often stays; long stretches never do."""
        if len(self.one) <= REMEMBERED and len(self.ids) <= 8 * REMEMBERED:
            return
        short = self.size <= 64
        kept = np.sort(np.argsort(np.where(short, -self.used, 1), kind="stable")[: min(REMEMBERED // 2, int(short.sum()))])
        size, begin = self.size[kept], self.begin[kept]
        at = np.cumsum(size)
        self.ids = self.ids[np.arange(at[-1] if len(at) else 0) + np.repeat(begin - at + size, size)]
        self.one, self.other, self.used = self.one[kept], self.other[kept], self.used[kept] // 2
        self.begin, self.size = at - size, size


def _windows(texts: list[bytes], most: int = WINDOW_BYTES) -> Iterator[tuple[list[bytes], list[int]]]:
    """Texts, and long ones in parts cut at white space, put together; and whose they are."""
    parts: list[bytes] = []
    of: list[int] = []
    size = 0
    for doc, text in enumerate(texts):
        begin = 0
        while begin < len(text):
            end = len(text)
            if end - begin > most:
                space = _SPACES.search(text, begin + most)
                end = space.end() if space else end
            parts.append(text[begin:end] if begin or end < len(text) else text)
            of.append(doc)
            size += end - begin
            begin = end
            if size >= most:
                yield parts, of
                parts, of, size = [], [], 0
    if parts:
        yield parts, of


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The worker's encoder of that file, kept from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


class Levels:
    """The level array of the sum-of-squares rule."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.counts = np.zeros(window, np.int64)  # counts[0] stays 0: an empty window is not open

    def choose(self, size: int) -> int:
        """The level to put ``size`` (below the window) on: 0 for a new window.  Of equal choices the fullest.

        Moving a window from h to h + size changes the sum of squares by
        2 * (counts[h + size] - counts[h] + 1); a full or a new window has no
        count to change.
        """
        counts, window = self.counts, self.window
        room = counts[: window - size + 1]
        change = 2 - 2 * room
        change[: window - size] += 2 * counts[size:]
        change[window - size] -= 1
        change[0] -= 1
        change[1:][room[1:] == 0] = np.iinfo(np.int64).max
        best = len(room) - 1 - int(np.argmin(change[::-1]))
        if best:
            counts[best] -= 1
        if best + size < window:
            counts[best + size] += 1
        return best


class Packer:
    """Packs one task's documents; gives pieces as their windows close."""

    def __init__(self, first_sequence: int, window: int = WINDOW, most_open: int = MOST_OPEN):
        self.sequence, self.window, self.most_open = first_sequence, window, most_open
        self.rows: list[tuple] = []
        self.clear()

    def clear(self) -> None:
        self.levels = Levels(self.window)
        self.open: dict[int, list[list]] = defaultdict(list)
        self.n_open = 0

    def close(self, pieces: Iterable[tuple]) -> None:
        """Write a sequence of (doc, start, ids, doc_tokens)."""
        offset = 0
        for doc, start, ids, total in pieces:
            crc = zlib.crc32(ids.astype("<u4").tobytes())
            self.rows.append((doc, start, len(ids), crc, total, self.sequence, offset))
            offset += len(ids)
        self.sequence += 1

    def add(self, doc, ids: np.ndarray) -> None:
        whole = len(ids) // self.window * self.window
        for start in range(0, whole, self.window):
            self.close([(doc, start, ids[start : start + self.window], len(ids))])
        size = len(ids) - whole
        if not size:
            return
        level = self.levels.choose(size)
        pieces = self.open[level].pop() if level else []
        pieces.append((doc, whole, ids[whole:].copy(), len(ids)))
        self.n_open += not level
        if level + size == self.window:
            self.close(pieces)
            self.n_open -= 1
        else:
            self.open[level + size].append(pieces)
        if self.n_open > self.most_open:
            self.join(last=False)

    def join(self, last: bool) -> None:
        """Cut and join what is open to whole windows, and at the end the rest to windows of powers of two."""
        left = [p for level in sorted(self.open, reverse=True) for pieces in self.open[level] for p in pieces]
        rest = sum(len(p[2]) for p in left)
        self.clear()
        held: list[tuple] = []
        space = 0
        for doc, start, ids, total in left:
            while len(ids):
                if not space:
                    if rest < self.window and not last:
                        break
                    space = self.window if rest >= self.window else 1 << rest.bit_length() - 1
                cut, ids = ids[:space], ids[space:]
                held.append((doc, start, cut, total))
                start, space, rest = start + len(cut), space - len(cut), rest - len(cut)
                if not space:
                    self.close(held)
                    held = []
            if len(ids):  # less than a window: it is packed on
                self._reopen(doc, start, ids, total)

    def _reopen(self, doc, start: int, ids: np.ndarray, total: int) -> None:
        level = self.levels.choose(len(ids))
        pieces = self.open[level].pop() if level else []
        pieces.append((doc, start, ids, total))
        self.n_open += not level
        if level + len(ids) == self.window:
            self.close(pieces)
            self.n_open -= 1
        else:
            self.open[level + len(ids)].append(pieces)

    def taken(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


def _pack(path: str, end: int, window: int):
    schema = pa.schema([(c.split()[0], pa.int64()) for c in PIECES.split(", ")])

    def batch_of(rows):
        columns = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A task's number is part of its sequences' numbers, so that tasks need not know of each other.
        packer = Packer(TaskContext.get().partitionId() << 40, window)
        encode = encoder(path).encode
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                for doc, ids in zip(part.column(0).to_pylist(), encode(utf8(part.column(1))), strict=True):
                    packer.add(doc, np.append(ids, np.uint32(end)))
                if packer.rows:
                    yield batch_of(packer.taken())
        packer.join(last=True)
        if packer.rows:
            yield batch_of(packer.taken())

    return packed


def pack(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", *, end: int = END, window: int = WINDOW
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset), one row for each piece of a document.

    A document is the ids that the tokenizer file ``tokenizer`` gives its text,
    and ``end``.  Each id is in exactly one piece; the pieces of a sequence
    stand gapless from offset 0 and have ``window`` (a power of two) tokens at
    most.  Documents of a window or more fill sequences of their own; what they
    have left and shorter documents are placed by the sum-of-squares rule.  A
    task packs what it reads, so no text is moved; at its end at most one
    sequence for each power of two is not full, and none needs padding.

    Null and empty texts have only ``end``.  Rows with the same id, null ids
    among them, are packed each for itself.  An empty table gives no rows;
    other columns are ignored.
    """
    rows = docs.select(column(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    return rows.mapInArrow(tidy(_pack(tokenizer, end, window)), PIECES)
