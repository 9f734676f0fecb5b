"""Encoding and decoding with the pieces of a SentencePiece model.

The pieces with their scores are read from a model file.  A text is cut into
the pieces with the highest sum of scores (Viterbi over a double-array trie of
the pieces' UTF-8 bytes).  White space is marked before and turned back after;
a character that no piece has becomes its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.common import column, utf8

MARK = "▁".encode()
#: What a character without a piece costs, below the lowest score.
UNKNOWN_PENALTY = 10.0
#: Segments a worker remembers the pieces of.
REMEMBERED = 250_000


class Trie:
    """A double-array trie of byte strings: the child of state s by byte b is ``base[s] + b`` if ``check`` there is s."""

    def __init__(self, keys: list[bytes]):
        children: list[dict[int, int]] = [{}]
        value = [-1]
        for i, key in enumerate(keys):
            node = 0
            for b in key:
                if b not in children[node]:
                    children[node][b] = len(children)
                    children.append({})
                    value.append(-1)
                node = children[node][b]
            value[node] = i
        size = 1024
        self.base, self.check = np.zeros(size, np.int32), np.full(size, -1, np.int32)
        self.value = np.full(size, -1, np.int32)
        used = np.zeros(size, bool)
        used[0], todo, lowest = True, [(0, 0)], 1
        self.value[0] = value[0]
        while todo:
            node, state = todo.pop()
            own = np.array(sorted(children[node]), np.int64)
            if not len(own):
                continue
            base = max(lowest - int(own[0]), 1)
            while True:
                if base + 512 > len(used):
                    more = len(used)
                    used = np.concatenate([used, np.zeros(more, bool)])
                    self.base, self.check, self.value = (
                        np.concatenate([a, np.full(more, fill, np.int32)])
                        for a, fill in ((self.base, 0), (self.check, -1), (self.value, -1))
                    )
                free = np.flatnonzero(~used[base + own[0] : len(used) - 256])
                fits = next((base + int(f) for f in free[:64] if not used[base + int(f) + own].any()), None)
                if fits is not None:
                    base = fits
                    break
                base += int(free[min(63, len(free) - 1)]) + 1 if len(free) else 256
            self.base[state] = base
            for b in own:
                at = base + int(b)
                used[at], self.check[at] = True, state
                self.value[at] = value[children[node][int(b)]]
                todo.append((children[node][int(b)], at))
            while used[lowest]:
                lowest += 1

    def step(self, states: np.ndarray, by: np.ndarray) -> np.ndarray:
        """The next states, -1 where there is none."""
        to = self.base[states] + by
        return np.where(self.check[to] == states, to, -1)


class Pieces:
    """The pieces of a model file, and what they make of texts."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.unknown = model.unk_id()
        self.text = [b""] * n
        self.byte = np.full(256, -1, np.int64)
        self.special = np.zeros(n, bool)
        normal = []
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
                self.text[i] = bytes([int(piece[3:5], 16)])
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.special[i] = True
            else:
                normal.append(i)
                self.text[i] = piece.encode()
        self.ids = np.array(normal)
        self.score = np.array([model.get_score(i) for i in normal])
        self.cost = (self.score.min() if len(normal) else 0.0) - UNKNOWN_PENALTY
        self.longest = max((len(self.text[i]) for i in normal), default=0)
        #: No piece has a mark after another character, so that a text may be cut before each mark that follows one.
        self.cuts = not any(MARK in self._unmarked(self.text[i]) for i in normal)
        sizes = np.array([len(t) for t in self.text])
        self.flat, self.size = np.frombuffer(b"".join(self.text), np.uint8), sizes
        self.begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        self.forget()

    @cached_property
    def trie(self) -> Trie:
        return Trie([self.text[i] for i in self.ids])

    @staticmethod
    def _unmarked(piece: bytes) -> bytes:
        while piece.startswith(MARK):
            piece = piece[len(MARK) :]
        return piece

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.held = np.zeros(1 << 16, np.int32)
        self.held_begin = np.zeros(1, np.int64)
        self.end = 0

    # Viterbi ----------------------------------------------------------------------------------------------------------

    def best(self, segments: list[bytes]) -> list[np.ndarray]:
        """The ids of each segment, all segments side by side; of equal sums the one whose last pieces are longest.

        ``total[i, p]`` is the best sum for the first p bytes of segment i, and
        ``back[i, p]`` the begin of its last piece.
        """
        n, length = len(segments), np.array([len(s) for s in segments])
        width = int(length.max())
        data = np.zeros((n, width + 1), np.uint8)
        flat = np.frombuffer(b"".join(segments), np.uint8)
        row = np.repeat(np.arange(n), length)
        data[row, np.arange(len(flat)) - np.repeat(np.cumsum(length) - length, length)] = flat
        total = np.full((n, width + 1), -np.inf)
        total[:, 0] = 0
        back = np.zeros((n, width + 1), np.int32)
        piece = np.full((n, width + 1), -1, np.int32)
        char = (data & 0xC0) != 0x80  # where a character begins
        for p in range(width):
            rows = np.flatnonzero((length > p) & char[:, p])
            if not len(rows):
                continue
            first = data[rows, p]
            size = 1 + (first >= 0xC0) + (first >= 0xE0).astype(int) + (first >= 0xF0)
            here = total[rows, p]
            alone = np.zeros(len(rows), bool)  # whether a piece is just the one character
            state, at = np.zeros(len(rows), np.int64), np.arange(len(rows))
            for q in range(p, min(p + self.longest, width)):
                inside = q < length[rows[at]]
                at, state = at[inside], state[inside]
                state = self.trie.step(state, data[rows[at], q])
                at, state = at[state >= 0], state[state >= 0]
                if not len(at):
                    break
                value = self.trie.value[state]
                ends = value >= 0
                who, what = at[ends], value[ends]
                alone[who[q + 1 - p == size[who]]] = True
                self._reach(total, back, piece, rows[who], q + 1, here[who] + self.score[what], p, what)
            lone = np.flatnonzero(~alone)
            for k in np.unique(size[lone]):
                who = lone[size[lone] == k]
                to = np.minimum(p + k, length[rows[who]])
                for end in np.unique(to):
                    same = who[to == end]
                    self._reach(total, back, piece, rows[same], int(end), here[same] + self.cost, p, np.full(len(same), -1))
        return [self._path(segments[i], back[i], piece[i]) for i in range(n)]

    @staticmethod
    def _reach(total, back, piece, rows, end, sums, begin, what) -> None:
        better = sums > total[rows, end]
        rows = rows[better]
        total[rows, end], back[rows, end], piece[rows, end] = sums[better], begin, what[better]

    def _path(self, segment: bytes, back: np.ndarray, piece: np.ndarray) -> np.ndarray:
        found, p = [], len(segment)
        while p:
            begin = int(back[p])
            if piece[p] >= 0:
                found.append(int(self.ids[piece[p]]))
            elif (self.byte >= 0).all():
                found.extend(int(self.byte[b]) for b in reversed(segment[begin:p]))
            else:
                found.append(self.unknown)
            p = begin
        return np.array(found[::-1], np.int32)

    # Texts ------------------------------------------------------------------------------------------------------------

    def segments(self, text: bytes) -> list[bytes]:
        """A text with its white space marked, cut where no piece can stand across.

        A space is put before the text, and every space becomes a mark.  Cuts
        are before a run of marks.
        """
        if not text:
            return []
        marked = MARK + text.replace(b" ", MARK)
        if not self.cuts:
            return [marked]
        parts = marked.split(MARK)
        # An empty part is a mark followed by another one; runs of them go to the part that ends them.
        found, run = [], 0
        if parts[0]:
            found.append(parts[0])
        for part in parts[1:]:
            run += 1
            if part:
                found.append(MARK * run + part)
                run = 0
        if run:
            found.append(MARK * run)
        return found

    def learn(self, segments: list[bytes]) -> None:
        segments = sorted(segments, key=len)
        i = 0
        while i < len(segments):  # about 2 MB of bytes side by side
            j = min(len(segments), i + max(1, (1 << 20) // len(segments[min(len(segments), i + 20_000) - 1])))
            j = min(j, i + 20_000)
            found = self.best(segments[i:j])
            sizes = np.array([len(f) for f in found])
            flat = np.concatenate(found)
            if self.end + len(flat) > len(self.held):
                self.held = np.concatenate([self.held[: self.end], np.zeros(self.end + 2 * len(flat), np.int32)])
            self.held[self.end : self.end + len(flat)] = flat
            self.held_begin = np.concatenate([self.held_begin, self.end + np.cumsum(sizes)])
            self.end += len(flat)
            self.known.update(zip(segments[i:j], range(len(self.known), len(self.known) + j - i), strict=True))
            i = j

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and how many each has."""
        split = [self.segments(t) for t in texts]
        new = {s for one in split for s in one if s not in self.known}
        if len(self.known) + len(new) > REMEMBERED:
            self.forget()
            new = {s for one in split for s in one}
        self.learn(list(new))
        n = np.array([len(one) for one in split], np.int64)
        which = np.fromiter((self.known[s] for one in split for s in one), np.int64, int(n.sum()))
        begin, size = self.held_begin[which], self.held_begin[which + 1] - self.held_begin[which]
        total = np.cumsum(size)
        ids = self.held[np.arange(total[-1] if len(total) else 0) + np.repeat(begin - total + size, size)]
        ends = np.concatenate([[0], total])[np.cumsum(n)]
        return ids, np.diff(np.concatenate([[0], ends]))

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        """The texts of runs of ids: special ids say nothing, marks are spaces, the one put before is taken off."""
        size = self.size[ids]
        total = np.cumsum(size)
        chars = self.flat[np.arange(total[-1] if len(total) else 0) + np.repeat(self.begin[ids] - total + size, size)].tobytes()
        ends = np.concatenate([[0], total])[np.cumsum(sizes)]
        found, begin = [], 0
        for end in ends:
            text = chars[begin:end].replace(MARK, b" ")
            found.append(text[1:] if text.startswith(b" ") else text)
            begin = int(end)
        return found


_MODELS: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    """The worker's pieces of that file, kept from task to task."""
    if path not in _MODELS:
        _MODELS[path] = Pieces(path)
    return _MODELS[path]


def _parts(batch: pa.Array, texts: int = 500) -> Iterator[pa.Array]:
    for i in range(0, len(batch), texts):
        yield batch.slice(i, texts)


def encode(
    docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", *, decoded: bool = False
) -> DataFrame:
    """(doc_id, ids), one row for each row of ``docs``; ``ids`` is null for a null text and empty for an empty one.

    With ``decoded`` there is a column ``text`` too: what ``decode`` gives for
    the ids, made in the same task, so that the ids are not handed over twice.

    ``model`` is a SentencePiece file with normalisation off; its pieces and
    scores are taken as they are.  Rows with the same id, null ids among them,
    are encoded each for itself; an empty table gives no rows; other columns
    are ignored.
    """

    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = pieces(model)
        for batch in batches:
            lists, texts = [pa.array([], pa.list_(pa.int32()))], [pa.array([], pa.string())]
            for part in _parts(batch):
                flat, sizes = own.encode(utf8(part))
                ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                lists.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32())))
                if decoded:
                    texts.append(_strings(own.decode(flat, sizes)))
            columns = [pa.concat_arrays(lists), pa.concat_arrays(texts)]
            yield pa.StructArray.from_arrays(columns[: 1 + decoded], ["ids", "text"][: 1 + decoded])

    text = column(text_col).cast("string")
    result = F.arrow_udf(found, "ids array<int>" + ", text string" * decoded)(text)
    known = docs.select(column(id_col).alias("doc_id"), F.when(text.isNotNull(), result).alias("found"))
    return known.select("doc_id", "found.*")


def _strings(texts: list[bytes]) -> pa.Array:
    return pa.array([t.decode("utf-8", "replace") for t in texts], pa.string())


def decode(encoded: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``id_col`` as doc_id, its ids, and their text; null ids give null.

    Bytes that make no UTF-8 become replacement characters.  Ids outside the
    model raise an error.
    """

    def texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = [pa.array([], pa.string())]
            for part in _parts(batch):
                filled = part.fill_null(pa.scalar([], part.type)) if part.null_count else part
                flat = filled.flatten().to_numpy(zero_copy_only=False)
                sizes = np.asarray(filled.value_lengths(), np.int64)
                found.append(_strings(pieces(model).decode(flat, sizes)))
            yield pa.concat_arrays(found)

    ids = column(ids_col)
    decoded = F.arrow_udf(texts, "string")(ids)
    return encoded.select(column(id_col).alias("doc_id"), ids.alias("ids"), F.when(ids.isNotNull(), decoded).alias("text"))
