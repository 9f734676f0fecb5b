"""Collocations: word sequences that occur more often together than their parts let expect.

The first pass makes Misra-Gries summaries of all n-grams.  The space of their
64-bit hashes is cut into partitions; a task folds what it reads and sends each
partition its part, which is a summary that has lost nothing.  The partition
merges the parts into one summary with a fixed number of counters: whenever it
holds more, the count that the first one too many has is taken from all, and
what falls to zero goes.  A reduction by c removes c from more than ``capacity``
counters, so with a capacity of the mass divided by the threshold all
reductions together take less than the threshold from any count: every n-gram
as frequent as the threshold survives.  What they took is known, and a counter
that could not reach the threshold with it goes too.  Repeats beyond the
threshold take up no counter of others, so a hot n-gram does no harm; should the
hashes still be so uneven that a reduction would break the promise, it is not made.

The second pass counts the survivors exactly, by their texts.  A bitmap of
bounded size tells n-grams that surely did not survive; those it lets through
wrongly have less than the threshold and fall away once they are counted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from evenkeel.llm.common import WordHash, bitmap_bytes, column, each_utf8, fresh, maybe_held, mixed, whole_text
from evenkeel.sources.workspace import written

UNKNOWN = "und"
#: Bytes of text that are looked at together; words over an edge are kept whole.
TEXT_BYTES = 1 << 21
#: N-grams that a task folds together before it sends them.
FOLD = 1 << 22
#: Counters of a partition's summary, about.
COUNTERS = 1 << 19
#: Counters in one row on their way to a partition.
ROW_COUNTERS = 1 << 10
#: The largest bitmap, as a power of two: 16 MB.
MOST_BITS = 27

_WORD, _BLANK, _BREAK = 0, 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = _BLANK
_KIND[[ord(c) for c in ".,;:!?"] + [0x0A, 0x0B, 0x0C, 0x0D]] = _BREAK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


_HASHES = (WordHash(0x9E3779B97F4A7C15), WordHash(0xC2B2AE3D27D4EB4F))


def windows(texts: Iterator[tuple[int, bytes]], longest: int, most: int = TEXT_BYTES) -> Iterator[tuple[list[bytes], list[int], list[int]]]:
    """Texts put together in windows: their bytes, the language of each stretch, and where in it new words may end n-grams.

    A text longer than a window is cut where a word ends; what follows begins
    with its last ``longest - 1`` words again, which are not new.
    """
    parts: list[bytes] = []
    langs: list[int] = []
    new: list[int] = []
    size = 0
    for lang, text in texts:
        begin, fresh_from = 0, 0  # this window's first byte and first new byte
        while True:
            end = len(text)
            if end - begin > most:
                end = _word_end(text, max(begin + most, fresh_from + 1))
            parts.append(text[begin:end])
            langs.append(lang)
            new.append(fresh_from - begin)
            size += end - begin + 1
            if size >= most:
                yield parts, langs, new
                parts, langs, new, size = [], [], [], 0
            if end == len(text):
                break
            begin, fresh_from = _words_before(text, end, longest - 1, most), end
    if parts:
        yield parts, langs, new


def _word_end(text: bytes, at: int) -> int:
    """The first place from ``at`` on where no word goes on."""
    while at < len(text):
        stops = np.flatnonzero(_KIND[np.frombuffer(text, np.uint8, min(1 << 16, len(text) - at), at)])
        if len(stops):
            return at + int(stops[0])
        at += 1 << 16
    return len(text)


def _words_before(text: bytes, end: int, n: int, reach: int) -> int:
    """Where the last ``n`` words before ``end`` begin."""
    while n:
        begin = max(0, end - reach)
        word = np.concatenate([[False], _KIND[np.frombuffer(text, np.uint8, end - begin, begin)] == _WORD])
        starts = np.flatnonzero(word[1:] & ~word[:-1]) + begin
        if begin == 0 or len(starts) > n:
            return int(starts[-n]) if len(starts) >= n else 0
        reach *= 2
    return end


class Grams:
    """The n-grams of a window."""

    def __init__(self, parts: list[bytes], langs: list[int], new: list[int], seeds: np.ndarray, longest: int, hashes=_HASHES[:1]):
        self.text = _LOWER[np.frombuffer(b"\n".join([*parts, b""]), np.uint8)]
        kind = _KIND[self.text]
        word = np.concatenate([[False], kind == _WORD, [False]])
        edges = np.flatnonzero(word[1:] != word[:-1])
        self.start, self.end = edges[::2], edges[1::2]
        size = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
        offset = np.cumsum(size) - size
        part = np.searchsorted(offset, self.start, side="right") - 1
        self.lang = np.asarray(langs)[part]
        is_new = self.start >= (offset + np.asarray(new))[part]
        piece = np.cumsum(kind == _BREAK)[self.start]
        self.words = np.bincount(self.lang[is_new], minlength=len(seeds))
        #: for each length, the numbers of the first words of the n-grams
        self.first = [np.flatnonzero(is_new)] + [
            np.flatnonzero((piece[n - 1 :] == piece[: len(piece) - n + 1]) & is_new[n - 1 :]) for n in range(2, longest + 1)
        ]
        self.hashes = [self._grams(h, seeds) for h in hashes]

    def _grams(self, word_hash: WordHash, seeds: np.ndarray) -> list[np.ndarray]:
        words = word_hash(self.text, self.start, self.end)
        found, so_far = [], mixed(words ^ seeds[self.lang])
        for n, first in enumerate(self.first):
            if n:
                so_far = mixed(so_far[: len(words) - n] * np.uint64(0x9FB21C651E98DF25) + words[n:])
            found.append(so_far[first])
        return found

    def phrases(self, n: int, first: np.ndarray) -> list[bytes]:
        """The texts of the n-grams of ``n`` words that begin with the words ``first``."""
        text, last = self.text.tobytes(), first + n - 1
        start, end = self.start[first], self.end[last]
        between = (self.start[first + 1] - self.end[first] for first in (first + i for i in range(n - 1)))
        plain = np.logical_and.reduce([gap == 1 for gap in between]) if n > 1 else np.ones(len(first), bool)
        return [
            text[s:e].replace(b"\t", b" ") if p else b" ".join(text[s:e].split())
            for s, e, p in zip(start.tolist(), end.tolist(), plain.tolist(), strict=True)
        ]


class Languages:
    """Numbers of languages as a task meets them, and what their hashes start from."""

    def __init__(self):
        self.names: list[str] = []
        self.number: dict[str, int] = {}

    def of(self, name: str) -> int:
        if name not in self.number:
            self.number[name] = len(self.names)
            self.names.append(name)
        return self.number[name]

    def seeds(self, salt: int) -> np.ndarray:
        import xxhash

        return np.array([xxhash.xxh64_intdigest(n.encode("utf-8", "surrogatepass"), salt) for n in self.names], np.uint64)


def _window_grams(batches: Iterator[pa.RecordBatch], languages: Languages, longest: int, hashes=_HASHES[:1]) -> Iterator[Grams]:
    """The n-grams of the batches' texts, window by window; batches have (lang, text)."""

    def texts():
        for batch in batches:
            langs = map(languages.of, batch.column(0).to_pylist())
            yield from zip(langs, each_utf8(batch.column(1)), strict=True)

    for parts, langs, new in windows(texts(), longest):
        yield Grams(parts, langs, new, languages.seeds(1), longest, hashes)


# The first pass -------------------------------------------------------------------------------------------------------


def _folded(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and how often each is there."""
    if counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
    begin = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    found = np.diff(np.append(begin, len(keys))) if counts is None else np.add.reduceat(counts, begin) if len(keys) else counts
    return keys[begin], found


class Summary:
    """A Misra-Gries summary with so many counters that nothing as frequent as ``threshold`` is lost."""

    def __init__(self, capacity: int, threshold: int):
        self.capacity, self.threshold, self.taken = capacity, threshold, 0
        self.keys, self.counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.n_waiting = 0

    def merge(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((keys, counts))
        self.n_waiting += len(keys)
        if self.n_waiting > max(2 * self.capacity, 1 << 16):
            self.fold()
            self.reduce()

    def fold(self) -> None:
        keys = np.concatenate([self.keys, *(k for k, _ in self.waiting)])
        counts = np.concatenate([self.counts, *(c.astype(np.int64) for _, c in self.waiting)])
        self.keys, self.counts = _folded(keys, counts)
        self.waiting, self.n_waiting = [], 0

    def reduce(self) -> None:
        over = len(self.counts) - self.capacity
        if over <= 0:
            return
        least = int(np.partition(self.counts, over - 1)[over - 1])
        if self.taken + least >= self.threshold:
            return
        kept = self.counts > least
        self.keys, self.counts, self.taken = self.keys[kept], self.counts[kept] - least, self.taken + least

    def survivors(self) -> np.ndarray:
        self.fold()
        return self.keys[self.counts + self.taken >= self.threshold]


def _cut(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The partition of each hash (its upper ``bits`` bits) and its key there (the next 32)."""
    name = hashes >> np.uint64(32 - bits)
    return (name >> np.uint64(32)).astype(np.int64), (name & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _mass(longest: int):
    def count(batches):
        languages, words, grams = Languages(), {}, 0
        for found in _window_grams(batches, languages, longest, ()):
            for lang, n in enumerate(found.words.tolist()):
                words[lang] = words.get(lang, 0) + n
            grams += sum(map(len, found.first))
        rows = [(languages.names[lang], n, 0) for lang, n in words.items()] + [(None, 0, grams)]
        columns = list(zip(*rows, strict=True))
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())],
            names=["lang", "words", "grams"],
        )

    return count


def _parts(longest: int, bits: int, fold: int):
    def sent(hashes: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        keys, counts = _folded(np.concatenate(hashes))
        partition, key = _cut(keys, bits)
        begin = np.flatnonzero(np.concatenate([[True], partition[1:] != partition[:-1]]))
        rows: list[tuple] = []
        for b, e in zip(begin.tolist(), np.append(begin[1:], len(keys)).tolist(), strict=True):
            for i in range(b, e, ROW_COUNTERS):
                j = min(i + ROW_COUNTERS, e)
                rows.append((int(partition[b]), key[i:j].tobytes(), counts[i:j].astype("<u4").tobytes()))
            if len(rows) >= 64:
                yield _part_rows(rows)
                rows = []
        if rows:
            yield _part_rows(rows)

    def parts(batches):
        held, size = [], 0
        for found in _window_grams(batches, Languages(), longest):
            held += found.hashes[0]
            size += sum(map(len, found.first))
            if size >= fold:
                yield from sent(held)
                held, size = [], 0
        if size:
            yield from sent(held)

    return parts


def _part_rows(rows: list[tuple]) -> pa.RecordBatch:
    p, k, c = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(p, pa.int64()), pa.array(k, pa.binary()), pa.array(c, pa.binary())], names=["partition", "keys", "counts"]
    )


def _survivors(capacity: int, threshold: int):
    def names(partition: int, summary: Summary) -> pa.RecordBatch:
        found = (np.int64(partition) << np.int64(32)) | summary.survivors().astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], names=["name"])

    def merged(batches):
        """Rows come sorted by partition."""
        now, summary = None, None
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                for p, k, c in zip(*(part.column(j).to_pylist() for j in range(3)), strict=True):
                    if p != now:
                        if summary is not None:
                            yield names(now, summary)
                        now, summary = p, Summary(capacity, threshold)
                    summary.merge(np.frombuffer(k, np.uint32), np.frombuffer(c, "<u4"))
        if summary is not None:
            yield names(now, summary)

    return merged


def frequent(texts: DataFrame, longest: int, threshold: int, grams: int, *, counters: int = COUNTERS, fold: int = FOLD) -> tuple[DataFrame, int]:
    """Names of hashes among which are those of all n-grams of (lang, text) with ``threshold`` occurrences, and the bits of their partitions.

    ``grams`` is the number of all occurrences.  A name is the upper bits of the hash.
    """
    bits = max(0, (grams // threshold // counters).bit_length())
    capacity = grams // threshold + 1 if not bits else int(1.1 * (grams / threshold) / (1 << bits)) + 1024
    parts = texts.mapInArrow(_parts(longest, bits, fold), "partition long, keys binary, counts binary")
    dealt = parts.repartition("partition").sortWithinPartitions("partition")
    return written(dealt.mapInArrow(_survivors(capacity, threshold), "name long"), "survivors"), bits


# The second pass ------------------------------------------------------------------------------------------------------


def _bitmap(names: DataFrame) -> np.ndarray:
    """A bitmap of the names with about sixteen bits for each, never over ``2**MOST_BITS``."""
    return bitmap_bytes(names, "name", min(MOST_BITS, max(15, (16 * names.count()).bit_length())))


def _counted(longest: int, partition_bits: int, bitmap):
    def row_batch(lang, size, phrases, counts):
        return pa.RecordBatch.from_arrays(
            [pa.array(lang, pa.string()), pa.array(size, pa.int32()), pa.array(phrases, pa.binary()), pa.array(counts, pa.int64())],
            names=["lang", "size", "phrase", "f"],
        )

    def counted(batches):
        languages, maybe = Languages(), bitmap.value
        for found in _window_grams(batches, languages, longest, _HASHES):
            for n, (first, one, other) in enumerate(zip(found.first, *found.hashes, strict=True), 1):
                kept = np.flatnonzero(maybe_held(maybe, one >> np.uint64(32 - partition_bits)))
                if not len(kept):
                    continue
                first, one, other = first[kept], one[kept], other[kept]
                order = np.argsort(one, kind="stable")
                begin = np.flatnonzero(np.concatenate([[True], one[order][1:] != one[order][:-1]]))
                counts = np.diff(np.append(begin, len(order)))
                if (other[order] != np.repeat(other[order][begin], counts)).any():  # n-grams that share one of their hashes
                    order = np.lexsort((other, one))
                    a, b = one[order], other[order]
                    begin = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
                    counts = np.diff(np.append(begin, len(order)))
                first = first[order][begin]
                lang = pa.array(languages.names, pa.string()).take(pa.array(found.lang[first]))
                for i in range(0, len(first), 50_000):
                    part = slice(i, i + 50_000)
                    phrases = found.phrases(n, first[part])
                    yield row_batch(lang[i : i + len(phrases)], np.full(len(phrases), n, np.int32), phrases, counts[part])

    return counted


def exact_counts(texts: DataFrame, names: DataFrame, partition_bits: int, longest: int, threshold: int) -> DataFrame:
    """(lang, size, phrase, f) of all n-grams of (lang, text) that occur ``threshold`` times, which must be among ``names``."""
    held = texts.sparkSession.sparkContext.broadcast(_bitmap(names))
    found = texts.mapInArrow(_counted(longest, partition_bits, held), "lang string, size int, phrase binary, f long")
    return found.groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f")).filter(F.col("f") >= threshold).select(
        "lang", "size", F.col("phrase").cast("string").alias("phrase"), "f"
    )


def scored(counts: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the phrases of two words and more, each by its lowest-scoring cut."""
    words = F.split("phrase", " ")
    cuts = F.transform(
        F.sequence(F.lit(1), F.col("size") - 1),
        lambda k: F.struct(
            k.alias("k"),
            F.array_join(F.slice(words, F.lit(1), k), " ").alias("left"),
            F.array_join(F.slice(words, k + 1, F.col("size") - k), " ").alias("right"),
        ),
    )
    of = counts.filter("size > 1").select("lang", "phrase", F.col("f").alias("a"), F.explode(cuts).alias("cut")).select("lang", "phrase", "a", "cut.*")
    left = counts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    of = of.join(left, ["lang", "left"]).join(right, ["lang", "right"])
    a, low, high = (F.col(c).cast("decimal(15,0)") for c in "alr")
    score = F.floor(_whole_quotient(F.lit(1_000_000).cast("decimal(7,0)") * (a * a), low * high))
    cut = F.struct(score.alias("score"), "k", "l", "r")
    return of.groupBy("lang", "phrase").agg(F.min("a").alias("a"), F.min(cut).alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def _whole_quotient(over: Column, under: Column) -> Column:
    return F.call_function("div", over, under)


def collocations(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text", *,
    longest: int = 3, least: int = 10, inside_percent: int = 50, top: int = 2000,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of 2 to ``longest`` words of each language.

    Texts are lower-cased in A-Z, cut into pieces at ``.,;:!?`` and line breaks, and those into words at blanks and
    tabs.  n is the number of a language's words and f that of a phrase's places within pieces, overlaps included.
    Phrases with ``a = f(phrase) >= least`` are candidates, scored by ``floor(1000000 a a / (l r))`` for their
    lowest-scoring cut into two, the first of equals, where l and r are f of both sides.  A candidate inside a longer
    one that has ``inside_percent`` of its places goes.  Ranks are by score and a, descending, and the phrase's bytes.

    A null language is ``und``; null and empty texts have no words, and repeated rows count as often as they are there.
    Counts are exact up to 15 digits.  A language without candidates has no rows, an empty table none at all; other columns
    are ignored.
    """
    name = fresh(docs, "lang")
    texts = docs.select(F.coalesce(column(lang_col).cast("string"), F.lit(UNKNOWN)).alias(name), whole_text(text_col).alias("text"))
    mass = written(texts.mapInArrow(_mass(longest), "lang string, words long, grams long"), "mass")
    grams = mass.agg(F.sum("grams")).first()[0] or 0
    n = mass.filter("lang is not null").groupBy("lang").agg(F.sum("words").alias("n"))
    names, bits = frequent(texts, longest, least, grams)
    counts = written(exact_counts(texts, names, bits, longest, least), "phrases")
    found = written(scored(counts), "scored")
    return _best(found, n, longest, inside_percent, top)


def _best(found: DataFrame, n: DataFrame, longest: int, inside_percent: int, top: int) -> DataFrame:
    words = F.split("phrase", " ")
    parts = F.flatten(F.transform(
        F.sequence(F.lit(2), F.size(words) - 1),
        lambda size: F.transform(F.sequence(F.lit(1), F.size(words) - size + 1), lambda i: F.array_join(F.slice(words, i, size), " ")),
    ))
    longer = found.filter(F.size(words) > 2).select("lang", F.explode(parts).alias("phrase"), F.col("a").alias("around"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("around").alias("around"))
    kept = found.join(longer, ["lang", "phrase"], "left").filter(
        F.col("around").isNull() | (100 * F.col("around") < inside_percent * F.col("a"))
    )
    # the best of 64 parts of a language's phrases, then the best of those: no task sees more than the parts' best
    ranked = kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    for of in (("lang", "part"), ("lang",)):
        rank = F.row_number().over(Window.partitionBy(*of).orderBy(F.desc("score"), F.desc("a"), "phrase"))
        ranked = ranked.withColumn("rank", rank).filter(F.col("rank") <= top)
    return ranked.join(n, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
