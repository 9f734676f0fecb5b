"""Quality rules: how far a document is from its language.

For each language the corpus gives two histograms: of character classes, and
of its most common words with one bin for all others.  A document's own
histograms are compared to them by the Jensen-Shannon distance.  A document too
short for its histogram to mean anything is not judged by it.  Plain counts
(words, symbols, repeated lines and word runs) go with it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.llm.common import column, each_utf8, fresh, tidy

UNKNOWN = "und"
#: Words in a reference, and languages that have one of their own (those with most words); others share one of all text.
COMMON_WORDS, LANGUAGES = 100, 256
#: Distances from which a document is rejected, and the characters and words it must have to be judged by them.
MOST_CLASS_DISTANCE, LEAST_CHARS = 0.27, 200
MOST_WORD_DISTANCE, LEAST_WORDS = 0.55, 50
#: Distinct words a task holds before it passes its counts on.
HELD_WORDS = 300_000

CLASSES = ("lower", "upper", "other_letter", "digit", "space", "line_end", "stop", "symbol", "other")


def _class_of() -> np.ndarray:
    """The class of each code point below 0x10000, by what Python's ``str`` says of it."""
    found = np.full(1 << 16, CLASSES.index("other"), np.uint8)
    for i in range(1 << 16):
        c = chr(i)
        if c in "\n\r":
            found[i] = CLASSES.index("line_end")
        elif c.isspace():
            found[i] = CLASSES.index("space")
        elif c.isalpha():
            found[i] = CLASSES.index("upper" if c.isupper() else "lower" if c.islower() else "other_letter")
        elif c.isdigit():
            found[i] = CLASSES.index("digit")
        elif c in ".,;:!?'\"()-":
            found[i] = CLASSES.index("stop")
        elif c.isprintable():
            found[i] = CLASSES.index("symbol")
    return found


_TABLES: list[np.ndarray] = []


def classes(text: bytes) -> np.ndarray:
    """How many characters of each class a text has."""
    if not _TABLES:
        _TABLES.append(_class_of())
    cp = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    return np.bincount(_TABLES[0][np.minimum(cp, 0xFFFF)], minlength=len(CLASSES))


def distance(counts: np.ndarray, reference: np.ndarray) -> float:
    """The Jensen-Shannon distance, from 0 to 1; 0 if either has no counts."""
    if not counts.sum() or not reference.sum():
        return 0.0
    p, q = counts / counts.sum(), reference / reference.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = np.nansum(p * np.log2(p / m)) + np.nansum(q * np.log2(q / m))
    return float(np.sqrt(max(0.0, parts / 2)))


# Plain counts ---------------------------------------------------------------------------------------------------------

_SYMBOLS = b"#*$%&|<>"
_NOT_SYMBOLS = bytes(i for i in range(256) if i not in _SYMBOLS)
_CONTINUED = bytes(range(0x80, 0xC0))


def repeated_words(words: list[bytes], size: int = 5) -> int:
    """How many words stand in a run of ``size`` words that is found twice or more."""
    if len(words) <= size:
        return 0
    number: dict[bytes, int] = {}
    run = np.array([number.setdefault(w, len(number)) for w in words])
    if len(number) == len(words):
        return 0
    first = run
    for i in range(1, size):  # each run gets a number, made of that of the run one shorter and its last word
        _, run = np.unique(run[: len(words) - i] * len(number) + first[i:], return_inverse=True)
    twice = np.bincount(run)[run] > 1
    edge = np.zeros(len(words) + 1, np.int64)
    edge[: len(twice)] += twice
    edge[size : size + len(twice)] -= twice
    return int((np.cumsum(edge) > 0).sum())


def plain_counts(text: bytes, words: list[bytes]) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words).

    ``bytes.split`` cuts at ``\\x20`` and ``\\x09-\\x0d`` only.
    """
    joined = b"".join(words)
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    return (
        len(words), len(joined.translate(None, _CONTINUED)), len(text.translate(None, _NOT_SYMBOLS)),
        len(lines) - len(set(lines)), repeated_words(words),
    )


# References -----------------------------------------------------------------------------------------------------------


@dataclass
class Reference:
    classes: np.ndarray
    words: dict[bytes, int]  # a common word's bin
    counts: np.ndarray  # of the bins; the last is that of all other words

    def histogram(self, words: list[bytes]) -> np.ndarray:
        held = Counter(map(self.words.get, words))
        found = np.zeros(len(self.counts), np.int64)
        for b, n in held.items():
            found[-1 if b is None else b] += n
        return found


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, n): counts of words, and with a word null and its place in ``kind`` those of character classes."""
    words: dict[str, Counter] = {}
    chars: dict[str, np.ndarray] = {}

    def held():
        rows = [(lang, w, None, n) for lang, c in words.items() for w, n in c.items()]
        rows += [(lang, None, i, int(n)) for lang, c in chars.items() for i, n in enumerate(c)]
        words.clear()
        chars.clear()
        columns = list(zip(*rows, strict=True)) or [[], [], [], []]
        types = (pa.string(), pa.binary(), pa.int32(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["lang", "word", "kind", "n"])

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), each_utf8(batch.column(1)), strict=True):
            words.setdefault(lang, Counter()).update(text.lower().split())
            chars[lang] = chars.get(lang, 0) + classes(text)
        if sum(map(len, words.values())) > HELD_WORDS:
            yield held()
    yield held()


def references(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", *, common_words: int = COMMON_WORDS,
    most_languages: int = LANGUAGES,
) -> dict[str | None, Reference]:
    """The references of the languages of ``docs``, counted over all of its texts; that of all text is under None.

    At most ``most_languages * (common_words + 9)`` numbers come to the driver.
    """
    rows = docs.select(
        F.coalesce(column(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), column(text_col).cast("string").alias("text")
    )
    counted = rows.mapInArrow(tidy(_counted), "lang string, word binary, kind int, n long")
    from evenkeel.sources.workspace import written

    counted = written(counted.groupBy("lang", "word", "kind").agg(F.sum("n").alias("n")), "word_counts")
    sizes = counted.filter("word is not null").groupBy("lang").agg(F.sum("n").alias("n_words"))
    sizes = sizes.orderBy(F.desc("n_words"), "lang").limit(most_languages)
    own = counted.join(F.broadcast(sizes.select("lang")), "lang", "left_semi")
    pooled = counted.groupBy("word", "kind").agg(F.sum("n").alias("n")).select(F.lit(None).cast("string").alias("lang"), "word", "kind", "n")
    both = own.unionByName(pooled)
    # The best of 64 parts of a language's words, then the best of those: no task sees more than the parts' best.
    part, order = F.pmod(F.hash("word"), F.lit(64)).alias("part"), (F.desc("n"), "word")
    top = both.filter("word is not null").select("*", part)
    for of in (("lang", "part"), ("lang",)):
        rank = F.row_number().over(Window.partitionBy(*of).orderBy(*order))
        top = top.withColumn("rank", rank).filter(F.col("rank") <= common_words)
    top = top.collect()
    rest = both.groupBy("lang", "kind").agg(F.sum("n").alias("n")).collect()
    found = {}
    for lang in {r["lang"] for r in rest}:
        chars = np.zeros(len(CLASSES), np.int64)
        total = 0
        for r in rest:
            if r["lang"] == lang:
                if r["kind"] is None:
                    total = r["n"]
                else:
                    chars[r["kind"]] = r["n"]
        common = sorted((r for r in top if r["lang"] == lang), key=lambda r: r["rank"])
        counts = np.array([r["n"] for r in common] + [total - sum(r["n"] for r in common)])
        found[lang] = Reference(chars, {bytes(r["word"]): i for i, r in enumerate(common)}, counts)
    return found


# The operator ---------------------------------------------------------------------------------------------------------

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, class_distance double, word_distance double"


def measured(docs: DataFrame, known: dict[str | None, Reference], text_col: str = "text", lang_col: str = "lang") -> Column:
    """A struct of the counts and the distances (null for a text too short) of each text of ``docs``."""
    shipped = docs.sparkSession.sparkContext.broadcast(known)

    def measure(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        fields = MEASURES.split(", ")
        types = [pa.int64() if f.endswith(" long") else pa.float64() for f in fields]
        for texts, langs in columns:
            rows = []
            for text, lang in zip(each_utf8(texts), langs.to_pylist(), strict=True):
                of = shipped.value.get(lang) or shipped.value.get(None)
                words = text.split()
                chars = classes(text)
                rows.append((
                    *plain_counts(text, words),
                    distance(chars, of.classes) if of and chars.sum() >= LEAST_CHARS else None,
                    distance(of.histogram(text.lower().split()), of.counts) if of and len(words) >= LEAST_WORDS else None,
                ))
            by_field = zip(*rows, strict=True) if rows else [[]] * len(fields)
            yield pa.StructArray.from_arrays(
                [pa.array(c, t) for c, t in zip(by_field, types, strict=True)], [f.split()[0] for f in fields]
            )

    lang = F.coalesce(column(lang_col).cast("string"), F.lit(UNKNOWN))
    return F.arrow_udf(tidy(measure), MEASURES)(column(text_col).cast("string"), lang)


def judge(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", *, out: str = "quality",
    known: dict[str | None, Reference] | None = None, most_class_distance: float = MOST_CLASS_DISTANCE,
    most_word_distance: float = MOST_WORD_DISTANCE,
) -> DataFrame:
    """``docs`` with a struct ``out`` added; the name is lengthened where a column has it.

    Its fields are the counts n_words, word_chars (code points in words),
    n_symbols, n_dup_lines (lines with a word that equal an earlier one),
    n_repeat_words (words in 5-word runs found twice or more in the text),
    class_distance and word_distance (null where the text is too short for
    them), base_failed (under 10 words, or over a fifth of them repeated) and
    kept (neither failed nor farther from the language than allowed).

    A null text is empty: it has no words and fails.  A null language is one
    like others; one without a reference is compared to all text.  Every row,
    repeated ones too, stays and is judged for itself.
    """
    known = references(docs, text_col, lang_col) if known is None else known
    out = fresh(docs, out)
    m = F.col(out)
    failed = (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])
    far = (F.coalesce(m["class_distance"], F.lit(0.0)) > most_class_distance) | (
        F.coalesce(m["word_distance"], F.lit(0.0)) > most_word_distance
    )
    found = docs.withColumn(out, measured(docs, known, text_col, lang_col))
    return found.withColumn(out, m.withField("base_failed", failed).withField("kept", ~failed & ~far))
