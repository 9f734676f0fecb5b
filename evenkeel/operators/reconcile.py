"""Compare an expected and an actual table on a key, cell by cell.

Three strategies give the same result:

``hash``   both sides are reduced to key + 128-bit row hash, put on top of each
           other and grouped by key.  One shuffle of narrow rows finds missing,
           extra, changed and duplicate keys; only the changed rows are fetched
           again to name the cells.
``exact``  full outer join of the whole rows, no hash.
``anti``   one-sided keys from the census, then an inner join of the rows; Spark
           can broadcast a small side of it, which no full outer join allows.

All three start from the *key census*: rows per key on each side, counted with
map-side partial aggregation.  It does the work of anti joins in both
directions with one shuffle.  A key that holds a third of a table is one row
per map task after that, and duplicate keys are known before any join, so no
join here can fan out or put a hot key into one task.

Rows under a repeated key have no partner of their own.  They are compared as
sets with repeats: grouped by key *and row hash*, so that equal rows of both
sides cancel out and a hot key spreads over its contents.  What is left over
is missing or extra, with its number of rows.  No join on the key is needed.
"""

from __future__ import annotations

from copy import copy
from functools import cached_property, reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.functions.canonical import comparables, fold_names, key_text, literal, quoted
from evenkeel.operators.membership import maybe_in, words_of
from evenkeel.sources.buckets import in_buckets, plan_of
from evenkeel.sources.workspace import written

MISSING = "MISSING_IN_TARGET"
EXTRA = "EXTRA_IN_TARGET"
MISMATCH = "VALUE_MISMATCH"
MATCH = "MATCH"
DUPLICATE = "DUPLICATE_KEY"

STRATEGIES = ("hash", "exact", "anti")
AUDIT_COLUMNS = ("load_ts", "batch_id")

# Keys are broadcast to filter the wide tables only below this many bytes,
# measured in the census, never guessed.
BROADCAST_KEY_BYTES = 32 * 1024 * 1024

# A hot key holds more than one row in this many; so there are never more hot keys than that,
# and as pairs of 64-bit hashes they take a few MB.
HOT_KEY_SHARE = 50_000

# A table of so many columns gets a hash for each group of columns, of about so many, in so many groups at most.
WIDE = 48
GROUP_COLUMNS = 16
MOST_GROUPS = 8

# Slices of the key space whose fingerprints are compared before anything is moved.
SLICES = 1024

DIFF_SCHEMA = T.StructType([
    T.StructField("primary_key_value", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("expected_value", T.StringType()),
    T.StructField("actual_value", T.StringType()),
    T.StructField("diff_type", T.StringType()),
])

# Fixed values of a whole-row difference: column name, expected, actual.
_ROW_MARKERS = {
    MISSING: ("<ENTIRE_ROW>", "<PRESENT_IN_SOURCE>", "<MISSING_IN_TARGET>"),
    EXTRA: ("<ENTIRE_ROW>", "<EXTRA_IN_TARGET>", "<PRESENT_IN_TARGET>"),
}


class DuplicateKeyError(ValueError):
    """A key that should identify one row identifies several."""


def compare_columns(expected: DataFrame, actual: DataFrame, keys, exclude=AUDIT_COLUMNS) -> list[str]:
    """Columns both tables have, without keys and excluded ones, in name order."""
    skip = {c.lower() for c in (*keys, *exclude)}
    common = {c.lower() for c in expected.columns} & {c.lower() for c in actual.columns}
    return sorted(common - skip)


class _Pair:
    """Both tables with typed key columns ``_k0.._kn`` and the rules to compare them."""

    def __init__(self, expected, actual, keys, columns, coerce, hash_bits=128):
        self.seeds = range(hash_bits // 64)
        self.expected, self.actual = fold_names(expected), fold_names(actual)
        for side, df in (("expected", self.expected), ("actual", self.actual)):
            absent = [c for c in (*keys, *columns) if c not in df.columns]
            if absent:
                raise ValueError(f"{side} table has no column(s) {absent}")
        self.columns = comparables(self.expected.schema, self.actual.schema, columns, coerce)
        self._keys = comparables(self.expected.schema, self.actual.schema, keys, coerce)
        self.key_names = [f"_k{i}" for i in range(len(keys))]

    def _side(self, left: bool) -> DataFrame:
        return self.expected if left else self.actual

    def _key_columns(self, left: bool) -> list[str]:
        return [f"{k.key(quoted(k.name), left)} as {n}" for k, n in zip(self._keys, self.key_names)]

    def wide(self, left: bool) -> DataFrame:
        """Keys and raw compare columns; values are made canonical after the join."""
        raw = [f"{quoted(c.name)} as {_side_column(c, left)}" for c in self.columns]
        return self._side(left).selectExpr(*self._key_columns(left), *raw)

    def hashed(self, left: bool) -> DataFrame:
        """Keys, a counter for each side and the row hash in pieces of 64 bits.

        The values to hash are projected first: the optimizer keeps them apart
        because every piece uses them, so each is made canonical once.

        A wide row has one hash of the whole and one of each group of columns, so
        that the census can say which groups changed.
        """
        inputs = [c.hash_inputs(quoted(c.name), left) for c in self.columns]
        names = [[f"_v{i}_{j}" for j in range(len(parts))] for i, parts in enumerate(inputs)]
        values = self._side(left).selectExpr(
            *self._key_columns(left),
            *[f"{v} as {n}" for parts, own in zip(inputs, names, strict=True) for v, n in zip(parts, own, strict=True)],
        )
        whole = [n for own in names for n in own]
        hashed = {f"_h{seed}": (seed, whole) for seed in ([0] if self.groups else self.seeds)}
        hashed |= {f"_g{g}": (g + 1, [n for i in group for n in names[i]]) for g, group in enumerate(self.groups)}
        hashes = [f"xxhash64({hashed[p][0]}, {', '.join(hashed[p][1])}) as {p}" for p in self.pieces]
        return values.selectExpr(*self.key_names, *_counters(left), *hashes)

    @property
    def groups(self) -> list[list[int]]:
        """The columns, by number, of each group of a wide table; none of another."""
        n = len(self.columns)
        if n < WIDE:
            return []
        number = min(MOST_GROUPS, -(-n // GROUP_COLUMNS))
        edges = [round(n * i / number) for i in range(number + 1)]
        return [list(range(lo, hi)) for lo, hi in zip(edges, edges[1:], strict=False)]

    def of_groups(self, mask: int | None) -> _Pair:
        """The pair with the columns of the groups whose bits are set; with all if none is."""
        if not self.groups or not mask:
            return self
        part = copy(self)
        part.columns = [self.columns[i] for g, group in enumerate(self.groups) if mask >> g & 1 for i in group]
        return part

    def slice_of(self, left: bool, number: int) -> str:
        """The slice of the key space that a row of a side is in, as SQL over its own columns."""
        keys = [k.key(quoted(k.name), left) for k in self._keys]
        return f"pmod(xxhash64(7, {', '.join(f'{k}, {k} is null' for k in keys)}), {number})"

    def fingerprints(self, number: int) -> DataFrame:
        """For each slice of the key space the rows of both sides, and whether they are the same ones.

        The 128-bit hashes of keys and values of a side, with repeats, are summed
        up and xor-ed: numbers that do not depend on any order, that tasks fold
        first, and of which a slice has few.  The rows of the one side count
        negative.  Sums are of 16 bits each, so that 2**47 rows overflow none.
        """
        sides = []
        for left in (True, False):
            inputs = [part for c in self.columns for part in c.hash_inputs(quoted(c.name), left)]
            names = [f"_v{i}" for i in range(len(inputs))]
            values = self._side(left).selectExpr(
                f"{self.slice_of(left, number)} as _slice", *self._key_columns(left),
                *[f"{v} as {n}" for v, n in zip(inputs, names)],
            )
            whole = ", ".join([*(f"{k}, {k} is null" for k in self.key_names), *names])
            sides.append(values.selectExpr("_slice", *_counters(left), *[f"xxhash64({seed}, {whole}) as _h{seed}" for seed in (0, 1)]))
        bits = [f"(shiftrightunsigned({h}, {at}) & 65535L) * (_e - _a)" for h in ("_h0", "_h1") for at in (0, 16, 32, 48)]
        sums = sides[0].unionAll(sides[1]).groupBy("_slice").agg(
            F.sum("_e").alias("expected_rows"), F.sum("_a").alias("actual_rows"),
            *[F.sum(F.expr(part)).alias(f"_s{i}") for i, part in enumerate(bits)],
            *[F.bit_xor(h).alias(h) for h in ("_h0", "_h1")],
        )
        same = " and ".join(["expected_rows = actual_rows", "_h0 = 0", "_h1 = 0", *(f"_s{i} = 0" for i in range(len(bits)))])
        return sums.selectExpr("_slice", "expected_rows", "actual_rows", f"{same} as same")

    def in_slices(self, slices: list[int], number: int) -> _Pair:
        """The rows of both sides in some slices, with the same rules."""
        part = copy(self)
        part.expected, part.actual = (
            side.filter(F.expr(self.slice_of(left, number)).isin(slices)) for left, side in ((True, self.expected), (False, self.actual))
        )
        return part

    def keys_of(self, left: bool) -> DataFrame:
        return self._side(left).selectExpr(*self._key_columns(left))

    def is_dealt_by_key(self, left: bool) -> bool:
        """Whether the rows of a side already lie together by key, as those of a snapshot in buckets."""
        return in_buckets(self._side(left)) and "Exchange" not in plan_of(self.keys_of(left).groupBy(*self.key_names).count())

    @property
    def pieces(self) -> list[str]:
        """The columns of the row hash; none if there is nothing to compare but keys."""
        if self.groups:
            return ["_h0", *(f"_g{g}" for g in range(len(self.groups)))]
        return [f"_h{seed}" for seed in self.seeds] if self.columns else []

    def key_hash(self) -> list[str]:
        """128 bits of the key as SQL; nulls count."""
        parts = ", ".join(f"{k}, {k} is null" for k in self.key_names)
        return [f"xxhash64({seed}, {parts}) as _kh{seed}" for seed in (0, 1)]

    def census(self, hashed: bool) -> DataFrame:
        """One row per key: rows on each side and, if hashed, whether the rows differ.

        Counters and xor-ed hashes are fixed-width, so this is a codegen hash
        aggregate with a partial step before the only shuffle.  Grouping treats
        null keys as equal.  Two rows agree exactly when their hashes xor to 0.
        """
        pieces = self.pieces if hashed else []

        def side(left: bool) -> DataFrame:
            return self.hashed(left) if pieces else self._side(left).selectExpr(*self._key_columns(left), *_counters(left))

        def summed(rows: DataFrame) -> DataFrame:
            return rows.groupBy(*self.key_names).agg(
                F.sum("_e").alias("_e"), F.sum("_a").alias("_a"), *[F.bit_xor(p).alias(p) for p in pieces]
            )

        sides = [side(True), side(False)]
        if self.is_dealt_by_key(True) or self.is_dealt_by_key(False):
            # each on its own first: a saved side is not moved, and both then lie by key
            sides = [summed(rows) for rows in sides]
        counted = summed(sides[0].unionAll(sides[1])).withColumnsRenamed({"_e": "expected_rows", "_a": "actual_rows"})
        changed = F.expr(" or ".join(f"{p} <> 0" for p in pieces) or "false")
        status = (
            F.when((F.col("expected_rows") > 1) | (F.col("actual_rows") > 1), DUPLICATE)
            .when(F.col("actual_rows") == 0, MISSING)
            .when(F.col("expected_rows") == 0, EXTRA)
            .when(changed, MISMATCH)
            .otherwise(MATCH)
        )
        set_bits = [f"if(_g{g} <> 0, {1 << g}, 0)" for g in range(len(self.groups) if pieces else 0)]
        mask = F.expr(" | ".join(set_bits) or "0").alias("groups")
        return counted.select(*self.key_names, "expected_rows", "actual_rows", status.alias("status"), mask)

    def on(self, left: DataFrame, right: DataFrame) -> Column:
        return reduce(and_, [left[k].eqNullSafe(right[k]) for k in self.key_names])

    def key_bytes(self) -> Column:
        """Size of one key row as text plus fixed overhead; an upper bound for a hash relation."""
        sizes = [f"coalesce(octet_length(cast({k} as string)), 0) + 64L" for k in self.key_names]
        return F.expr(" + ".join(sizes))

    def any_cell_differs(self) -> Column:
        cells = [c.differs(_side_column(c, True), _side_column(c, False)) for c in self.columns]
        return F.expr(" or ".join(cells) or "false")

    def diff_rows(self, rows: DataFrame) -> DataFrame:
        """Diff table of joined rows with a ``status``: one marker per missing or
        extra row, one row per differing cell of a changed row.

        The cells of a row are put in one array and the equal ones dropped
        before it is exploded.  ``entry`` numbers the cells of a row from 0.
        """
        cases = [f"when status = '{k}' then array({_marker(k)})" for k in (MISSING, EXTRA)]
        if self.columns:
            cells = ", ".join(self._cell(c) for c in self.columns)
            cases.append(f"when status = '{MISMATCH}' then filter(array({cells}), cell -> cell is not null)")
        entries = f"posexplode(case {' '.join(cases)} end) as (entry, cell)"
        return self._labelled(rows.selectExpr(*self.key_names, "status", "1L as rows", entries))

    def _cell(self, c) -> str:
        expected, actual = _side_column(c, True), _side_column(c, False)
        entry = _diff_struct(literal(c.name), c.text(expected, True), c.text(actual, False))
        return f"if({c.differs(expected, actual)}, {entry}, null)"

    def marker_rows(self, rows: DataFrame, number: str = "1L") -> DataFrame:
        """The same for keys of which ``number`` rows are missing or extra; the marker says so if there are several."""
        entry = f"if(status = '{MISSING}', {_marker(MISSING, number)}, {_marker(EXTRA, number)}) as cell"
        return self._labelled(rows.selectExpr(*self.key_names, "status", f"{number} as rows", "0 as entry", entry))

    def _labelled(self, rows: DataFrame) -> DataFrame:
        return rows.selectExpr(
            f"{key_text(self.key_names)} as primary_key_value",
            "cell.column_name",
            "cell.expected_value",
            "cell.actual_value",
            "status as diff_type",
            "rows",
            "entry",
        )


def _counters(left: bool) -> list[str]:
    return [f"{int(left)}L as _e", f"{int(not left)}L as _a"]


def _side_column(c, left: bool) -> str:
    return quoted(("e_" if left else "a_") + c.name)


def _diff_struct(column: str, expected: str, actual: str) -> str:
    return f"named_struct('column_name', {column}, 'expected_value', {expected}, 'actual_value', {actual})"


def _marker(kind: str, number: str = "1L") -> str:
    column, expected, actual = (literal(v) for v in _ROW_MARKERS[kind])
    times = f"if({number} > 1, concat(' x', {number}), '')"
    if kind == MISSING:
        expected = f"concat({expected}, {times})"
    else:
        actual = f"concat({actual}, {times})"
    return _diff_struct(column, expected, actual)


class Reconciliation:
    """Result of :func:`reconcile`.

    The counts are known at once.  ``diff`` is built when it is first asked
    for, written once, and is a scan of that table from then on.
    """

    def __init__(self, spark, counts: dict[str, int], duplicates: DataFrame, find_diff):
        self._spark = spark
        self._find_diff = find_diff
        self.counts = counts
        self.duplicates = duplicates

    @cached_property
    def counted_diff(self) -> DataFrame:
        """The diff table with ``rows``: how many rows a difference stands for."""
        if self.total_diffs == 0:
            return self._spark.createDataFrame([], T.StructType([*DIFF_SCHEMA, T.StructField("rows", T.LongType())]))
        return self._find_diff()

    @cached_property
    def diff(self) -> DataFrame:
        """One row per missing row, extra row and differing cell, in ``DIFF_SCHEMA``."""
        return self.counted_diff.select(*DIFF_SCHEMA.names)

    @property
    def total_diffs(self) -> int:
        return self.counts["total_diffs"]

    @property
    def cell_diffs(self) -> int:
        """Number of differing cells, counted in the diff table."""
        return self.diff.filter(F.col("diff_type") == MISMATCH).count()

    @property
    def passed(self) -> bool:
        return self.total_diffs == 0 and self.counts["duplicate_keys"] == 0

    @property
    def verdict(self) -> str:
        return "PASS" if self.passed else "FAIL"

    @property
    def exit_code(self) -> int:
        # fixed values: 0 no difference, 3 differences
        return 0 if self.passed else 3

    @cached_property
    def summary(self) -> DataFrame:
        """The counts and the verdict as a one-row frame."""
        names = list(self.counts)
        schema = ", ".join(f"{n} bigint" for n in names) + ", verdict string"
        return self._spark.createDataFrame([(*[self.counts[n] for n in names], self.verdict)], schema)


def _run_census(pair: _Pair, hashed: bool, rows: tuple[int, int] | None = None):
    """Write the keys that do not match and count the others.

    All matching keys are one group, which the partial aggregate folds to one
    row per task; so the written table is as large as the findings, and the
    counts are read from it.  Nothing depends on metrics that a busy driver or
    a task run twice could get wrong.

    If the numbers of rows of both sides are known, what is not found matches,
    and the findings are written straight from the only shuffle.
    """
    census = pair.census(hashed)
    nulls = F.expr(" or ".join(f"{k} is null" for k in pair.key_names))
    if rows is None:
        keys = [F.when(F.col("status") != MATCH, F.col(k)).alias(k) for k in pair.key_names]
        found = census.groupBy(*keys, "status").agg(
            F.sum("expected_rows").alias("expected_rows"),
            F.sum("actual_rows").alias("actual_rows"),
            F.count(F.lit(1)).alias("keys"),
            F.bool_or(nulls).alias("null_key"),
            F.bit_or("groups").alias("groups"),
        )
    else:
        found = census.filter(F.col("status") != MATCH).select("*", F.lit(1).cast("long").alias("keys"), nulls.alias("null_key"))
    findings = written(found, "findings")
    per_status = {
        r.status: r
        for r in findings.groupBy("status").agg(
            F.sum("expected_rows").alias("expected_rows"),
            F.sum("actual_rows").alias("actual_rows"),
            F.sum("keys").alias("keys"),
            F.sum(pair.key_bytes()).alias("bytes"),
            F.min("_k0").alias("low"),
            F.max("_k0").alias("high"),
            F.count_if(F.col("_k0").isNull()).alias("nulls"),
            F.bool_or("null_key").alias("null_key"),
            F.bit_or("groups").alias("groups"),
        ).collect()
    }
    if rows is not None:
        left, right = (n - sum(r[side] for r in per_status.values()) for n, side in zip(rows, ("expected_rows", "actual_rows"), strict=True))
        per_status[MATCH] = Row(expected_rows=left, actual_rows=right, keys=left, null_key=True)

    def of(status, field):
        return per_status[status][field] if status in per_status else 0

    return findings, {
        "source_rows": sum(r.expected_rows for r in per_status.values()),
        "target_rows": sum(r.actual_rows for r in per_status.values()),
        "matched_rows": of(MATCH, "keys"),
        "missing_rows": of(MISSING, "keys"),
        "extra_rows": of(EXTRA, "keys"),
        "mismatched_rows": of(MISMATCH, "keys"),
        "duplicate_keys": of(DUPLICATE, "keys"),
        "mismatch_bytes": of(MISMATCH, "bytes"),
        "duplicate_bytes": of(DUPLICATE, "bytes"),
        "duplicate_rows": of(DUPLICATE, "expected_rows"),
        "changed": per_status.get(MISMATCH),
        "null_keys": any(r.null_key for r in per_status.values()),
    }


def _keys_with(findings: DataFrame, pair: _Pair, kind: str) -> DataFrame:
    return findings.filter(F.col("status") == kind).select(*pair.key_names)


def _without_hot_keys(pair: _Pair, sides: list[DataFrame], findings: DataFrame, counts: dict) -> list[DataFrame]:
    """Drop rows of hot repeated keys before a shuffle, which would put each into one task.

    There are fewer than ``HOT_KEY_SHARE`` such keys, and they are broadcast as
    128-bit hashes, so their size is bounded however long they are.  Rows of
    repeated keys are compared on their own.
    """
    if not counts["duplicate_keys"]:
        return sides
    key_rows, all_rows = F.col("expected_rows") + F.col("actual_rows"), counts["source_rows"] + counts["target_rows"]
    hot = findings.filter((F.col("status") == DUPLICATE) & (key_rows > all_rows // HOT_KEY_SHARE))
    hot = F.broadcast(hot.selectExpr(*pair.key_hash()))
    hashes = ["_kh0", "_kh1"]
    return [rows.selectExpr("*", *pair.key_hash()).join(hot, hashes, "left_anti").drop(*hashes) for rows in sides]


def _left_over(pair: _Pair, findings: DataFrame, counts: dict) -> DataFrame:
    """(keys, status, rows) of the rows of repeated keys that only one side has, written.

    All rows are grouped by key and content, which folds equal ones in each
    task, then the few left-over counts by key.  Few repeated keys are
    broadcast to leave the other rows out before the shuffle; else the counts,
    by then one row for each key, are joined with the repeated keys.
    """
    repeated = _keys_with(findings, pair, DUPLICATE)
    sides = [pair.hashed(True), pair.hashed(False)]
    few = counts["duplicate_bytes"] <= BROADCAST_KEY_BYTES
    if few:
        wanted = F.broadcast(repeated)
        sides = [rows.join(wanted, pair.on(rows, wanted), "left_semi") for rows in sides]
    contents = sides[0].unionAll(sides[1]).groupBy(*pair.key_names, *pair.pieces).agg(F.sum("_e").alias("_e"), F.sum("_a").alias("_a"))
    per_key = contents.filter("_e <> _a").groupBy(*pair.key_names).agg(
        F.sum(F.greatest(F.col("_e") - F.col("_a"), F.lit(0))).alias(MISSING),
        F.sum(F.greatest(F.col("_a") - F.col("_e"), F.lit(0))).alias(EXTRA),
    )
    if not few:
        per_key = per_key.join(repeated, pair.on(per_key, repeated), "left_semi")
    of_kind = ", ".join(f"struct('{kind}' as status, {kind} as rows)" for kind in (MISSING, EXTRA))
    return written(per_key.selectExpr(*pair.key_names, f"inline(array({of_kind}))").filter("rows > 0"), "left_over")


def _only_changed(pair: _Pair, findings: DataFrame, counts: dict) -> list[DataFrame]:
    """Rows of both sides with a changed key: filtered in place by broadcast keys while those are small.

    The range of the changed keys is pushed into the scan, which skips most of
    a table that is ordered by key when one batch of it is wrong.
    """
    sides = [pair.wide(True), pair.wide(False)]
    changed, found = _keys_with(findings, pair, MISMATCH), counts["changed"]
    if isinstance(sides[0].schema["_k0"].dataType, (T.LongType, T.IntegerType, T.DateType)) and not found.nulls:
        between = F.col("_k0").between(F.lit(found.low), F.lit(found.high))
        sides = [rows.filter(between) for rows in sides]
    if counts["mismatch_bytes"] <= BROADCAST_KEY_BYTES:
        changed = F.broadcast(changed)
    else:
        # most rows of a mostly equal table are not moved: the bitmap of the changed keys leaves them out where they are
        bitmap, words = words_of(changed, counts["mismatched_rows"])
        sides = [maybe_in(rows, [F.col(k) for k in pair.key_names], bitmap, words) for rows in sides]
        sides = _without_hot_keys(pair, sides, findings, counts)
    return [rows.join(changed, pair.on(rows, changed), "left_semi") for rows in sides]


def _unique(pair: _Pair, findings: DataFrame, counts: dict) -> list[DataFrame]:
    """Rows of both sides whose key is unique on both."""
    sides = [pair.wide(True), pair.wide(False)]
    if not counts["duplicate_keys"]:
        return sides
    repeated = _keys_with(findings, pair, DUPLICATE)
    if counts["duplicate_bytes"] <= BROADCAST_KEY_BYTES:
        repeated = F.broadcast(repeated)
    else:
        sides = _without_hot_keys(pair, sides, findings, counts)
    return [rows.join(repeated, pair.on(rows, repeated), "left_anti") for rows in sides]


def _hash_diff(pair: _Pair, findings: DataFrame, counts: dict) -> DataFrame:
    if not counts["missing_rows"] + counts["extra_rows"] + counts["mismatched_rows"]:
        return None
    diff = pair.marker_rows(findings.filter(F.col("status").isin(MISSING, EXTRA)))
    if counts["mismatched_rows"]:
        part = pair.of_groups(counts["changed"].groups)
        left, right = _only_changed(part, findings, counts)
        both = _joined(part, left, right, "inner").withColumn("status", F.lit(MISMATCH))
        diff = diff.unionByName(part.diff_rows(both))
    return written(diff, "diff").drop("entry")


def _joined(pair: _Pair, left: DataFrame, right: DataFrame, how: str, null_keys: bool = True) -> DataFrame:
    """Both sides of each key in one row; the keys once.

    Without null keys the join is on the keys themselves, so that a side that
    lies by key need not be moved.
    """
    right = right.withColumnsRenamed({k: f"r{k}" for k in pair.key_names})
    on = reduce(and_, [F.col(k).eqNullSafe(F.col(f"r{k}")) if null_keys else F.col(k) == F.col(f"r{k}") for k in pair.key_names])
    joined = left.join(right, on, how)
    if how == "full":
        joined = joined.withColumns({k: F.coalesce(F.col(k), F.col(f"r{k}")) for k in pair.key_names})
    return joined.drop(*[f"r{k}" for k in pair.key_names])


def _exact_diff(pair: _Pair, findings: DataFrame, counts: dict):
    left, right = _unique(pair, findings, counts)
    left, right = left.withColumn("_in_e", F.lit(True)), right.withColumn("_in_a", F.lit(True))
    status = (
        F.when(F.col("_in_a").isNull(), MISSING)
        .when(F.col("_in_e").isNull(), EXTRA)
        .when(pair.any_cell_differs(), MISMATCH)
        .otherwise(MATCH)
    )
    rows = _joined(pair, left, right, "full", counts["null_keys"]).withColumn("status", status)
    return _counted(pair.diff_rows(rows.filter(F.col("status") != MATCH)), "diff")


def _anti_diff(pair: _Pair, findings: DataFrame, counts: dict):
    left, right = _unique(pair, findings, counts)
    both = _joined(pair, left, right, "inner", counts["null_keys"]).filter(pair.any_cell_differs())
    cells, mismatched = _counted(pair.diff_rows(both.withColumn("status", F.lit(MISMATCH))), "cells")
    one_sided = pair.marker_rows(findings.filter(F.col("status").isin(MISSING, EXTRA)))
    return one_sided.drop("entry").unionByName(cells), mismatched


def _counted(diff: DataFrame, name: str):
    """The written diff table and the number of changed rows, each of which has one first entry."""
    diff = written(diff, name)
    changed = diff.filter((F.col("diff_type") == MISMATCH) & (F.col("entry") == 0)).count()
    return diff.drop("entry"), changed


def reconcile(
    expected: DataFrame,
    actual: DataFrame,
    keys,
    columns=None,
    *,
    exclude=AUDIT_COLUMNS,
    strategy: str = "hash",
    coerce: bool = False,
    on_duplicate: str = "report",
    hash_bits: int = 128,
    skip_equal: bool = False,
) -> Reconciliation:
    """Compare two tables and return the differences.

    Names match without regard to case.  ``columns`` defaults to all common
    columns but the keys and ``exclude``; an empty list compares keys only.
    Keys that occur more than once on a side are reported in ``duplicates`` and
    fail the verdict; ``on_duplicate="raise"`` turns them into an error.  Their
    rows are compared as sets with repeats: a row that the other side has not,
    or not so often, is missing or extra, and a difference of several rows says
    how many.  So every row is matched, mismatched, missing or extra.

    Without ``coerce`` values of different kinds are compared as the text they
    print as; with it text is read by the type of the other side, a date
    counts as its midnight and a boolean as 0 or 1.  ``hash_bits=64`` shuffles a
    third less; two rows are only compared on the same key, so one changed row
    in 2**64 would be missed.

    ``skip_equal`` first compares fingerprints of slices of the key space, one
    scan of both tables that moves next to nothing.  Equal tables end there, and
    equal slices take no part in the comparison; of them only one side's keys
    are counted, to list repeated ones.  It pays where most data is equal and a
    scan is cheap, and costs that scan where differences are everywhere.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}, got {strategy!r}")
    if on_duplicate not in ("report", "raise"):
        raise ValueError(f"on_duplicate must be 'report' or 'raise', got {on_duplicate!r}")
    if hash_bits not in (64, 128):
        raise ValueError(f"hash_bits must be 64 or 128, got {hash_bits!r}")
    keys = [k.lower() for k in ([keys] if isinstance(keys, str) else keys)]
    if not keys:
        raise ValueError("at least one key column is needed")
    if columns is None:
        columns = compare_columns(expected, actual, keys, exclude)
    pair = _Pair(expected, actual, keys, [c.lower() for c in columns], coerce, hash_bits)

    equal = _equal_slices(pair) if skip_equal else None
    if equal is None:
        findings, counts = _run_census(pair, hashed=strategy == "hash")
    else:
        pair = equal.rest or pair.in_slices([], SLICES)
        if equal.rest is None:
            findings, counts = _nothing_found(pair)
        else:
            findings, counts = _run_census(pair, strategy == "hash", equal.rest_rows)
    if on_duplicate == "raise" and counts["duplicate_keys"] + (equal.repeated_keys if equal else 0):
        raise DuplicateKeyError(f"some key(s) of {keys} occur more than once")

    if strategy == "hash":
        unique = dict(counts)

        def unique_diff():
            return _hash_diff(pair, findings, unique)
    elif equal is not None and equal.rest is None:
        def unique_diff():
            return None
    else:
        compare = _exact_diff if strategy == "exact" else _anti_diff
        diff, changed = compare(pair, findings, counts)
        # the census saw keys only: a key on both sides matches unless a cell differs
        counts["mismatched_rows"] = changed
        counts["matched_rows"] -= changed

        def unique_diff():
            return diff

    left_over = _left_over(pair, findings, counts) if counts["duplicate_keys"] else None
    if left_over is not None:
        rows = dict(left_over.groupBy("status").agg(F.sum("rows")).collect())  # two at most
        counts["missing_rows"] += rows.get(MISSING, 0)
        counts["extra_rows"] += rows.get(EXTRA, 0)
        counts["matched_rows"] += counts["duplicate_rows"] - rows.get(MISSING, 0)

    def find_diff():
        parts = [unique_diff()]
        if left_over is not None:
            parts.append(pair.marker_rows(left_over, "rows").drop("entry"))
        return reduce(DataFrame.unionByName, [p for p in parts if p is not None])

    several = findings
    if equal is not None:
        for name in ("source_rows", "target_rows", "matched_rows"):
            counts[name] += equal.rows
        counts["duplicate_keys"] += equal.repeated_keys
        several = several.select(*equal.repeated.columns).unionByName(equal.repeated)
    counts["total_diffs"] = counts["missing_rows"] + counts["extra_rows"] + counts["mismatched_rows"]
    names = ("source_rows", "target_rows", "matched_rows", "missing_rows", "extra_rows",
             "mismatched_rows", "total_diffs", "duplicate_keys")
    report = {n: counts[n] for n in names}
    return Reconciliation(expected.sparkSession, report, _duplicate_report(pair, several), find_diff)


class _Equal(NamedTuple):
    """What fingerprints settle: rows that both sides have, their repeated keys, and the pair that is left to compare."""

    rows: int
    repeated: DataFrame
    repeated_keys: int
    rest: _Pair | None
    rest_rows: tuple[int, int]


def _equal_slices(pair: _Pair) -> _Equal:
    slices = pair.fingerprints(SLICES).collect()  # as many numbers as there are slices
    same, other = ([r for r in slices if r.same == kind] for kind in (True, False))
    part = pair if not other else pair.in_slices([r["_slice"] for r in same], SLICES)
    counted = part.keys_of(True).groupBy(*pair.key_names).agg(F.count(F.lit(1)).alias("expected_rows")).filter("expected_rows > 1")
    repeated = written(
        counted.select(*pair.key_names, "expected_rows", F.col("expected_rows").alias("actual_rows"), F.lit(DUPLICATE).alias("status")), "repeated"
    )
    rest = pair.in_slices([r["_slice"] for r in other], SLICES) if other else None
    rest_rows = sum(r.expected_rows for r in other), sum(r.actual_rows for r in other)
    return _Equal(sum(r.expected_rows for r in same), repeated, repeated.count(), rest, rest_rows)


def _nothing_found(pair: _Pair):
    names = ("source_rows", "target_rows", "matched_rows", "missing_rows", "extra_rows", "mismatched_rows", "duplicate_keys")
    columns = [*pair.key_names, "0L as expected_rows", "0L as actual_rows", "'' as status"]
    return pair.keys_of(True).limit(0).selectExpr(*columns), dict.fromkeys(names, 0)


def _duplicate_report(pair: _Pair, findings: DataFrame) -> DataFrame:
    """One row per repeated key with the number of rows on each side."""
    in_e, in_a = F.col("expected_rows") > 1, F.col("actual_rows") > 1
    return findings.filter(F.col("status") == DUPLICATE).select(
        F.expr(key_text(pair.key_names)).alias("primary_key_value"),
        "expected_rows",
        "actual_rows",
        F.when(in_e & in_a, "DUPLICATE_KEY_IN_BOTH")
        .when(in_e, "DUPLICATE_KEY_IN_SOURCE")
        .otherwise("DUPLICATE_KEY_IN_TARGET")
        .alias("diff_type"),
    )
