"""Differences between two copies of a data set.

Each task first counts the repeats among its own rows (an Arrow combiner, so heavily repeated rows hardly travel). Both
copies are then range-partitioned *together* by key and row hash: one sample gives split points that both sides share,
and a key with very many different rows spreads over several ranges. After sorting inside the partitions a two-pointer
merge streams over Arrow batches. What a key has at the seam of two ranges is a small mergeable state, and the states meet
in one aggregation.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MISSING_IN_CANDIDATE, MISSING_IN_BASELINE, COPIES, ROWS = "missing_in_candidate", "missing_in_baseline", "copies", "rows"
_COUNT, _SIDE, _HASH = "__n", "__side", "__h"


def _prepare(df: DataFrame, keys: dict[str, Column], fields: list[str], side: int) -> DataFrame:
    coded = [F.coalesce(F.concat(F.lit("v"), e.cast("string")), F.lit("n")).alias(f"__k{i}") for i, e in enumerate(keys.values())]
    values = [F.col(f"`{f}`").cast("string").alias(f"__f{i}") for i, f in enumerate(fields)]
    return df.select(*coded, F.lit(side).cast("int").alias(_SIDE), *values)


def _combine(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch's distinct rows with their number."""
    for b in batches:
        t = pa.Table.from_batches([b])
        got = t.append_column(_COUNT, pa.array(np.ones(len(t), dtype=np.int64))).group_by(t.column_names).aggregate([(_COUNT, "sum")])
        yield from got.rename_columns([*t.column_names, _COUNT]).combine_chunks().to_batches()


def _hashes(pdf: pd.DataFrame, fields: list[str]) -> np.ndarray:
    """A 64-bit hash of every field's value; null has one of its own."""
    out = np.empty((len(pdf), len(fields)), dtype=np.uint64)
    for j, f in enumerate(fields):
        v = pdf[f].to_numpy(dtype=object)
        null = pd.isna(v)
        out[:, j] = pd.util.hash_array(np.where(null, "", v), categorize=False) * np.uint64(2) + np.uint64(1)
        out[null, j] = np.uint64(0x9E3779B97F4A7C15)
    return out


class _Merge:
    """Two-pointer merge of rows sorted by key, row hash and side, batch by batch.

    The state of a key is linear, so it can be summed over batches and ranges: distinct rows and copies per side, and for
    each field (and the whole row) the sum of the hashes of the baseline's distinct rows minus that of the candidate's.
    """

    def __init__(self, n_keys: int, fields: list[str]):
        self.keys = [f"__k{i}" for i in range(n_keys)]
        self.names = fields
        self.fields = [f"__f{i}" for i in range(len(fields))]
        self.open: tuple[list[str], np.ndarray] | None = None
        self.seams: list[tuple[list[str], np.ndarray]] = []
        self.tail: pd.DataFrame | None = None
        self.first = True

    def findings(self, states: np.ndarray) -> list[tuple[np.ndarray, str]]:
        """Rows of ``states`` with each finding."""
        n0, n1, c0, c1 = states[:, :4].T
        both = (n0 > 0) & (n1 > 0)
        diff = states[:, 4:-1] != 0
        out = [(np.flatnonzero(n1 == 0), MISSING_IN_CANDIDATE), (np.flatnonzero(n0 == 0), MISSING_IN_BASELINE)]
        out += [(np.flatnonzero(both & diff[:, j]), name) for j, name in enumerate(self.names)]
        out.append((np.flatnonzero(both & (c0 != c1)), COPIES))
        out.append((np.flatnonzero(both & ~diff.any(axis=1) & (states[:, -1] != 0)), ROWS))
        return out

    def states(self, rows: pd.DataFrame, group: np.ndarray) -> np.ndarray:
        """The state of each group of rows (numbered from 0, in order)."""
        side = rows[_SIDE].to_numpy()
        n = int(group[-1]) + 1
        out = np.zeros((n, 5 + len(self.fields)), dtype=np.int64)
        np.add.at(out, (group, side), 1)
        np.add.at(out, (group, 2 + side), rows[_COUNT].to_numpy())
        # One row on each side, of which the group is not at a seam: the values themselves are compared.
        plain = (out[:, 0] == 1) & (out[:, 1] == 1)
        plain[[0, -1]] = False
        at = np.flatnonzero(plain[group])
        a, b = at[side[at] == 0], at[side[at] == 1]
        order = np.argsort(group[a]), np.argsort(group[b])
        a, b = a[order[0]], b[order[1]]
        for j, f in enumerate(self.fields):
            v = rows[f].to_numpy(dtype=object)
            x, y = v[a], v[b]
            none_x, none_y = pd.isna(x), pd.isna(y)
            out[group[a], 4 + j] = np.where(none_x | none_y, none_x != none_y, x != y)
        # All others by sums of hashes, which wrap around.
        rest = np.flatnonzero((~plain & (((out[:, 0] > 0) & (out[:, 1] > 0)) | (np.arange(n) == 0) | (np.arange(n) == n - 1)))[group])
        if len(rest):
            h = _hashes(rows.iloc[rest], self.fields)
            h = np.column_stack([h, rows[_HASH].to_numpy()[rest].astype(np.int64).view(np.uint64)]).view(np.int64)
            np.add.at(out[:, 4:], group[rest], np.where(side[rest][:, None] == 0, h, -h))
        return out

    def _distinct(self, pdf: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray, np.ndarray]:
        """One row per key, row hash and side, the number of its key, and the number of its key and hash."""
        new_key = np.ones(len(pdf), dtype=bool)
        new_key[1:] = False
        for k in self.keys:
            v = pdf[k].to_numpy(dtype=object)
            new_key[1:] |= v[1:] != v[:-1]
        h, side = pdf[_HASH].to_numpy(), pdf[_SIDE].to_numpy()
        new_row, new_side = new_key.copy(), new_key.copy()
        new_row[1:] |= h[1:] != h[:-1]
        new_side[1:] |= new_row[1:] | (side[1:] != side[:-1])
        at = np.flatnonzero(new_side)
        one = pdf.iloc[at].copy()
        one[_COUNT] = np.add.reduceat(pdf[_COUNT].to_numpy(), at)
        return one, np.cumsum(new_key)[at] - 1, np.cumsum(new_row)[at] - 1

    def rows(self, pdf: pd.DataFrame, last: bool = False) -> list[pd.DataFrame]:
        """Findings of the keys that this batch completes."""
        one, group, row = self._distinct(pdf if self.tail is None else pd.concat([self.tail, pdf], ignore_index=True))
        if last:
            self.tail = None
        else:
            # Copies of the last row may go on in the next batch.
            self.tail = one[row == row[-1]]
            keep = row < row[-1]
            one, group = one[keep], group[keep]
        if not len(one):
            return []
        group = group - group[0]
        states = self.states(one, group)
        firsts = np.flatnonzero(np.r_[True, np.diff(group) > 0])
        key = lambda g: one[self.keys].iloc[firsts[g]].tolist()
        done = []
        if self.open is not None:
            if self.open[0] == key(0):
                states[0] += self.open[1]
            else:
                done.append(self._close())
        end = len(states) - 1
        self.open = (key(end), states[end])
        if end:
            begin = 0
            if self.first:
                self.seams.append((key(0), states[0]))
                self.first = False
                begin = 1
            for at, name in self.findings(states[begin:end]):
                got = one[self.keys].iloc[firsts[at + begin]].reset_index(drop=True)
                done.append(got.assign(finding=name, state=None))
        return [d for d in done if len(d)]

    def _close(self) -> pd.DataFrame:
        """The open key is complete; the first one of the range is kept for the seam."""
        key, state = self.open
        if self.first:
            self.seams.append((key, state))
            self.first = False
            return pd.DataFrame()
        found = [name for at, name in self.findings(state[None]) if len(at)]
        return pd.DataFrame([[*key, name, None] for name in found], columns=[*self.keys, "finding", "state"])

    def end(self) -> list[pd.DataFrame]:
        done = self.rows(self.tail.iloc[:0], last=True) if self.tail is not None and len(self.tail) else []
        if self.open is not None:
            self.seams.append(self.open)
        if self.seams:
            done.append(pd.DataFrame([[*k, None, s.tolist()] for k, s in self.seams], columns=[*self.keys, "finding", "state"]))
        return done


def diff_copies(base: DataFrame, cand: DataFrame, keys: dict[str, Column], fields: list[str]) -> DataFrame:
    """Findings of ``cand`` against ``base``: the key columns (as strings) and ``finding``.

    ``keys`` maps result names to expressions that both copies can evaluate; ``fields`` are compared raw.
    A null key is a key of its own; null equals null, null and empty differ; NaN equals NaN. Repeated rows only
    count (``copies``). If rows of one key in one copy are not identical, all of them are compared: a field is reported
    if the values that it has in the distinct rows of either copy are not the same ones, each as often (a distinct row
    more in one copy makes every field differ), and ``rows`` if only their combination differs. Columns outside ``keys``
    and ``fields`` are ignored. Two empty copies give no rows; one empty copy makes every key of the other missing.
    """
    both = _prepare(base, keys, fields, 0).unionByName(_prepare(cand, keys, fields, 1))
    ks = [f"__k{i}" for i in range(len(keys))]
    vs = [f"__f{i}" for i in range(len(fields))]
    text = T.StringType()
    counted = both.mapInArrow(_combine, T.StructType([*both.schema.fields, T.StructField(_COUNT, T.LongType())]))
    hashed = counted.withColumn(_HASH, F.xxhash64(*vs) if vs else F.lit(0).cast("long"))
    ranged = hashed.repartitionByRange(*ks, _HASH).sortWithinPartitions(*ks, _HASH, _SIDE)
    schema = T.StructType([*(T.StructField(k, text) for k in ks), T.StructField("finding", text), T.StructField("state", T.ArrayType(T.LongType()))])
    names, n = list(fields), len(ks)

    def merge(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = _Merge(n, names)
        for pdf in batches:
            if len(pdf):
                yield from m.rows(pdf)
        yield from m.end()

    merged = ranged.mapInPandas(merge, schema)
    # Interior keys have their findings; the at most two seam keys of a range are summed over the ranges.
    size = 5 + len(fields)
    at = lambda i: F.col("state")[i]
    # Sums wrap around like those of the merge: halves are added apart, so that no overflow is an error.
    low = [F.sum(F.pmod(at(i), F.lit(1 << 32))).alias(f"l{i}") for i in range(size)]
    high = [F.sum(F.shiftright(at(i), 32)).alias(f"h{i}") for i in range(size)]
    kind = F.when(F.col("finding").isNotNull(), F.col("finding"))
    summed = merged.groupBy(*ks, kind.alias("finding")).agg(*low, *high)
    zero = lambda i: (F.pmod(F.col(f"l{i}"), F.lit(1 << 32)) == 0) & (F.pmod(F.col(f"h{i}") + F.shiftright(F.col(f"l{i}"), 32), F.lit(1 << 32)) == 0)
    count = lambda i: F.col(f"h{i}") * (1 << 32) + F.col(f"l{i}")
    has = (count(0) > 0) & (count(1) > 0)
    differs = [~zero(4 + j) for j in range(len(fields))]
    same = F.lit(True)
    for x in differs:
        same = same & ~x
    tests = [(count(1) == 0, MISSING_IN_CANDIDATE), (count(0) == 0, MISSING_IN_BASELINE), *[(has & x, name) for x, name in zip(differs, names)], (has & (count(2) != count(3)), COPIES), (has & same & ~zero(size - 1), ROWS)]
    listed = F.array(*[F.when(test, F.lit(name)) for test, name in tests])
    found = summed.select(*ks, F.explode(F.when(F.col("finding").isNotNull(), F.array("finding")).otherwise(F.array_compact(listed))).alias("finding"))
    decode = [F.when(F.col(k) != "n", F.expr(f"substring({k}, 2)")).alias(name) for k, name in zip(ks, keys)]
    return found.select(*decode, "finding")


def schema_difference(base: DataFrame, cand: DataFrame) -> dict[str, list[str]]:
    """Header comparison: columns only in one copy, and whether the order differs."""
    b, c = base.columns, cand.columns
    return {"only_base": [x for x in b if x not in c], "only_cand": [x for x in c if x not in b], "reordered": [x for x in b if x in c] if set(b) == set(c) and b != c else []}


def multiset_diff(base: DataFrame, cand: DataFrame) -> DataFrame:
    """Rows added or removed as multisets, all columns as strings: ``change``, the columns, ``copies``.

    One aggregation instead of two ``exceptAll``: the signed count of each distinct row decides its side.
    """
    cols = base.columns
    s = lambda df, sign: df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in cols], F.lit(sign).cast("long").alias("__d"))
    net = s(base, -1).unionByName(s(cand, 1)).groupBy(*[f"`{c}`" for c in cols]).agg(F.sum("__d").alias("__net")).filter("__net != 0")
    return net.select(F.when(F.col("__net") > 0, "added").otherwise("removed").alias("change"), *[F.col(f"`{c}`") for c in cols], F.abs("__net").alias("copies"))
