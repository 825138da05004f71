"""Boosted trees on sparse features in one Spark barrier job.

Values are cut into at most ``max_bin`` quantile bins per feature (one aggregate
over all non-zero entries).  A barrier job's tasks then hold the binned entries of
their rows for the whole fit, so a tree costs a few exchanges instead of several
Spark jobs.  Every task sums gradients and hessians of its rows by bin for the root
and, below it, for the lighter child of every split; each task owns a range of
features, receives the others' sums of that range, takes the heavier child's as what
is left of the parent's and finds its best splits; the small lists of best splits are
gathered by all.  What travels follows bins and nodes, never rows.  Features that
cannot hold ``min_child_weight`` are left out; that list is made anew only when the
margins may have moved so far that another feature could.

Objective: logistic loss with second-order gains,
``T(G_l)^2 / (H_l + lambda) + T(G_r)^2 / (H_r + lambda) - T(G)^2 / (H + lambda)``
with ``T(G) = sign(G) max(|G| - alpha, 0)``; a split needs a gain above ``gamma``
and ``min_child_weight`` hessian on both sides.  A zero entry is a missing value:
each split learns the side where those go.  ``subsample`` draws rows and
``colsample_bytree`` features anew for every tree.

Rows marked as validation carry no weight; their margins run along, and after each
tree their AUC (exact, by exchanged counts per margin) decides about stopping: no
tree is grown beyond ``best + rounds``.

A lost executor restarts the barrier stage; every ``SAVE_EVERY`` trees the first
task saves the trees to the shared folder, and a restart goes on from there.
"""

from __future__ import annotations

import base64
import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import asdict, dataclass
from pathlib import Path
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import BarrierTaskContext
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexis.session import materialize, shared_path

ENTRIES_PER_TASK = 100_000
SAVE_EVERY = 50
BIN, BINS = 32, (1 << 32) - 1  # a key is a node's place above 32 bits of a bin's
DRIFT = 0.5  # margins may move so far before the list of features is made anew
SLICE_CELLS = 1 << 21
SLICE_ENTRIES = 1 << 19  # entries of a task that a step works on at a time
MIN_GAIN = 1e-6


@dataclass(frozen=True)
class BoostParams:
    """Parameters under their usual names; ``early_stopping_rounds`` needs validation rows."""

    n_estimators: int = 100
    max_depth: int = 6
    learning_rate: float = 0.3
    subsample: float = 1.0
    colsample_bytree: float = 1.0
    gamma: float = 0.0
    min_child_weight: float = 1.0
    reg_alpha: float = 0.0
    reg_lambda: float = 1.0
    max_bin: int = 64
    random_state: int = 42
    early_stopping_rounds: int | None = None

    def __post_init__(self):
        for name, low, high in (("n_estimators", 1, 1_000_000), ("max_depth", 1, 30), ("learning_rate", 0, 10), ("subsample", 0, 1),
                                ("colsample_bytree", 0, 1), ("gamma", 0, np.inf), ("min_child_weight", 0, np.inf), ("reg_alpha", 0, np.inf),
                                ("reg_lambda", 0, np.inf), ("max_bin", 2, 65_536)):
            value = getattr(self, name)
            if not low <= value <= high or (value == 0 and name in ("learning_rate", "subsample", "colsample_bytree")):
                raise ValueError(f"{name}={value} is not supported ({low} to {high})")


@dataclass
class Tree:
    """Nodes of one tree; the right child follows the left one, a leaf has feature -1."""

    feature: np.ndarray
    threshold: np.ndarray
    missing_left: np.ndarray
    left: np.ndarray
    value: np.ndarray

    def rows(self) -> list[tuple]:
        return list(zip(self.feature.tolist(), self.threshold.tolist(), self.missing_left.tolist(), self.left.tolist(), self.value.tolist()))

    @classmethod
    def of(cls, rows) -> "Tree":
        columns = list(zip(*rows))
        return cls(*(np.array(c, t) for c, t in zip(columns, (np.int64, np.float64, bool, np.int64, np.float64))))

    def leaves(self, x: np.ndarray, column_of: dict[int, int]) -> np.ndarray:
        """Value of each row of ``x`` (NaN: missing), whose columns are ``column_of`` features."""
        node, every = np.zeros(len(x), np.int64), np.arange(len(x))
        at = np.array([column_of.get(int(f), 0) for f in self.feature], np.int64)
        while (inner := self.feature[node] >= 0).any():
            v = x[every, at[node]]
            goes_left = np.where(np.isnan(v), self.missing_left[node], v <= self.threshold[node])
            node = np.where(inner, self.left[node] + ~goes_left, node)
        return self.value[node]


# --------------------------------------------------------------------------- shared folder
class _Store:
    """Whole files below a folder that all executors share."""

    def __init__(self, uri: str):
        parts = urlparse(uri)
        self.local = Path(parts.path) if parts.scheme in ("", "file") else None
        if self.local is None:
            self.fs, self.root = fs.FileSystem.from_uri(uri)

    def put(self, name: str, data: bytes) -> None:
        draft = f".{name}-{uuid.uuid4().hex}"
        if self.local is not None:
            self.local.mkdir(parents=True, exist_ok=True)
            (self.local / draft).write_bytes(data)
            (self.local / draft).rename(self.local / name)
            return
        self.fs.create_dir(self.root, recursive=True)
        with self.fs.open_output_stream(f"{self.root}/{draft}") as out:
            out.write(data)
        self.fs.move(f"{self.root}/{draft}", f"{self.root}/{name}")

    def get(self, name: str, start: int = 0, size: int = -1) -> bytes | None:
        if self.local is not None:
            if not (self.local / name).exists():
                return None
            with (self.local / name).open("rb") as found:
                found.seek(start)
                return found.read(size)
        if self.fs.get_file_info(f"{self.root}/{name}").type == fs.FileType.NotFound:
            return None
        with self.fs.open_input_file(f"{self.root}/{name}") as found:
            found.seek(start)
            return found.read(None if size < 0 else size)

    def drop(self, name: str) -> None:
        if self.local is not None:
            (self.local / name).unlink(missing_ok=True)
        else:
            self.fs.delete_file(f"{self.root}/{name}")


class _Team:
    """The tasks of the barrier stage, which meet by files of the shared folder: a
    file written under its last name is whole, and a task that has every file of a
    step knows that all have read the step before.  (Spark's own ``allGather`` takes
    about half a second a call; it only names the attempt.)  When a task is lost,
    Spark ends the others, waiting ones too."""

    def __init__(self, store: _Store):
        self.task, self.store, self.step, self.mine = BarrierTaskContext.get(), store, 0, []
        self.rank, self.size = self.task.partitionId(), len(self.task.getTaskInfos())
        self.round = self.task.allGather(uuid.uuid4().hex)[0] if self.size > 1 else ""  # names of one attempt of the stage

    def exchange(self, parts: list[bytes]) -> list[bytes]:
        """``parts[q]`` of every task, at task q."""
        if self.size == 1:
            return parts
        head = np.cumsum([0, *map(len, parts)]).astype(np.int64).tobytes()
        return self._meet(head + b"".join(parts), len(head))

    def gather(self, part: bytes) -> list[bytes]:
        """``part`` of every task, at all tasks."""
        return [part] if self.size == 1 else self._meet(part, 0)

    def _meet(self, data: bytes, head: int) -> list[bytes]:
        name = f"{self.round}-{self.step}"
        self.step += 1
        self.store.put(f"{name}-{self.rank}", data)
        self.mine.append(f"{name}-{self.rank}")
        found: list[bytes | None] = [None] * self.size
        pause, longest = 0.0005, 0.005 if self.store.local is not None else 0.05
        while True:
            for q in (q for q in range(self.size) if found[q] is None):
                if not head:
                    found[q] = self.store.get(f"{name}-{q}")
                elif (span := self.store.get(f"{name}-{q}", 8 * self.rank, 16)) is not None:
                    start, end = np.frombuffer(span, np.int64)
                    found[q] = self.store.get(f"{name}-{q}", head + int(start), int(end - start)) if end > start else b""
            if all(x is not None for x in found):
                break
            time.sleep(pause)
            pause = min(1.5 * pause, longest)
        while len(self.mine) > 1:
            self.store.drop(self.mine.pop(0))
        return found


# --------------------------------------------------------------------------- one task's part of the fit
class _Rows:
    """Binned entries of a task's rows, ordered by bin (so by feature), with labels and weights.
    Batches are binned and ordered as they come, a slice at a time, and dealt to their places at
    the end, so that little more than two numbers of four bytes is held for an entry."""

    def __init__(self, batches: Iterator[pa.RecordBatch], offsets: np.ndarray, cuts: np.ndarray):
        ids, y, w, held, parts, first = [], [], [], [], [], 0
        kind = np.int32 if offsets[-1] < 1 << 31 else np.int64
        sizes = np.zeros(int(offsets[-1]), np.int64)
        for batch in batches:
            get = lambda n: batch.column(batch.schema.get_field_index(n))
            ids.append(get("row").to_numpy(zero_copy_only=False))
            y.append(get("label").to_numpy(zero_copy_only=False))
            w.append(get("weight").to_numpy(zero_copy_only=False))
            held.append(get("held").to_numpy(zero_copy_only=False))
            ends, index, amount = get("indices").offsets.to_numpy(), get("indices").values, get("values").values
            shift = int(get("values").offsets.to_numpy()[0]) - int(ends[0])
            a = 0
            while a < batch.num_rows:
                b = max(a + 1, int(np.searchsorted(ends, ends[a] + SLICE_ENTRIES, "right")) - 1)
                n = int(ends[b] - ends[a])
                feature = np.asarray(index.slice(int(ends[a]), n).to_numpy(zero_copy_only=False), np.int64)
                value = np.asarray(amount.slice(int(ends[a]) + shift, n).to_numpy(zero_copy_only=False), float)
                row = np.repeat(np.arange(first + a, first + b, dtype=np.int32), np.diff(ends[a:b + 1]))
                known = (value != 0) & (feature < len(offsets) - 1)
                known[known] = offsets[feature[known] + 1] > offsets[feature[known]]
                found = _bin_of(feature[known], value[known], offsets, cuts).astype(kind)
                order = np.argsort(found, kind="stable")
                parts.append((row[known][order], found[order]))
                sizes += np.bincount(found, minlength=len(sizes))
                a = b
            first += batch.num_rows
        join = lambda parts, t: np.concatenate([np.asarray(p, t) for p in parts]) if parts else np.empty(0, t)
        self.ids, self.y, self.w, self.held = join(ids, np.uint64), join(y, float), join(w, float), join(held, bool)
        start = np.append(0, np.cumsum(sizes))
        self.edges, self.entry_row = start[offsets], np.empty(int(start[-1]), np.int32)
        parts.reverse()
        while parts:  # in the order of rows, so that a bin's are in order too
            row, found = parts.pop()
            head = np.flatnonzero(np.append(True, found[1:] != found[:-1])[:len(found)])
            count = np.diff(np.append(head, len(found)))
            self.entry_row[np.arange(len(found)) + np.repeat(start[found[head]] - head, count)] = row
            start[found[head]] += count
        self.entry_bin = np.repeat(np.arange(len(sizes), dtype=kind), sizes)


def _bin_of(feature: np.ndarray, value: np.ndarray, offsets: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """The first bin of each entry's feature whose edge is not below the value, else the last."""
    low, high = offsets[feature], offsets[feature + 1] - 1
    while (low < high).any():
        middle = (low + high) >> 1
        above = ~(cuts[middle] >= value)
        low, high = np.where(above & (low < high), middle + 1, low), np.where(above, high, middle)
    return low


def _pieces(start: np.ndarray, n: int) -> Iterator[tuple[int, int, int, int]]:
    """Runs of whole bins, which begin at ``start`` among ``n`` entries, of about ``SLICE_ENTRIES``:
    ``(from bin, to bin, from entry, to entry)``."""
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(start, start[i] + SLICE_ENTRIES, "right")) - 1)
        if start[-1] - start[i] < SLICE_ENTRIES:
            j = len(start)
        yield i, j, int(start[i]), int(start[j]) if j < len(start) else n
        i = j


def _draw(ids: np.ndarray, seed: int, share: float) -> np.ndarray:
    """A seeded choice of rows that does not depend on their partition."""
    with np.errstate(over="ignore"):
        x = ids * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed * 2 + 1) * np.uint64(0xD6E8FEB86659FD93)
        for _ in range(2):
            x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x >> np.uint64(11)) < np.uint64(int(share * (1 << 53)))


def _sorted_sums(key: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sums of the columns over runs of equal keys."""
    if not len(key):
        return key, *columns
    start = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return key[start], *(np.add.reduceat(x, start) for x in columns)


def _able(table: tuple, feature_of_bin: np.ndarray, p: BoostParams) -> tuple[tuple, np.ndarray, np.ndarray]:
    """The sums ``(key, g, h, rows)`` of the (node, feature) that hold enough hessian
    for a split, where these start, and their sizes; another one cannot in a child either."""
    key = table[0]
    if not len(key):
        return table, key, key
    feature = feature_of_bin[key & BINS]
    start = np.flatnonzero(np.append(True, (feature[1:] != feature[:-1]) | (key[1:] >> BIN != key[:-1] >> BIN)))
    sizes = np.diff(np.append(start, len(key)))
    able = np.add.reduceat(table[2], start) >= p.min_child_weight * (1 - 1e-9)
    if able.all():
        return table, start, sizes
    keep, sizes = np.repeat(able, sizes), sizes[able]
    return tuple(x[keep] for x in table), np.cumsum(sizes) - sizes, sizes


def _children(table: tuple, light: tuple, parents: np.ndarray, right: np.ndarray, index: np.ndarray, n_level: int) -> tuple:
    """Sums of a split level's children, from the ``table`` of its ``n_level`` nodes and those
    of the lighter children ``light`` (keyed by their number).  Lighter child k is the right
    one of node ``parents[k]`` where ``right``; ``index`` gives the place of every child (left
    and right of each) on the next level, -1: not there."""
    number = np.full(n_level, -1, np.int64)
    number[parents] = np.arange(len(parents))
    of = number[table[0] >> BIN]
    split = of >= 0
    key, of = (of[split] << BIN) | (table[0][split] & BINS), of[split]
    rest = [x[split] for x in table[1:]]
    at = np.minimum(np.searchsorted(key, light[0]), max(len(key) - 1, 0))
    hit = key[at] == light[0] if len(key) else np.zeros(len(at), bool)  # features that the parent has given up are passed over
    light, at = [x[hit] for x in light], at[hit]
    for whole, part in zip(rest, light[1:]):
        whole[at] -= part
    rest[1] = np.maximum(rest[1], 0.0)
    other = index[2 * np.arange(len(parents)) + ~right]
    left = (rest[2] > 0.5) & (other[of] >= 0)  # bins without rows go; rows are counted exactly
    heavy = [(other[of[left]] << BIN) | (key[left] & BINS), *(x[left] for x in rest)]
    own = index[2 * np.arange(len(parents)) + right][light[0] >> BIN]
    light = [(own[own >= 0] << BIN) | (light[0][own >= 0] & BINS), *(x[own >= 0] for x in light[1:])]
    at = np.searchsorted(heavy[0], light[0]) + np.arange(len(light[0]))  # both are in order
    free = np.ones(len(heavy[0]) + len(at), bool)
    free[at] = False
    out = tuple(np.empty(len(free), x.dtype) for x in heavy)
    for whole, a, b in zip(out, heavy, light):
        whole[free], whole[at] = a, b
    return out


def _best_splits(key, g, h, start, sizes, totals, feature_of_bin, p: BoostParams) -> list:
    """Best split of each node from sorted (node, bin) sums, those of a (node, feature) of
    ``sizes`` from ``start``: ``[gain, feature, bin, missing_left, G_left, H_left]`` or
    None; of equal gains the smaller bin wins, of its sides missing values to the right."""
    out: list = [None] * len(totals)
    if not len(key):
        return out
    all_g, all_h = np.array(totals).T
    of = key[start] >> BIN
    each = lambda x: np.repeat(x, sizes)
    cg, ch = np.cumsum(g), np.cumsum(h)
    cg, ch = cg - each(cg[start] - g[start]), ch - each(ch[start] - h[start])
    miss_g, miss_h = all_g[of] - np.add.reduceat(g, start), all_h[of] - np.add.reduceat(h, start)

    def score(s, t):
        s = np.square(np.maximum(np.abs(s) - p.reg_alpha, 0.0) if p.reg_alpha else s)
        return s / np.maximum(t + p.reg_lambda, 1e-16)

    rest = score(all_g, all_h)
    for side, (mg, mh) in enumerate(((None, None), (miss_g, miss_h))):  # missing to the right, to the left
        lh = ch if side == 0 else ch + each(mh)
        rh = each(all_h[of]) - lh
        fair = np.flatnonzero((lh >= p.min_child_weight) & (rh >= p.min_child_weight) & (lh > 0) & (rh > 0))
        if not len(fair):
            continue
        lh, rh = lh[fair], rh[fair]
        lg = cg[fair] if side == 0 else cg[fair] + each(mg)[fair]
        node = key[fair] >> BIN
        gain = score(lg, lh) + score(all_g[node] - lg, rh) - rest[node]
        heads = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
        for a, z in zip(heads, np.append(heads[1:], len(node))):
            i = a + int(np.argmax(gain[a:z]))
            j, at = int(node[i]), int(key[fair[i]] & BINS)
            if gain[i] > max(p.gamma, MIN_GAIN) and (out[j] is None or gain[i] > out[j][0] or (gain[i] == out[j][0] and at < out[j][2])):
                out[j] = [float(gain[i]), int(feature_of_bin[at]), at, bool(side), float(lg[i]), float(lh[i])]
    return out


def _auc(team: _Team, margin: np.ndarray, y: np.ndarray) -> float:
    """AUC over all tasks' rows (ties one half): counts per margin go to the task
    that owns the margin's range."""
    value, at = np.unique(margin, return_inverse=True)
    pos, neg = (np.bincount(at, weights=c, minlength=len(value)) for c in (y, 1 - y))
    owner = np.minimum((team.size / (1 + np.exp(-value))).astype(np.int64), team.size - 1)
    parts = [np.stack([value[owner == q], pos[owner == q], neg[owner == q]]).tobytes() for q in range(team.size)]
    found = np.concatenate([np.frombuffer(x, np.float64).reshape(3, -1) for x in team.exchange(parts)], axis=1)
    value, at = np.unique(found[0], return_inverse=True)
    pos, neg = (np.bincount(at, weights=c, minlength=len(value)) for c in found[1:])
    own = [float(pos.sum()), float(neg.sum()), float((pos * (np.cumsum(neg) - neg / 2)).sum())]
    below = area = positives = 0.0
    for p, n, part in map(json.loads, team.gather(json.dumps(own).encode())):  # ranges in rising order
        area, positives, below = area + part + p * below, positives + p, below + n
    return area / (positives * below) if positives and below else 0.5


class _Listed:
    """A task's entries of the listed features, ordered by bin, and the bins it owns:
    equal for all trees until the list is made anew."""

    def __init__(self, team: _Team, entries: tuple, feature_of_bin: np.ndarray, flag: np.ndarray, offsets: np.ndarray):
        keep = flag[feature_of_bin][entries[1]]
        self.row, self.bin = entries if keep.all() else (entries[0][keep], entries[1][keep])
        whole = np.append(0, np.cumsum(np.diff(offsets) * flag))
        shares = (np.arange(team.size + 1) * whole[-1]) // team.size
        self.ranges = offsets[np.searchsorted(whole, shares, "left")]  # each task owns whole features
        self.ranges[-1] = offsets[-1]
        self.start = np.flatnonzero(np.append(True, self.bin[1:] != self.bin[:-1])[:len(self.bin)])
        key = self.bin[self.start].astype(np.int64)
        self.ends = np.searchsorted(key, self.ranges)
        parts = team.exchange([key[a:b].tobytes() for a, b in zip(self.ends, self.ends[1:])])
        self.key, self.at = np.unique(np.concatenate([np.frombuffer(x, np.int64) for x in parts]), return_inverse=True)

    def root(self, team: _Team, *columns: np.ndarray) -> tuple[tuple, np.ndarray]:
        """Sums of the tasks' ``columns`` by owned bin, and over all rows."""
        own = [np.concatenate([np.add.reduceat(x[self.row[a:z]], self.start[i:j] - a) for i, j, a, z in _pieces(self.start, len(self.row))]
                              or [np.empty(0)]) for x in columns]
        total = [x.sum() for x in columns]
        parts = team.exchange([np.concatenate([total, *(x[a:b] for x in own)]).tobytes() for a, b in zip(self.ends, self.ends[1:])])
        found = [np.frombuffer(x, np.float64) for x in parts]
        n = len(columns)
        sums = [np.bincount(self.at, np.concatenate([x[n:].reshape(n, -1)[k] for x in found]), len(self.key)) for k in range(n)]
        return (self.key, *sums), np.sum([x[:n] for x in found], axis=0)

    def nodes(self, team: _Team, of_row: np.ndarray, size: int, passed: np.ndarray | None, *columns: np.ndarray) -> tuple:
        """Sums of the tasks' ``columns`` by (node, owned bin) for rows with ``of_row < size``,
        without the entries whose bins are ``passed`` over."""
        found = []
        for _, _, a, z in _pieces(self.start, len(self.row)):  # no (node, bin) lies in two
            of_entry = of_row[self.row[a:z]]
            if passed is not None:
                of_entry[passed[self.bin[a:z]]] = size
            order = np.flatnonzero(of_entry < size)
            order = order[np.argsort(of_entry[order], kind="stable")]  # by node, then by bin as before
            at = self.row[a:z][order]
            found.append(_sorted_sums((of_entry[order].astype(np.int64) << BIN) | self.bin[a:z][order], *(x[at] for x in columns)))
        if len(found) == 1:
            (sums,) = found
        elif found:
            sums = tuple(np.concatenate(x) for x in zip(*found))
            order = np.argsort(sums[0], kind="stable")
            sums = tuple(x[order] for x in sums)
        else:
            sums = (np.empty(0, np.int64), *(np.empty(0) for _ in columns))
        if team.size == 1:
            return sums
        owner = np.searchsorted(self.ranges[:-1], sums[0] & BINS, "right") - 1
        parts = team.exchange([b"".join(x[owner == q].tobytes() for x in sums) for q in range(team.size)])
        n = 8 * (1 + len(columns))
        got = [(np.frombuffer(x, np.int64, len(x) // n), *np.frombuffer(x, np.float64, offset=8 * (len(x) // n)).reshape(len(columns), -1))
               for x in parts if x]
        if not got:
            return tuple(x[:0] for x in sums)
        key, *columns = (np.concatenate(x) for x in zip(*got))
        order = np.argsort(key, kind="stable")
        return _sorted_sums(key[order], *(x[order] for x in columns))


def _grow(team: _Team, rows: _Rows, g: np.ndarray, h: np.ndarray, inside: np.ndarray, listed: _Listed, drawn: np.ndarray | None,
          offsets, cuts, feature_of_bin, p: BoostParams) -> tuple[Tree, np.ndarray]:
    """One tree from the rows ``inside`` and the features ``drawn``, and the node where each row ends."""
    one = inside.astype(float)
    table, root = listed.root(team, g, h, one)
    keep = table[3] > 0.5
    passed = None
    if drawn is not None:
        keep &= drawn[feature_of_bin[table[0]]]
        passed = ~drawn[feature_of_bin]
    table = tuple(x[keep] for x in table)
    feature, threshold, missing_left, left, sums = [-1], [0.0], [False], [-1], [(float(root[0]), float(root[1]))]
    place = np.zeros(len(g), np.int64)

    def fit_to_split(j: int) -> bool:
        return sums[j][1] >= 2 * p.min_child_weight and sums[j][1] > 0

    level = [0] if fit_to_split(0) else []
    for depth in range(p.max_depth):
        if not level:
            break
        table, start, sizes = _able(table, feature_of_bin, p)
        mine = _best_splits(*table[:3], start, sizes, [sums[j] for j in level], feature_of_bin, p)
        every = [json.loads(x) for x in team.gather(json.dumps(mine).encode())]
        new, parents, n_level = [], [], len(level)
        for i, (j, options) in enumerate(zip(level, zip(*every))):
            options = [o for o in options if o]
            if not options:
                continue
            _, f, b, side, lg, lh = min(options, key=lambda o: (-o[0], o[2]))
            child = len(feature)
            feature[j], missing_left[j], left[j] = f, side, child
            threshold[j] = float("inf") if b == offsets[f + 1] - 1 else float(cuts[b])
            for s in ((lg, lh), (sums[j][0] - lg, sums[j][1] - lh)):
                feature.append(-1), threshold.append(0.0), missing_left.append(False), left.append(-1), sums.append(s)
            here = place == j
            place[here] = child if side else child + 1
            a, z = rows.edges[f], rows.edges[f + 1]
            hit = rows.entry_row[a:z]
            known = here[hit]
            place[hit[known]] = np.where(rows.entry_bin[a:z][known] <= b, child, child + 1)
            if depth + 1 < p.max_depth and (fit_to_split(child) or fit_to_split(child + 1)):
                new.append(child), parents.append(i)
        level = [j for child in new for j in (child, child + 1) if fit_to_split(j)]
        if not level:
            break
        right = np.array([sums[child + 1][1] < sums[child][1] for child in new])
        spot = np.full(len(feature), len(new), np.int16 if len(new) < 32_000 else np.int64)
        spot[np.array(new) + right] = np.arange(len(new))
        light = listed.nodes(team, np.where(inside, spot[place], len(new)).astype(spot.dtype), len(new), passed, g, h, one)
        index = np.array([fit_to_split(j) for child in new for j in (child, child + 1)])
        index = np.where(index, np.cumsum(index) - 1, -1)
        table = _children(table, light, np.array(parents), right, index, n_level)
    total_g, total_h = np.array(sums).T
    value = -np.sign(total_g) * np.maximum(np.abs(total_g) - p.reg_alpha, 0) / np.maximum(total_h + p.reg_lambda, 1e-16) * p.learning_rate
    value = np.where(np.array(feature) < 0, value, 0.0)
    return Tree(*(np.array(c, t) for c, t in zip((feature, threshold, missing_left, left, value), (np.int64, np.float64, bool, np.int64, np.float64)))), place


def _route(tree: Tree, rows: _Rows, bin_limit: np.ndarray) -> np.ndarray:
    """Leaf of each row under a tree with the limits given as bins."""
    place = np.zeros(len(rows.y), np.int64)
    for j in range(len(tree.feature)):  # parents come before their children
        f = tree.feature[j]
        if f < 0:
            continue
        here = place == j
        place[here] = tree.left[j] + (not tree.missing_left[j])
        a, z = rows.edges[f], rows.edges[f + 1]
        hit = rows.entry_row[a:z]
        inside = here[hit]
        place[hit[inside]] = tree.left[j] + (rows.entry_bin[a:z][inside] > bin_limit[j])
    return place


def _boost(team: _Team, rows: _Rows, offsets: np.ndarray, cuts: np.ndarray, p: BoostParams, store: _Store) -> dict:
    feature_of_bin = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    used = np.flatnonzero(np.diff(offsets))
    weight = np.where(rows.held, 0.0, rows.w)
    fit = (weight > 0)[rows.entry_row]
    entries = (rows.entry_row, rows.entry_bin) if fit.all() else (rows.entry_row[fit], rows.entry_bin[fit])
    del fit
    cells = np.flatnonzero(np.append(True, entries[1][1:] != entries[1][:-1])[:len(entries[1])])
    cell_feature = feature_of_bin[entries[1][cells]]
    owners = (np.arange(team.size + 1) * (len(offsets) - 1)) // team.size

    def heavy(h: np.ndarray) -> np.ndarray:
        """Features whose non-zero entries can hold ``min_child_weight`` hessian as long as no
        margin moves by more than ``DRIFT``: by d, a hessian grows at most ``exp(d)`` times."""
        sums = [np.add.reduceat(h[entries[0][a:z]], cells[i:j] - a) for i, j, a, z in _pieces(cells, len(entries[0]))]
        own = np.bincount(cell_feature, weights=np.concatenate(sums or [np.empty(0)]), minlength=len(offsets) - 1)
        parts = team.exchange([own[a:b].tobytes() for a, b in zip(owners, owners[1:])])
        mine = np.sum([np.frombuffer(x, np.float64) for x in parts], axis=0) >= p.min_child_weight * np.exp(-DRIFT) * (1 - 1e-9)
        return np.frombuffer(b"".join(team.gather(np.asarray(mine, bool).tobytes())), bool)
    margin, trees, aucs, listed, drift = np.zeros(len(rows.y)), [], [], None, 0.0

    saved = store.get("trees.json")
    if saved:
        state = json.loads(saved)
        trees, aucs = [Tree.of(t) for t in state["trees"]], state["aucs"]
        for tree in trees:
            limit = np.array([offsets[f] + np.searchsorted(cuts[offsets[f]:offsets[f + 1]], t) if f >= 0 else 0
                              for f, t in zip(tree.feature, tree.threshold)], np.int64)
            margin += tree.value[_route(tree, rows, limit)]
    team.gather(b"")  # nobody saves before all have read

    def best() -> int:
        return int(np.argmax(aucs)) + 1 if aucs else len(trees)

    while len(trees) < p.n_estimators:
        if p.early_stopping_rounds and aucs and len(trees) - best() >= p.early_stopping_rounds:
            break
        t = len(trees)
        prob = 1 / (1 + np.exp(-margin))
        g, h = weight * (prob - rows.y), weight * np.maximum(prob * (1 - prob), 1e-16)
        if listed is None or drift > DRIFT:
            flag = heavy(h) if p.min_child_weight > 0 else np.ones(len(offsets) - 1, bool)
            listed, drift = None, 0.0
            listed = _Listed(team, entries, feature_of_bin, flag, offsets)
        inside, drawn = weight > 0, None
        if p.subsample < 1:
            inside = inside & _draw(rows.ids, p.random_state * 1_000_003 + t, p.subsample)
            g, h = np.where(inside, g, 0.0), np.where(inside, h, 0.0)
        if p.colsample_bytree < 1 and len(used):
            drawn = np.zeros(len(offsets) - 1, bool)
            drawn[np.random.default_rng([p.random_state, t]).choice(used, max(1, int(p.colsample_bytree * len(used))), replace=False)] = True
        tree, place = _grow(team, rows, g, h, inside, listed, drawn, offsets, cuts, feature_of_bin, p)
        if p.min_child_weight > 0:
            drift += float(np.abs(tree.value).max())
        margin += tree.value[place]
        trees.append(tree)
        if p.early_stopping_rounds:
            aucs.append(_auc(team, margin[rows.held], rows.y[rows.held]))
        if len(trees) % SAVE_EVERY == 0 and team.rank == 0:
            store.put("trees.json", json.dumps({"trees": [x.rows() for x in trees], "aucs": aucs}).encode())
    return {"trees": trees, "aucs": aucs, "best": best() if p.early_stopping_rounds else len(trees)}


# --------------------------------------------------------------------------- Spark side
def entries_of(features: str | Column) -> tuple[Column, Column]:
    """Indices and values of an MLlib vector column without leaving the JVM."""
    v = F.unwrap_udt(features)
    dense = v["indices"].isNull()
    index = F.when(dense, F.sequence(F.lit(0), F.size(v["values"]) - 1)).otherwise(v["indices"])
    return F.when(F.size(v["values"]) == 0, F.array().cast("array<int>")).otherwise(index), v["values"]


def _bins(data: DataFrame, max_bin: int) -> tuple[np.ndarray, np.ndarray]:
    """Offsets per feature and upper edges of all bins: quantiles of the non-zero
    values; at most ``max_bin`` per feature, so the driver's part is bounded by the vocabulary."""
    shares = [(k + 1) / max_bin for k in range(max_bin)]
    entry = data.select(F.explode(F.arrays_zip(F.col("indices").alias("i"), F.col("values").alias("v"))).alias("e")).where("e.v != 0")
    found = entry.groupBy(F.col("e.i").alias("i")).agg(
        F.array_distinct(F.percentile_approx("e.v", shares, 20 * max_bin)).alias("cuts")).toArrow().sort_by("i")
    if not found.num_rows:
        return np.zeros(1, np.int64), np.empty(0)
    index = found.column("i").to_numpy()
    edges = found.column("cuts").combine_chunks()
    sizes = np.zeros(int(index.max()) + 1, np.int64)
    sizes[index] = np.diff(edges.offsets.to_numpy())
    return np.append(0, np.cumsum(sizes)), edges.flatten().to_numpy().astype(float)


def fit_trees(data: DataFrame, params: BoostParams, features: str = "features", label: str = "label", weight: str | None = None,
              held: str | None = None) -> dict:
    """``{"trees", "aucs", "best"}`` of the rows of ``data``; ``held`` names a
    boolean column that marks validation rows."""
    spark = data.sparkSession
    index, values = entries_of(features)
    rows = materialize(data.select(
        F.col(label).cast("double").alias("label"), F.coalesce(F.col(weight).cast("double") if weight else F.lit(1.0), F.lit(0.0)).alias("weight"),
        F.coalesce(F.col(held) if held else F.lit(False), F.lit(False)).alias("held"), index.alias("indices"), values.alias("values")
    ).where("label is not null"), "boost-rows")
    n, entries, watched = rows.agg(F.count("*"), F.sum(F.size("indices")), F.count_if("held")).first()
    if not n:
        raise ValueError("no labelled rows to fit trees on")
    if params.early_stopping_rounds and not watched:
        raise ValueError("early stopping needs validation rows")
    offsets, cuts = _bins(rows.where("not held"), params.max_bin)
    tasks = max(1, min(-(-(entries or 0) // ENTRIES_PER_TASK), n, spark.sparkContext.defaultParallelism))
    folder, shared = shared_path(spark, "boost"), spark.sparkContext.broadcast((offsets, cuts))  # at most max_bin per feature

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = _Store(folder)
        team = _Team(store)
        off, edge = shared.value
        found = _boost(team, _Rows(batches, off, edge), off, edge, params, store)
        if team.rank == 0:
            text = json.dumps({"trees": [t.rows() for t in found["trees"]], "aucs": found["aucs"], "best": found["best"]})
            yield pa.record_batch([pa.array([base64.b64encode(text.encode()).decode()])], names=["model"])

    # ids from the written table, so that a row keeps its draw wherever it is fitted
    dealt = rows.withColumn("row", F.monotonically_increasing_id()).repartition(tasks)
    (model,) = dealt.mapInArrow(run, "model string", barrier=True).collect()  # one model: at most n_estimators trees
    shared.destroy()
    found = json.loads(base64.b64decode(model["model"]))
    return found | {"trees": [Tree.of(t) for t in found["trees"]]}


def margins(trees: list[Tree], features: str | Column) -> Column:
    """Sum of the trees' values for every row, in Arrow batches."""
    used = sorted({int(f) for t in trees for f in t.feature if f >= 0})
    column_of = {f: k for k, f in enumerate(used)}
    lookup = np.full((used[-1] + 2) if used else 1, -1, np.int64)
    lookup[used] = np.arange(len(used))

    @F.arrow_udf("double")
    def score(index: pa.Array, value: pa.Array) -> pa.Array:
        ends = index.offsets.to_numpy()
        feature, amount = index.values.to_numpy(zero_copy_only=False), value.values.to_numpy(zero_copy_only=False)
        shift = value.offsets.to_numpy()[0] - ends[0]
        out, step = np.zeros(len(index)), max(1, SLICE_CELLS // max(1, len(used)))
        for a in range(0, len(index), step):
            b = min(a + step, len(index))
            x = np.full((b - a, max(1, len(used))), np.nan)
            f, v = feature[ends[a]:ends[b]], amount[ends[a] + shift:ends[b] + shift]
            row = np.repeat(np.arange(b - a), np.diff(ends[a:b + 1]))
            at = lookup[np.minimum(f, len(lookup) - 1)]
            hit = (at >= 0) & (v != 0)
            x[row[hit], at[hit]] = v[hit]
            for tree in trees:
                out[a:b] += tree.leaves(x, column_of)
        return pa.array(out)

    index, values = entries_of(features)
    return score(F.coalesce(index, F.array().cast("array<int>")), F.coalesce(values, F.array().cast("array<double>")))


class BoostedTrees(Estimator):
    """Estimator over ``features`` and ``label`` (and ``weight``); rows whose ``held``
    column is true are the validation part."""

    def __init__(self, params: BoostParams = BoostParams(), featuresCol: str = "features", labelCol: str = "label",
                 weightCol: str | None = None, heldCol: str | None = None):
        super().__init__()
        self.boost, self.featuresCol, self.labelCol, self.weightCol, self.heldCol = params, featuresCol, labelCol, weightCol, heldCol

    def _fit(self, df: DataFrame) -> "BoostedTreesModel":
        found = fit_trees(df, self.boost, self.featuresCol, self.labelCol, self.weightCol, self.heldCol)
        return BoostedTreesModel(found["trees"][:found["best"]], self.featuresCol, grown=len(found["trees"]), aucs=found["aucs"],
                                 settings=asdict(self.boost))


class BoostedTreesModel(Model, MLWritable, MLReadable):
    """Adds ``probability`` (of class 0 and 1) and ``prediction``; ``grown`` counts
    the trees grown before the best one was known, ``aucs`` their validation AUC."""

    def __init__(self, trees=None, featuresCol: str = "features", grown: int = 0, aucs=(), settings=None):
        super().__init__()
        self.trees, self.featuresCol, self.grown, self.aucs, self.settings = list(trees or []), featuresCol, grown, list(aucs), settings or {}

    @property
    def getNumTrees(self) -> int:
        return len(self.trees)

    def _transform(self, df: DataFrame) -> DataFrame:
        p = 1 / (1 + F.exp(-margins(self.trees, self.featuresCol)))
        out = df.withColumn("__p", p)
        return (out.withColumn("probability", array_to_vector(F.array(1 - F.col("__p"), F.col("__p"))))
                .withColumn("prediction", (F.col("__p") > 0.5).cast("double")).drop("__p"))

    def write(self) -> "BoostedTreesWriter":
        return BoostedTreesWriter(self)

    @classmethod
    def read(cls) -> "BoostedTreesReader":
        return BoostedTreesReader(cls)


class BoostedTreesWriter(MLWriter):
    """Saves the settings and a table of nodes."""

    def __init__(self, instance: BoostedTreesModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        m = self.instance
        DefaultParamsWriter.saveMetadata(m, path, self.sparkSession, extraMetadata={
            "featuresCol": m.featuresCol, "grown": m.grown, "aucs": m.aucs, "settings": m.settings, "trees": len(m.trees)})
        nodes = [(t, j, *row) for t, tree in enumerate(m.trees) for j, row in enumerate(tree.rows())]
        self.sparkSession.createDataFrame(
            nodes, "tree int, node int, feature long, threshold double, missing_left boolean, left long, value double"
        ).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")


class BoostedTreesReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> BoostedTreesModel:
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        rows: list[list] = [[] for _ in range(meta["trees"])]
        for r in self.sparkSession.read.parquet(f"{path}/nodes").orderBy("tree", "node").collect():  # one model's nodes
            rows[r["tree"]].append(tuple(r)[2:])
        found = self.cls([Tree.of(x) for x in rows], meta["featuresCol"], meta["grown"], meta["aucs"], meta["settings"])
        found._resetUid(meta["uid"])
        return found
