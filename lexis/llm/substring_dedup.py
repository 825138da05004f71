"""Exact substring deduplication behind a count-min prefilter.

A window is ``size`` consecutive words of one document.  A word is removed when
a window that covers it has a word sequence that also starts anywhere else, in
the same document or another; windows are judged on the input.

1. *Sketch.*  Every task counts its windows in count-min cells and ships, per
   shard of the cell space, the occupied cells (4 bytes each).  Shards merge
   the partitions' sketches; a merged count never undercounts, so a window whose
   cell holds one start in all is certainly unique.  The sketch is one row of
   2^32 cells per shard kept sparsely, and shards grow with the corpus (about
   ``SHARD_BYTES`` of text each), so it overestimates 0.2 % of windows at every
   size and has no fixed width to outgrow.
2. *Exact.*  Only windows estimated as repeated are grouped, by 96 bits of
   hash.  Nothing is lost: step 1 only drops windows that occur once.

Skew: before a window is shipped it is combined within its task's buffer.  A
sequence that starts twice there is known to repeat: its cell goes out once and
its places go straight to their documents as runs.  So a passage in a third of
all documents sends one entry per buffer, not one per document.

Each step's answers are packed by the documents' homes (hash ranges of a row key
made of doc_id and text), gathered there to one row per document, and joined to
the texts by the key; both joins use the same exchange of the texts.

Defined cases: null text has no words; identical rows (same doc_id and text)
are separate documents, so all their windows repeat; rows may have a null
doc_id; texts with fewer than ``size`` words lose nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexis.llm.words import U64, chain, column, inside, text_slices

SHARD_BYTES = 48_000_000
BUFFER = 1_000_000
LOW = U64(0xFFFFFFFF)
_ROW = "__row"
_ASK = ("__shard int, rids binary, counts binary, first binary, second binary, places binary, "
        "heavy_first binary, heavy_second binary, known_rids binary, known_counts binary, known binary")
_ANSWER = "__home int, shard int, rids binary, counts binary, items binary"
_HINTS = f"{_ROW} long, __shards binary, __cells binary, __runs binary"


def _to_runs(owner: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of consecutive places of each owner (sorted by owner, place): the
    owner of every run, and the run as ``from | to << 32``."""
    if not len(places):
        return owner, np.empty(0, np.uint64)
    cut = np.append(True, (np.diff(places.astype(np.int64)) != 1) | (owner[1:] != owner[:-1]))
    last = np.append(cut[1:], True)
    return owner[cut], places[cut].astype(np.uint64) | ((places[last].astype(np.uint64) + U64(1)) << U64(32))


def _run_bounds(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint32).reshape(-1, 2).astype(np.int64)


def _by_shard(at: np.ndarray, shard: np.ndarray) -> dict[int, np.ndarray]:
    """The positions of each shard that occurs, in their order."""
    if not len(at):
        return {}
    order = np.argsort(shard, kind="stable")
    told = shard[order]
    cuts = np.flatnonzero(told[1:] != told[:-1]) + 1
    return dict(zip(told[np.append(0, cuts)].tolist(), np.split(at[order], cuts)))


class _Buffer:
    """Windows of some documents, combined and dealt to shards on ``flush``.

    ``exact``: keep both hashes and positions (step 2); else 32-bit cells."""

    def __init__(self, shards: int, exact: bool):
        self.shards, self.exact = shards, exact
        self.rows: list = []
        self.size = 0

    def add(self, row: int, first: np.ndarray, second: np.ndarray, places: np.ndarray) -> None:
        if len(first):
            self.rows.append((row, first, second, places))
            self.size += len(first)

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.rows:
            return
        rids = np.array([r[0] for r in self.rows], np.int64)
        doc = np.repeat(np.arange(len(rids)), [len(r[1]) for r in self.rows])
        first, second, places = (np.concatenate([r[k] for r in self.rows]) for k in (1, 2, 3))
        self.rows, self.size = [], 0
        if self.exact:
            shard = ((first >> U64(33)) % U64(self.shards)).astype(np.int32)
            order = np.lexsort((second, first))
            a, b = first[order], second[order]
            same = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
        else:
            shard = ((first >> U64(32)) % U64(self.shards)).astype(np.int32)
            cell = (shard.astype(np.uint64) << U64(32)) | (first & LOW)
            order = np.argsort(cell, kind="stable")
            a = cell[order]
            same = a[1:] == a[:-1]
        again = np.zeros(len(order), bool)  # equals a neighbour in sort order
        again[1:] |= same
        again[:-1] |= same
        head = np.ones(len(order), bool)
        head[1:] &= ~same
        heavy, repeated = order[again & head], np.zeros(len(order), bool)
        repeated[order] = again
        known_home = (rids.view(np.uint64) % U64(self.shards)).astype(np.int32)
        alone, told = np.flatnonzero(~repeated), np.flatnonzero(repeated)
        asks = _by_shard(alone, shard[alone])
        strongs = _by_shard(heavy, shard[heavy])
        mines = _by_shard(told, known_home[doc[told]])
        none = np.empty(0, np.int64)
        for s in sorted({*asks, *strongs, *mines}):
            ask, strong, mine = (part.get(s, none) for part in (asks, strongs, mines))
            owners, counts = np.unique(doc[ask], return_counts=True)
            run_docs, runs = _to_runs(doc[mine], places[mine])
            known_docs, run_counts = np.unique(run_docs, return_counts=True)
            pack = (lambda at: first[at]) if self.exact else (lambda at: (first[at] & LOW).astype(np.uint32))
            yield pa.record_batch({k: [v] for k, v in {
                "__shard": s, "rids": rids[owners].tobytes(), "counts": counts.astype(np.uint32).tobytes(),
                "first": pack(ask).tobytes(), "second": second[ask].tobytes() if self.exact else b"",
                "places": places[ask].astype(np.uint32).tobytes() if self.exact else b"",
                "heavy_first": pack(strong).tobytes(), "heavy_second": second[strong].tobytes() if self.exact else b"",
                "known_rids": rids[known_docs].tobytes(),
                "known_counts": run_counts.astype(np.uint32).tobytes(), "known": runs.tobytes()}.items()},
                schema=pa.schema([(n, pa.int32() if n == "__shard" else pa.binary()) for n in
                                  ("__shard", "rids", "counts", "first", "second", "places", "heavy_first",
                                   "heavy_second", "known_rids", "known_counts", "known")]))


def _windows(words, size: int, second: bool):
    """Per document of a slice: hashes (and second hashes) of its windows."""
    first = chain(words.hashes(0), size)
    other = (chain(words.hashes(1), size) >> U64(32)).astype(np.uint32) if second else first
    at, _ = inside(words.counts, size)
    ends = np.cumsum(np.maximum(words.counts - size + 1, 0))
    first, other = (first[at], other[at]) if len(at) else (first[:0], other[:0])
    for d, n in enumerate(np.maximum(words.counts - size + 1, 0)):
        yield first[ends[d] - n:ends[d]], other[ends[d] - n:ends[d]]


def _ask_sketch(size: int, shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buffer = _Buffer(shards, exact=False)
        for batch in batches:
            rows = column(batch, _ROW).to_numpy()
            for a, _, words in text_slices(batch):
                for d, (first, _) in enumerate(_windows(words, size, False)):
                    buffer.add(rows[a + d], first, first[:0], np.arange(len(first)))
                if buffer.size >= BUFFER:
                    yield from buffer.flush()
        yield from buffer.flush()
    return run


def _ask_exact(size: int, shards: int):
    """For windows that the sketch estimates as repeated."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buffer = _Buffer(shards, exact=True)
        for batch in batches:
            rows = column(batch, _ROW).to_numpy()
            owners, cells, runs = (column(batch, n) for n in ("__shards", "__cells", "__runs"))
            for a, _, words in text_slices(batch):
                for d, (first, second) in enumerate(_windows(words, size, True)):
                    cell = (((first >> U64(32)) % U64(shards)) << U64(32)) | (first & LOW)
                    shard, count = np.frombuffer(owners[a + d].as_py(), np.uint32).reshape(-1, 2).T
                    flagged = np.repeat(shard.astype(np.uint64) << U64(32), count) | np.frombuffer(cells[a + d].as_py(), np.uint32)
                    picked = _among(cell, np.sort(flagged))
                    for start, end in _run_bounds(runs[a + d].as_py()).tolist():
                        picked[start:end] = True
                    at = np.flatnonzero(picked)
                    buffer.add(rows[a + d], first[at], second[at], at)
                if buffer.size >= BUFFER:
                    yield from buffer.flush()
        yield from buffer.flush()
    return run


def _arrays(table: pa.Table, name: str, kind) -> list[np.ndarray]:
    return [np.frombuffer(x, kind) for x in table.column(name).to_pylist()]


def _owners(table: pa.Table, rids: str, counts: str) -> np.ndarray:
    """The row key of every item of packed rows, in order."""
    return np.repeat(np.concatenate(_arrays(table, rids, np.int64)), np.concatenate(_arrays(table, counts, np.uint32)))


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in the sorted ``known``, a slice at a time."""
    out = np.zeros(len(values), bool)
    for a in range(0, len(values) if len(known) else 0, BUFFER):
        part = values[a:a + BUFFER]
        out[a:a + BUFFER] = known[np.minimum(np.searchsorted(known, part), len(known) - 1)] == part
    return out


def _homeward(homes: int, answers: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.Table:
    """Packs ``(shard, row key of each item, items)`` by the home of the row key:
    cells of the shard, or runs with shard -1."""
    rows = []
    for shard, rid, items in answers:
        home = (rid.view(np.uint64) % U64(homes)).astype(np.int64)
        order = np.lexsort((rid, home))
        home, rid, items = home[order], rid[order], items[order]
        for h in np.unique(home).tolist():
            a, b = np.searchsorted(home, [h, h + 1])
            names, counts = np.unique(rid[a:b], return_counts=True)
            rows.append((h, shard, names.tobytes(), counts.astype(np.uint32).tobytes(), items[a:b].tobytes()))
    columns = list(zip(*rows)) or [()] * 5
    kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["__home", "shard", "rids", "counts", "items"])


def _known(table: pa.Table):
    return -1, _owners(table, "known_rids", "known_counts"), np.concatenate(_arrays(table, "known", np.uint64))


def _merge_sketch(homes: int):
    """Adds up the partitions' sketches of one shard; answers the asked cells
    with more than one start."""
    def run(table: pa.Table) -> pa.Table:
        shard = table.column("__shard")[0].as_py()
        asked = np.concatenate(_arrays(table, "first", np.uint32))
        heavy = np.concatenate(_arrays(table, "heavy_first", np.uint32))
        cells = np.sort(np.concatenate([asked, heavy, heavy]))
        full = cells[1:][cells[1:] == cells[:-1]]
        flagged = np.flatnonzero(_among(asked, full))
        return _homeward(homes, [_known(table), (shard, _owners(table, "rids", "counts")[flagged], asked[flagged])])
    return run


def _merge_exact(homes: int):
    """Groups one shard's windows by both hashes; answers the places of those
    that occur more than once."""
    def run(table: pa.Table) -> pa.Table:
        first, second, places = (np.concatenate(_arrays(table, n, k)) for n, k in
                                 (("first", np.uint64), ("second", np.uint32), ("places", np.uint32)))
        strong_first = np.concatenate(_arrays(table, "heavy_first", np.uint64))
        strong_second = np.concatenate(_arrays(table, "heavy_second", np.uint32))
        a, b = np.concatenate([first, strong_first, strong_first]), np.concatenate([second, strong_second, strong_second])
        order = np.lexsort((b, a))
        same = (a[order][1:] == a[order][:-1]) & (b[order][1:] == b[order][:-1])
        again = np.zeros(len(a), bool)
        again[order[1:]] |= same
        again[order[:-1]] |= same
        flagged = np.flatnonzero(again[:len(first)])
        owner, places = _owners(table, "rids", "counts")[flagged], places[flagged]
        order = np.lexsort((places, owner))
        return _homeward(homes, [_known(table), (-1, *_to_runs(owner[order], places[order]))])
    return run


def _gather(table: pa.Table) -> pa.Table:
    """One row per row key of a home: its flagged cells and its runs."""
    shard = table.column("shard").to_numpy()
    order = np.argsort(shard, kind="stable")
    table, shard = table.take(pa.array(order)), shard[order]
    rid = _owners(table, "rids", "counts")
    names = np.unique(rid)
    split = int(np.searchsorted(shard, 0))  # rows of runs come first
    sizes = [int(np.frombuffer(c, np.uint32).sum()) for c in table.column("counts").to_pylist()]
    cell_from = sum(sizes[:split])
    packed = {}
    for name, part, rows, kind in (("__runs", rid[:cell_from], table.slice(0, split), np.uint64),
                                   ("__cells", rid[cell_from:], table.slice(split), np.uint32)):
        items = np.concatenate([np.empty(0, kind), *_arrays(rows, "items", kind)])
        by_row = np.argsort(part, kind="stable")  # within a row: by shard
        part, items = part[by_row], items[by_row]
        cuts = np.searchsorted(part, names, "left").tolist(), np.searchsorted(part, names, "right").tolist()
        packed[name] = [items[a:b].tobytes() for a, b in zip(*cuts)]
        if name == "__cells":
            own = np.repeat(shard[split:], sizes[split:])[by_row].astype(np.uint32)
            packed["__shards"] = [np.stack(np.unique(own[a:b], return_counts=True), axis=1).astype(np.uint32).tobytes() for a, b in zip(*cuts)]
    return pa.table([pa.array(names, pa.int64()), *(pa.array(packed[n], pa.binary()) for n in ("__shards", "__cells", "__runs"))],
                    names=[_ROW, "__shards", "__cells", "__runs"])


def _cut(size: int, names: list[str]):
    """Kept words joined by one space, and the numbers of words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hints = column(batch, "__runs")
            for a, b, words in text_slices(batch):
                raw = words.data.tobytes()
                kept, totals, removed = [], words.counts, []
                for d in range(b - a):
                    hint = hints[a + d].as_py()
                    lo, hi = words.first[d], words.first[d + 1]
                    if not hint:
                        kept.append(b" ".join(raw[words.bounds[d]:words.bounds[d + 1]].split()))
                        removed.append(0)
                        continue
                    cover = np.zeros(hi - lo + 1, np.int64)
                    runs = _run_bounds(hint)
                    np.add.at(cover, runs[:, 0], 1)
                    np.add.at(cover, runs[:, 1] - 1 + size, -1)
                    stay = np.cumsum(cover)[:-1] == 0
                    removed.append(int((~stay).sum()))
                    kept.append(b" ".join([raw[s:e] for s, e in zip(words.starts[lo:hi][stay].tolist(), words.ends[lo:hi][stay].tolist())]))
                part = {n: column(batch, n).slice(a, b - a) for n in names}
                yield pa.record_batch({**part, "n_words": pa.array(totals, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
                                       "kept_text": pa.array(kept, pa.binary()).cast(pa.string())})
    return run


def dedup_substrings(docs: DataFrame, window: int = 50) -> DataFrame:
    """Every row and column of ``docs(doc_id, text, ...)`` with ``n_words``,
    ``n_removed`` and ``kept_text`` (the kept words joined by one space)."""
    names = [n for n in docs.columns if n not in ("n_words", "n_removed", "kept_text")]
    docs = docs.select(*names)
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = int(total // SHARD_BYTES) + 1
    homes = 4 * shards
    keyed = docs.withColumn(_ROW, F.xxhash64("doc_id", "text"))

    def answers(asked: DataFrame, merge) -> DataFrame:
        packed = asked.groupBy("__shard").applyInArrow(merge(homes), _ANSWER)
        return packed.groupBy("__home").applyInArrow(_gather, _HINTS)

    estimated = answers(keyed.select(_ROW, "text").mapInArrow(_ask_sketch(window, shards), _ASK), _merge_sketch)
    repeated = answers(keyed.join(estimated, _ROW).mapInArrow(_ask_exact(window, shards), _ASK), _merge_exact)
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join(f"`{n}` {kinds[n]}" for n in names) + ", n_words long, n_removed long, kept_text string"
    return keyed.join(repeated.select(_ROW, "__runs"), _ROW, "left").mapInArrow(_cut(window, names), schema)
