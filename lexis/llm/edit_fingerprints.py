"""Document fingerprints by randomised edit embedding.

A walk reads a text character by character and writes each one once or more: at
output step j the walk goes on to the next character if the random bit that all
texts share for (j, character) says so.  Texts at a small edit distance fall back
into step, so their outputs differ in few places (Hamming distance).  An output is
about twice as long as its text.

One walk in some tens loses its step for good, so ``WALKS`` independent ones are
taken.  Bits are sampled from each output at shared places: ``SLOTS`` slots each
draw from the whole output, whatever its length, the place with the smallest
shared random value.  Such places are the records of a fixed random sequence, so
outputs of similar length mostly agree on them.  A slot's code is a byte made of
its place and the ``CONTEXT`` last characters read there.  The fingerprint is the
string of all codes (hexadecimal), or empty for an empty text.

Likeness of two fingerprints: bands of ``BAND`` neighbouring slots are compared
first; a pair without an equal band is no candidate and gets 0; a candidate is
verified over all slots, as the share of equal codes of the walk that kept step
better, less what chance gives.  Two empty texts have likeness 1, an empty and
another one 0.

``fingerprint_with_next`` puts documents in order by one range shuffle and walks
every partition as a stream: an edited text shares its beginning's walk with the
original.  A partition's last row meets the next partition's first one in a
small second step (two rows per partition), so every text is shuffled once.

The bits repeat every ``PERIOD`` steps of the output and characters fall into
256 classes by hash; codes hold the characters themselves.

Defined cases: null texts count as empty; documents without an id come first;
rows that repeat an id are told apart by a hash of their texts, equal rows follow
each other in any order; the last document's next one is the first, which is the
document itself if it is alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexis.llm.words import column, mix
from lexis.session import materialize

WALKS, SLOTS, BAND, CONTEXT, PERIOD, CHUNK = 2, 64, 2, 4, 256, 1 << 14
U64 = np.uint64
END_OF_PLACES = 1 << 40
FACTORS = np.random.default_rng(43).integers(0, 2**63, CONTEXT + 1, dtype=np.uint64) * U64(2) + U64(1)


def _walk_table(seed: int) -> list[bytes]:
    """Per class the phase after a character that starts in a phase (the number of
    times it is written is the distance to the next bit that is set)."""
    bits = np.random.default_rng(seed).integers(0, 2, (256, PERIOD), dtype=np.uint8)
    bits[:, -1] = 1
    table = []
    for row in bits:
        stop = np.flatnonzero(row)
        table.append(((stop[np.searchsorted(stop, np.arange(PERIOD))] + 1) % PERIOD).astype(np.uint8).tobytes())
    return table


def _places(seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted places and their slots: for each slot the records of its sequence
    (from place p the next record lies at about p / u, u uniform)."""
    rng = np.random.default_rng(seed)
    place, slot = [np.zeros(SLOTS, np.int64)], [np.arange(SLOTS)]
    at = np.zeros(SLOTS)
    while (live := at < END_OF_PLACES).any():
        at = np.where(live, np.floor((at + 1) / np.maximum(rng.random(SLOTS), 1e-9)), at)
        place.append(at[live].astype(np.int64))
        slot.append(np.flatnonzero(live))
    place, slot = np.concatenate(place), np.concatenate(slot)
    order = np.lexsort((slot, place))
    return place[order], slot[order]


_TABLES = [_walk_table(100 + w) for w in range(WALKS)]
_PLACES = [_places(200 + w) for w in range(WALKS)]


class Walk:
    """The state of a text's walks: their phases, places reached and slots' codes."""

    def __init__(self):
        self.phase, self.written, self.next_place = [0] * WALKS, [0] * WALKS, [0] * WALKS
        self.codes = np.zeros((WALKS, SLOTS), np.uint8)
        self.recent = np.zeros(CONTEXT - 1, np.uint64)  # the last characters read

    def fork(self) -> "Walk":
        other = Walk()
        other.phase, other.written, other.next_place = self.phase[:], self.written[:], self.next_place[:]
        other.codes, other.recent = self.codes.copy(), self.recent
        return other

    def feed(self, text: str) -> "Walk":
        for a in range(0, len(text), CHUNK):
            chars = np.frombuffer(text[a:a + CHUNK].encode("utf-32-le", "surrogatepass"), np.uint32)
            classes = ((chars * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8).tobytes()
            context = np.concatenate([self.recent, chars.astype(np.uint64)])
            for w in range(WALKS):
                self._step(w, classes, context)
            self.recent = context[-(CONTEXT - 1):]
        return self

    def _step(self, w: int, classes: bytes, context: np.ndarray) -> None:
        table, s = _TABLES[w], self.phase[w]
        after = np.frombuffer(bytes([s := table[c][s] for c in classes]), np.uint8)
        times = after - np.concatenate([np.array([self.phase[w]], np.uint8), after[:-1]]) - np.uint8(1)  # less one, modulo the period
        ends = self.written[w] + np.cumsum(times, dtype=np.int64) + np.arange(1, len(after) + 1)  # output length after each character
        all_places, all_slots = _PLACES[w]
        last = int(np.searchsorted(all_places, ends[-1]))
        if last > self.next_place[w]:
            place, slot = all_places[self.next_place[w]:last], all_slots[self.next_place[w]:last]
            at = np.searchsorted(ends, place, "right")
            code = place.astype(np.uint64) * FACTORS[CONTEXT]
            for k in range(CONTEXT):
                code += (context[at + k] + U64(1)) * FACTORS[k]
            self.codes[w, slot] = (mix(code) >> U64(56)).astype(np.uint8)  # of equal slots the last place stays
            self.next_place[w] = last
        self.phase[w], self.written[w] = s, int(ends[-1])

    def fingerprint(self) -> str:
        return self.codes.tobytes().hex() if self.written[0] else ""


def fingerprint(text: str | None) -> str:
    return Walk().feed(text or "").fingerprint()


def bands(code: str) -> list[str]:
    """Keys under which a fingerprint's candidates meet: the codes of each band."""
    return [f"{i}:{code[i:i + 2 * BAND]}" for i in range(0, len(code), 2 * BAND)]


def likeness(a: str, b: str) -> float:
    """0 without an equal band, else the larger share of equal codes of a walk,
    corrected for chance."""
    if not a or not b:
        return float(a == b)
    same = np.frombuffer(bytes.fromhex(a), np.uint8) == np.frombuffer(bytes.fromhex(b), np.uint8)
    if not same.reshape(-1, BAND).all(axis=1).any():
        return 0.0
    return max(0.0, (float(same.reshape(WALKS, SLOTS).mean(axis=1).max()) - 1 / 256) / (1 - 1 / 256))


_FIELDS = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_TYPES = ("n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, "
          "part int, kind string, body string")


class _Reader:
    """One document under way: its walk up to the place of the edit, and whole."""

    def __init__(self, text: str):
        self.text, cut = text, len(text) - len(text) // 2
        self.head = Walk().feed(text[:cut])
        self.whole = self.head.fork().feed(text[cut:])
        self.cut = cut

    def edited(self, following: str, following_code: str) -> tuple:
        new = following[:len(self.text) - self.cut]
        code = self.head.fork().feed(new).fingerprint()
        digest = hashlib.sha256((self.text[:self.cut] + new).encode("utf-8", "surrogatepass")).hexdigest()
        own = self.whole.fingerprint()
        return len(self.text), digest, own, code, likeness(own, code), likeness(own, following_code)


def _texts(batch: pa.RecordBatch) -> Iterator[str]:
    for value in column(batch, "text").cast(pa.large_binary()):
        yield "" if not value.is_valid else bytes(value.as_buffer()).decode("utf-8", "replace")


def _stream(names: list[str], id_types: list[pa.DataType]):
    """Rows of an ordered partition with what the next row gives them; the first
    row's text (kind ``first``) and the last row (kind ``open``) go along."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, ready = TaskContext.get().partitionId(), None, []

        def packed(rows):
            ids = [pa.array([r[0][i] for r in rows], t) for i, t in enumerate(id_types)]
            columns = list(zip(*(r[1:] for r in rows)))
            kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int32(), pa.string(), pa.string())
            return pa.record_batch([*ids, *(pa.array(c, t) for c, t in zip(columns, kinds))], names=[*names, *_FIELDS, "part", "kind", "body"])

        nothing = (None,) * len(_FIELDS)
        for batch in batches:
            keys = list(zip(*(column(batch, n).to_pylist() for n in names)))
            for key, text in zip(keys, _texts(batch)):
                reader = _Reader(text)
                if last is None:
                    ready.append((key, *nothing, part, "first", text))
                else:
                    ready.append((last[0], *last[1].edited(text, reader.whole.fingerprint()), part, "row", None))
                last = key, reader
                if len(ready) >= 1024:
                    yield packed(ready)
                    ready = []
        if last is not None:
            ready.append((last[0], *nothing, part, "open", last[1].text))
            yield packed(ready)
    return run


def _close(names: list[str], id_types: list[pa.DataType]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [column(batch, n) for n in names]
            pairs = zip(column(batch, "body").to_pylist(), column(batch, "following").to_pylist())
            rows = [_Reader(own).edited(new, fingerprint(new)) for own, new in pairs]
            kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            columns = list(zip(*rows)) or [()] * len(kinds)
            yield pa.record_batch([*keys, *(pa.array(c, t) for c, t in zip(columns, kinds))], names=[*names, *_FIELDS])
    return run


def _arrow(df: DataFrame, name: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(df.schema[name].dataType)


def fingerprint_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next`` of every row: its fingerprint, that of the text whose
    last half is replaced by the beginning of the next document, and its likeness
    to both."""
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text"))
    rows = rows.withColumns({"__hash": F.xxhash64("text"), "__row": F.monotonically_increasing_id()})
    order: list[Column] = [F.asc_nulls_first("__id"), F.asc("__hash"), F.asc("__row")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("__id", "text")
    id_type, schema = [_arrow(rows, "__id")], f"__id {rows.schema['__id'].dataType.simpleString()}, "
    found = materialize(ordered.mapInArrow(_stream(["__id"], id_type), schema + _TYPES), "edit-fingerprints")
    # two rows per partition: the order of the partitions, then their texts
    firsts = found.filter("kind = 'first'").select("part", F.col("body").alias("following"))
    parts = found.filter("kind = 'first'").select("part").withColumn(
        "next_part", F.coalesce(F.lead("part").over(W.orderBy("part")), F.min("part").over(W.partitionBy())))
    opens = found.filter("kind = 'open'").select("__id", "part", "body").join(parts, "part").join(
        firsts.withColumnRenamed("part", "next_part"), "next_part").select("__id", "body", "following")
    closed = opens.mapInArrow(_close(["__id"], id_type), schema + _TYPES.split(", part")[0])
    return found.filter("kind = 'row'").select("__id", *_FIELDS).unionByName(closed).withColumnRenamed("__id", id_col)
