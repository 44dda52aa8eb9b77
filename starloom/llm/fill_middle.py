"""Fill-in-middle transformation by secondary sort.

A text is cut into units (a run of letters A to Z in either case, or any other single
character), and at two seeded units into prefix, middle and suffix.  What the transformed
text consists of is emitted as chunks of bounded size, each with its document and its place
in the output.  Chunks are dealt by document and sorted by place within their partition
(the DataFrame form of repartitionAndSortWithinPartitions, which spills), so that a task
streams each output through an incremental digest without ever holding it.  On its way the
stream is read back: sentinels are looked for in the output alone, and the parts found are
sorted again, within the same partition, into the order of the original text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm import textops as t

#: Bytes of a chunk, and of the chunks that a task gathers before it hands them on.
CHUNK_BYTES = 1 << 16
BATCH_BYTES = 1 << 22

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: The order of the parts in each form's output, and in the text.
OUTPUT_ORDER = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
TEXT_ORDER = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}
_END = 3

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


@dataclass(frozen=True)
class Rates:
    """Percent of texts left plain above ``moved``, and of the others in form spm."""

    seed: int = 1
    moved: int = 90
    suffix_first: int = 20


# --- units ---------------------------------------------------------------------------


def unit_starts(data: np.ndarray, start: int, end: int) -> np.ndarray:
    """Where units begin in ``data[start:end]`` of a UTF-8 text, from ``start``."""
    own = data[start:end]
    letter = _LETTER[own]
    before = np.empty_like(letter)
    before[1:] = letter[:-1]
    before[:1] = bool(start) and _LETTER[data[start - 1]]
    return np.flatnonzero(((own & 0xC0) != 0x80) & ~(letter & before))


def count_units(data: np.ndarray) -> list[int]:
    """The number of units that begin in each piece of the text."""
    return [len(unit_starts(data, at, at + t.PIECE_BYTES)) for at in range(0, len(data), t.PIECE_BYTES)]


def unit_place(data: np.ndarray, counts: list[int], unit: int) -> int:
    """The byte at which a unit begins; the end of the text for one unit more."""
    for k, n in enumerate(counts):
        if unit < n:
            at = k * t.PIECE_BYTES
            return at + int(unit_starts(data, at, at + t.PIECE_BYTES)[unit])
        unit -= n
    return len(data)


def characters(data: np.ndarray) -> int:
    return sum(
        int(np.count_nonzero((data[at : at + t.PIECE_BYTES] & 0xC0) != 0x80))
        for at in range(0, len(data), t.PIECE_BYTES)
    )


@dataclass
class Cut:
    """How a text is transformed; without a form it stays plain."""

    units: int
    form: str
    parts: list[tuple[bytes, memoryview]]
    prefix_chars: int | None = None
    middle_chars: int | None = None


def cut(key: str, text: memoryview, rates: Rates) -> Cut:
    """Form and output parts (sentinel, bytes) of a text, from its key alone."""
    digest = hashlib.sha256(f"{rates.seed}:{key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k : k + 8], 16) for k in range(0, 32, 8))
    data = np.frombuffer(text, np.uint8)
    counts = count_units(data)
    n = sum(counts)
    whole = bytes(text)
    if not n or h3 % 100 >= rates.moved or any(s in whole for s in TEXT_ORDER):
        return Cut(n, "plain", [(b"", text)])
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = unit_place(data, counts, low), unit_place(data, counts, high)
    form = "spm" if h4 % 100 < rates.suffix_first else "psm"
    own = {PREFIX: text[:a], MIDDLE: text[a:b], SUFFIX: text[b:]}
    parts = [(s, own[s]) for s in OUTPUT_ORDER[form]]
    return Cut(n, form, parts, characters(data[:a]), characters(data[a:b]))


# --- reading an output back ------------------------------------------------------------


class OutputReader:
    """Splits a stream of output bytes at the sentinels that its form calls for.

    The text holds no sentinel, so the first one found is the one looked for; the last two
    bytes are kept back, as a sentinel may go on in the next chunk.
    """

    def __init__(self, form: str):
        self.wanted = list(OUTPUT_ORDER.get(form, ()))
        self.part = 0
        self.kept = b""

    def feed(self, chunk: bytes) -> Iterator[tuple[int, bytes]]:
        held = self.kept + chunk
        while self.wanted:
            at = held.find(self.wanted[0])
            if at < 0:
                break
            if at:
                yield self.part, held[:at]
            held, self.part = held[at + 3 :], TEXT_ORDER[self.wanted.pop(0)]
        back = 2 if self.wanted else 0
        ready, self.kept = held[: len(held) - back], held[max(len(held) - back, 0) :]
        if ready:
            yield self.part, ready

    def rest(self) -> Iterator[tuple[int, bytes]]:
        if self.wanted:
            raise ValueError("the output lacks a sentinel")
        if self.kept:
            yield self.part, self.kept


# --- the operator ----------------------------------------------------------------------


class _Rows:
    """Rows gathered into Arrow batches of bounded size."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.bytes = schema, [], 0

    def add(self, row: tuple, size: int) -> bool:
        self.rows.append(row)
        self.bytes += size + 64
        return self.bytes >= BATCH_BYTES

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [[]] * len(self.schema)
        self.rows, self.bytes = [], 0
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, self.schema)], schema=self.schema
        )


#: The number of a document's row, where a chunk stands, and the chunk; then what the last
#: row of a document says about it.
_ABOUT = [("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64())]
_CHUNKS = pa.schema([("row", pa.int64()), ("place", pa.int64()), ("chunk", pa.binary()), *_ABOUT])
_PARTS = pa.schema(
    [("row", pa.int64()), ("part", pa.int32()), ("place", pa.int64()), ("chunk", pa.binary()), *_ABOUT,
     ("output_sha256", pa.string())]
)
_DONE = pa.schema([("row", pa.int64()), *_ABOUT, ("output_sha256", pa.string()), ("restored_sha256", pa.string())])
_SQL = {pa.int64(): "bigint", pa.int32(): "int", pa.string(): "string", pa.binary(): "binary"}


def _ddl(schema: pa.Schema, kind: str | None = None) -> str:
    own = [f"{f.name} {_SQL[f.type]}" for f in schema]
    return ", ".join([f"doc {kind}", *own] if kind else own)


def output_chunks(
    documents: DataFrame, key: str = "doc_id", text: str = "text", rates: Rates = Rates()
) -> DataFrame:
    """(doc, row, place, chunk, n, form, prefix_chars, middle_chars): the transformed texts
    in chunks; joined by ``place`` (a byte offset) within ``row`` they are the output.

    A null text is empty, a null key counts as empty text in the seed.  Every row is a
    document of its own, also where keys repeat; other columns are not read.  An empty
    text has one empty chunk.
    """
    # A row's number is the same when its task runs again.
    given = documents.select(
        F.col(f"`{key}`").alias("doc"), F.monotonically_increasing_id().alias("row"),
        F.col(f"`{key}`").cast("string").alias("name"), F.col(f"`{text}`").alias("text"),
    )
    doc = given.schema["doc"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            schema = pa.schema([batch.schema.field(0), *_CHUNKS])
            out, keys = _Rows(schema), batch.column(0).to_pylist()
            data, offsets = t.utf8(batch.column(3))
            whole, ends = memoryview(np.ascontiguousarray(data)), offsets.tolist()
            for k, (row, name) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                c = cut(name or "", whole[ends[k] : ends[k + 1]], rates)
                about, place = (c.units, c.form, c.prefix_chars, c.middle_chars), 0
                for sentinel, part in c.parts:
                    for at in range(0, max(len(part), 1), CHUNK_BYTES):
                        chunk = (sentinel if not at else b"") + bytes(part[at : at + CHUNK_BYTES])
                        if out.add((keys[k], row, place, chunk, *about), len(chunk)):
                            yield out.batch()
                        place += len(chunk)
            yield out.batch()

    return given.mapInArrow(run, _ddl(_CHUNKS, doc.simpleString()))


def transformed(
    documents: DataFrame, key: str = "doc_id", text: str = "text", rates: Rates = Rates()
) -> DataFrame:
    """One row per document: key, n, form, prefix_chars, middle_chars, and the digests of
    the output and of the text that was rebuilt from it.  Defined as ``output_chunks``."""
    chunks = output_chunks(documents, key, text, rates)
    kind = documents.schema[key].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Outputs, digested as they stream by and split into the parts of the text."""
        out, now, last = None, None, ()

        def parts(found: Iterator[tuple[int, bytes]]) -> Iterator[tuple]:
            nonlocal seen
            for part, chunk in found:
                yield (None, now, part, seen, chunk, None, None, None, None, None), len(chunk)
                seen += len(chunk)

        def closed() -> Iterator[tuple]:
            yield from parts(reader.rest())
            yield (last[0], now, _END, seen, b"", *last[1], digest.hexdigest()), 0

        seen, reader, digest = 0, None, None
        for batch in batches:
            out = out or _Rows(pa.schema([batch.schema.field(0), *_PARTS]))
            columns = [batch.column(k).to_pylist() for k in range(batch.num_columns)]
            for doc, row, _, chunk, *about in zip(*columns):
                ready = []
                if row != now:
                    if now is not None:
                        ready += closed()
                    now, last, seen = row, (doc, about), 0
                    reader, digest = OutputReader(about[1]), hashlib.sha256()
                digest.update(chunk)
                ready += parts(reader.feed(chunk))
                for one, size in ready:
                    if out.add(one, size):
                        yield out.batch()
        if out:
            for one, size in closed() if now is not None else ():
                out.add(one, size)
            yield out.batch()

    def restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Parts in the order of the text, digested; the last row of each tells the rest."""
        out, digest = None, hashlib.sha256()
        for batch in batches:
            out = out or _Rows(pa.schema([batch.schema.field(0), *_DONE]))
            columns = [batch.column(k).to_pylist() for k in range(batch.num_columns)]
            for doc, row, part, _, chunk, *about in zip(*columns):
                digest.update(chunk)
                if part == _END:
                    if out.add((doc, row, *about, digest.hexdigest()), 200):
                        yield out.batch()
                    digest = hashlib.sha256()
        if out:
            yield out.batch()

    streamed = chunks.repartition("row").sortWithinPartitions("row", "place")
    parts = streamed.mapInArrow(read, _ddl(_PARTS, kind))
    # All rows of a document are in one partition still: this sort needs no shuffle.
    done = parts.sortWithinPartitions("row", "part", "place").mapInArrow(restore, _ddl(_DONE, kind))
    return done.select(
        F.col("doc").alias(key), "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"
    )
