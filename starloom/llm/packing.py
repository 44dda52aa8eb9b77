"""Vector bin packing of token sequences under three limits at once.

Every example asks for tokens, one segment and some loss-bearing tokens.  The open
sequence takes, among the waiting examples that fit all its remaining room, the one with
the largest dot product of demand and room.  When none fits, the one with the largest
dot product is cut so that the room is used up, and its rest waits on.  Stretches that
fill a sequence by themselves never wait.

Each task packs the rows of its own partition in one pass with a bounded number of
waiting examples: nothing is shuffled, and a partition leaves at most one sequence with
room.  Cuts and sequence numbers depend only on the rows and their order in the partition.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The end-of-text token of the 50k byte-level vocabulary, whose string in a
#: text the tokenizer turns into that one id.
END_TOKEN, END_TOKEN_ID = "<|endoftext|>", 50256

WAITING = 256
ROWS_OUT = 4096
_PARTITION_SHIFT = 33

Example = tuple[np.ndarray, np.ndarray | None]


@dataclass(frozen=True)
class Limits:
    tokens: int = 1024
    segments: int = 1024
    loss_tokens: int = 1024


@dataclass
class _Piece:
    key: object
    ids: np.ndarray
    loss: np.ndarray | None
    start: int
    total: int

    def loss_sum(self) -> int:
        return len(self.ids) if self.loss is None else int(self.loss.sum())

    def prefix(self, tokens: int, loss_tokens: int) -> int:
        """The longest prefix within both limits."""
        if self.loss is None:
            return min(tokens, loss_tokens, len(self.ids))
        return min(
            tokens, int(np.searchsorted(np.cumsum(self.loss), loss_tokens, side="right"))
        )

    def cut(self, n: int) -> tuple[_Piece, _Piece]:
        loss = (None, None) if self.loss is None else (self.loss[:n], self.loss[n:])
        return (
            _Piece(self.key, self.ids[:n], loss[0], self.start, self.total),
            _Piece(self.key, self.ids[n:], loss[1], self.start + n, self.total),
        )


class Packer:
    """Packs a stream of examples; ``done`` holds finished sequences until they are taken."""

    def __init__(self, limits: Limits, waiting: int = WAITING):
        if min(limits.tokens, limits.segments, limits.loss_tokens) < 1:
            raise ValueError("every limit must be at least 1")
        self.limits = limits
        self.caps = np.array([limits.tokens, limits.segments, limits.loss_tokens], float)
        self.pieces: list[_Piece | None] = [None] * waiting
        # A free place asks for more than any sequence has.
        self.demand = np.full((waiting, 3), np.inf)
        self.share = np.zeros((waiting, 3))
        self.free = list(range(waiting - 1, -1, -1))
        self.done: list[list[_Piece]] = []
        #: A sequence with room left when no example was waiting any more.
        self.begun: tuple[np.ndarray, list[_Piece]] | None = None

    def add(self, key: object, ids: np.ndarray, loss: np.ndarray | None) -> None:
        piece = _Piece(key, ids, loss, 0, len(ids))
        while len(piece.ids) >= self.limits.tokens:
            n = piece.prefix(self.limits.tokens, self.limits.loss_tokens)
            if n < self.limits.tokens:
                break
            full, piece = piece.cut(n)
            self.done.append([full])
        while len(piece.ids):
            n = piece.prefix(self.limits.tokens, self.limits.loss_tokens)
            head, piece = piece.cut(n) if n < len(piece.ids) else (piece, piece.cut(n)[1])
            self._wait(head)

    def _wait(self, piece: _Piece) -> None:
        if not self.free:
            self._fill()
        place = self.free.pop()
        self.pieces[place] = piece
        self.demand[place] = (len(piece.ids), 1, piece.loss_sum())
        self.share[place] = self.demand[place] / self.caps

    def _take(self, place: int) -> _Piece:
        piece, self.pieces[place] = self.pieces[place], None
        self.demand[place], self.share[place] = np.inf, 0
        self.free.append(place)
        return piece

    def _fill(self) -> None:
        """Fill one sequence from the waiting examples, and close it once it is full."""
        room, sequence = self.begun or (self.caps.copy(), [])
        self.begun = None
        while room.min() > 0 or (room[0] > 0 and room[1] > 0):
            if len(self.free) == len(self.pieces):
                # Many short examples: it goes on with those that come next.
                self.begun = room, sequence
                return
            worth = self.share @ (room / self.caps)
            fits = (self.demand <= room).all(axis=1)
            if fits.any():
                piece = self._take(int(np.argmax(np.where(fits, worth, -1.0))))
            else:
                held = np.isfinite(self.demand[:, 0])
                place = int(np.argmax(np.where(held, worth, -1.0)))
                n = self.pieces[place].prefix(int(room[0]), int(room[2]))
                if n == 0:
                    break
                piece, rest = self._take(place).cut(n)
                self._wait(rest)
            sequence.append(piece)
            room -= (len(piece.ids), 1, piece.loss_sum())
        self.done.append(sequence)

    def finish(self) -> None:
        while len(self.free) < len(self.pieces):
            self._fill()
        if self.begun:
            self.done.append(self.begun[1])
            self.begun = None


def _batch(sequences: list[tuple[int, list[_Piece]]], key_type: pa.DataType, with_ids: bool):
    rows = [
        (piece, number, k, offset)
        for number, pieces in sequences
        for k, (piece, offset) in enumerate(
            zip(pieces, np.cumsum([0, *(len(p.ids) for p in pieces)])[:-1].tolist())
        )
    ]
    lengths = np.array([len(r[0].ids) for r in rows], dtype=np.int64)
    columns = [
        pa.array([r[0].key for r in rows], key_type),
        pa.array([r[0].start for r in rows], pa.int64()),
        pa.array(lengths),
        pa.array(
            [zlib.crc32(np.ascontiguousarray(r[0].ids, "<u4")) for r in rows], pa.int64()
        ),
        pa.array([r[0].total for r in rows], pa.int64()),
        pa.array([r[0].loss_sum() for r in rows], pa.int64()),
        pa.array([r[1] for r in rows], pa.int64()),
        pa.array([r[2] for r in rows], pa.int32()),
        pa.array([r[3] for r in rows], pa.int64()),
    ]
    if with_ids:
        ids = np.concatenate([r[0].ids for r in rows]) if rows else np.zeros(0)
        at = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
        columns.append(pa.ListArray.from_arrays(pa.array(at), pa.array(ids.astype(np.int32))))
    return columns


OUTPUT = (
    "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, loss_tokens bigint, "
    "sequence_id bigint, segment int, offset bigint"
)
_NAMES = [part.split()[0] for part in OUTPUT.split(", ")]


def pack(
    examples: DataFrame,
    key: str,
    columns: list[str],
    encode: Callable[[], Callable[[pa.RecordBatch], Iterator[Example]]],
    limits: Limits = Limits(),
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: the key, its place in its example and in its sequence.

    ``encode()`` is called once per task and returns a function that gives, for each row
    of a batch of ``columns``, its token ids (uint32) and which of them bear loss (None:
    all).  An example without tokens yields no piece.  Null and repeated keys are kept as
    they are, each row being an example of its own.  Other columns of ``examples`` are not
    read.  ``with_ids`` adds the pieces' ids.  An empty table gives no rows.
    """
    if key in [*_NAMES, "ids"]:
        raise ValueError(f"the key may not be called {key}")
    kind = examples.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, {OUTPUT}" + ", ids array<int>" * with_ids
    narrow = examples.select(
        F.col(f"`{key}`").alias("key"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows_of = encode()
        packer, key_type = Packer(limits), pa.null()
        number = TaskContext.get().partitionId() << _PARTITION_SHIFT

        def ready(least: int):
            nonlocal number
            if sum(map(len, packer.done)) >= least and packer.done:
                sequences = list(enumerate(packer.done, number))
                number += len(sequences)
                packer.done = []
                yield pa.RecordBatch.from_arrays(
                    _batch(sequences, key_type, with_ids),
                    [key, *_NAMES, *["ids"] * with_ids],
                )

        for batch in batches:
            key_type = batch.schema.field("key").type
            values = batch.column(0).to_pylist()
            given = batch.select(range(1, batch.num_columns)).rename_columns(columns)
            for value, (ids, loss) in zip(values, rows_of(given)):
                packer.add(value, ids, loss)
                yield from ready(ROWS_OUT)
        packer.finish()
        yield from ready(1)

    return narrow.mapInArrow(run, schema)


def text_encoder(ranks_path: str, pattern: str, column: str = "text", end: int = 0):
    """Encodes texts with a byte-level BPE given as ranks, and appends the id ``end``.

    Null is an empty text.  The end-of-text token's string becomes its single id.
    """

    def encode():
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        coder = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=ranks,
            special_tokens={END_TOKEN: END_TOKEN_ID},
        )
        last = np.array([end], np.uint32)

        def rows(batch: pa.RecordBatch) -> Iterator[Example]:
            for text in batch.column(column):
                ids = coder.encode_to_numpy(text.as_py() or "", allowed_special="all")
                yield np.concatenate((ids, last)), None

        return rows

    return encode


def array_encoder(ids: str, loss: str | None = None):
    """Takes examples that are arrays of ids already, with an array of 0/1 loss marks.

    A null array is empty; a null id counts as 0, a null or missing mark as no loss.
    """

    def encode():
        def rows(batch: pa.RecordBatch) -> Iterator[Example]:
            for k in range(batch.num_rows):
                values = [x or 0 for x in batch.column(ids)[k].as_py() or []]
                marks = None
                if loss is not None:
                    given = [bool(x) for x in batch.column(loss)[k].as_py() or []]
                    given += [False] * (len(values) - len(given))
                    marks = np.array(given[: len(values)], dtype=np.int64)
                yield np.array(values, dtype=np.uint32), marks

        return rows

    return encode
