"""Target-distribution importance resampling over hashed runs of words.

Distinct words of the texts at hand form an Aho-Corasick dictionary in each task.  Each
stands between two delimiters and carries the CRC-32 of its bytes, that of its bytes after
a blank, and its length.  One scan of the text emits the words' payloads in order; the CRC
of a run of words is composed from those of neighbours, without touching the text again.
A run's CRC modulo the number of buckets is its feature.  Features of the raw documents and
of the target texts are counted over all rows; a document's weight is the mean log ratio of
its features, and seeded Gumbel noise turns the highest scores into a draw.

Words are maximal runs of characters other than ``[\\x00-/:-`{-\\x7F]`` after A to Z are
lower-cased.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm import textops as t
from starloom.sources.scratch import Workspace

#: Words of a task's dictionary, and the pieces of text that it learns from.
MOST_WORDS = 1 << 15
LEARN_PIECES = 4

_ASCII_WORD = {*range(0x30, 0x3A), *range(0x61, 0x7B)}
#: Lower-cases A to Z and turns every delimiter into a blank.
_PLAIN = bytes(
    b if b >= 0x80 or b in _ASCII_WORD else b + 32 if 65 <= b <= 90 else 0x20 for b in range(256)
)
_CRC_POLYNOMIAL = 0xEDB88320


# --- CRC-32 of concatenations --------------------------------------------------------


def _through(matrix: list[int], vector: int) -> int:
    """A vector of 32 bits through a bit matrix given by columns."""
    out, k = 0, 0
    while vector:
        if vector & 1:
            out ^= matrix[k]
        vector >>= 1
        k += 1
    return out


@lru_cache(maxsize=None)
def _doubled(power: int) -> tuple[int, ...]:
    """The matrix that appends 2 ** power zero bits to a CRC."""
    if power == 0:
        return (_CRC_POLYNOMIAL, *(1 << k for k in range(31)))
    half = list(_doubled(power - 1))
    return tuple(_through(half, column) for column in half)


@lru_cache(maxsize=4096)
def _shift_tables(length: int) -> np.ndarray:
    """Four tables of 256: what each byte of a CRC becomes ``length`` bytes later."""
    columns = [1 << k for k in range(32)]
    power, bits = 0, 8 * length
    while bits:
        if bits & 1:
            matrix = list(_doubled(power))
            columns = [_through(matrix, c) for c in columns]
        bits >>= 1
        power += 1
    values = np.arange(256)
    tables = np.zeros((4, 256), dtype=np.uint32)
    for byte in range(4):
        for bit in range(8):
            tables[byte][(values >> bit & 1) == 1] ^= np.uint32(columns[8 * byte + bit])
    return tables


def crc_joined(first: np.ndarray, second: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of concatenations, from both parts' CRCs and the second parts' lengths."""
    out = np.zeros(len(first), dtype=np.uint32)
    order = np.argsort(lengths, kind="stable")
    distinct, starts = np.unique(lengths[order], return_index=True)
    for length, rows in zip(distinct.tolist(), np.split(order, starts[1:])):
        tables, own = _shift_tables(length), first[rows]
        shifted = tables[0][own & 0xFF]
        for byte in range(1, 4):
            shifted = shifted ^ tables[byte][own >> np.uint32(8 * byte) & np.uint32(0xFF)]
        out[rows] = shifted ^ second[rows]
    return out


# --- the dictionary ------------------------------------------------------------------


class WordDictionary:
    """Words between blanks, with their payloads, in one automaton.

    It learns the repeated words of a task's first pieces of text and then stays as it is.
    Other words get the same payloads one by one, so that its bounded size decides how fast
    a text is read and nothing else.  Bytes stand for characters (Latin-1), so that
    positions are byte positions.
    """

    def __init__(self) -> None:
        self.automaton = ahocorasick.Automaton()
        self.size = self.pieces = 0
        #: By word number: CRC of the word, CRC of a blank and the word, length with the blank.
        self.payloads = np.zeros((MOST_WORDS, 3), dtype=np.uint32)

    def learn(self, plain: bytes) -> None:
        if self.pieces == LEARN_PIECES or self.size == MOST_WORDS:
            return
        self.pieces += 1
        for word, n in Counter(plain.split()).most_common():
            name = f" {word.decode('latin-1')} "
            if n < 2 or self.size == MOST_WORDS:
                break
            if not self.automaton.exists(name):
                self.payloads[self.size] = _payload(word)
                self.automaton.add_word(name, self.size)
                self.size += 1
        if self.size:
            self.automaton.make_automaton()

    def scan(self, plain: bytes) -> tuple[np.ndarray, np.ndarray]:
        """The payloads of all words in order, and the place after each; ``plain`` begins
        and ends with a blank, and blanks are its only delimiters."""
        solid = np.frombuffer(plain, np.uint8) != 0x20
        edges = np.flatnonzero(solid[1:] != solid[:-1]) + 1
        starts, ends = edges[::2], edges[1::2]
        payloads = np.zeros((len(ends), 3), dtype=np.uint32)
        missing = np.ones(len(ends), dtype=bool)
        if self.size:
            # (place of the closing blank, word number), one after the other.
            emitted = chain.from_iterable(self.automaton.iter(plain.decode("latin-1")))
            found = np.fromiter(emitted, np.int64).reshape(-1, 2)
            at = np.searchsorted(ends, found[:, 0])
            payloads[at] = self.payloads[found[:, 1]]
            missing[at] = False
        rest = np.flatnonzero(missing)
        if len(rest):
            payloads[rest] = [_payload(plain[a:b]) for a, b in zip(starts[rest].tolist(), ends[rest].tolist())]
        return payloads, ends


def _payload(word: bytes) -> tuple[int, int, int]:
    return zlib.crc32(word), zlib.crc32(b" " + word), len(word) + 1


def _pieces(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Byte ranges of bounded size, cut between texts, or at a blank of a longer text."""
    for i, j in t.row_blocks(offsets):
        start, stop = int(offsets[i]), int(offsets[j])
        while stop - start > 2 * t.PIECE_BYTES:
            end = start + t.word_cut(data[start:stop], 0, t.PIECE_BYTES)
            yield start, end
            start = end
        yield start, stop


def word_payloads(
    column: pa.Array, dictionary: WordDictionary
) -> tuple[np.ndarray, np.ndarray]:
    """The payloads of all words of a column of texts, and the number of each text's words."""
    raw, offsets = t.utf8(column)
    # A blank after each text, so that no word reaches from one into the next.
    rows = np.arange(len(offsets))
    spaced = offsets + rows
    own = np.ones(len(raw) + len(offsets) - 1, dtype=bool)
    own[spaced[1:] - 1] = False
    data = np.full(len(own), 0x20, dtype=np.uint8)
    data[own] = np.frombuffer(raw.tobytes().translate(_PLAIN), np.uint8)
    counts = np.zeros(len(offsets) - 1, dtype=np.int64)
    found = []
    for start, end in _pieces(data, spaced):
        plain = b" " + data[start:end].tobytes() + b" "
        dictionary.learn(plain)
        payloads, ends = dictionary.scan(plain)
        found.append(payloads)
        # A word that ends before place p of the piece ends before byte start + p - 1.
        rows = np.searchsorted(spaced, start + ends - 2, "right") - 1
        counts += np.bincount(rows, minlength=len(counts))
    payloads = np.concatenate(found) if found else np.zeros((0, 3), np.uint32)
    return payloads, counts


def text_features(
    column: pa.Array, dictionary: WordDictionary, longest: int, buckets: int
) -> Iterator[tuple[int, np.ndarray]]:
    """Of each text, the number of words and the buckets of all its runs of words."""
    payloads, counts = word_payloads(column, dictionary)
    row = np.repeat(np.arange(len(counts)), counts)
    crc = payloads[:, 0]
    runs, owners = [crc], [row]
    for size in range(2, longest + 1):
        last = payloads[size - 1 :]
        crc = crc_joined(crc[: len(last)], last[:, 1], last[:, 2]) if len(last) else crc[:0]
        whole = row[: len(last)] == row[size - 1 :]
        runs.append(crc[whole])
        owners.append(row[: len(last)][whole])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable") if longest > 1 else slice(None)
    bucket = (np.concatenate(runs) % np.uint32(buckets))[order]
    ends = np.cumsum(np.bincount(owner, minlength=len(counts)))
    for n, start, end in zip(counts.tolist(), [0, *ends.tolist()], ends.tolist()):
        yield n, bucket[start:end]


# --- the operator --------------------------------------------------------------------


@dataclass(frozen=True)
class Draw:
    """Longest run of words, number of buckets, share drawn, and who may be drawn."""

    longest: int = 1
    buckets: int = 10_000
    percent: int = 10
    least_words: int = 20
    seed: int = 2024


def gains(raw: dict[int, int], target: dict[int, int], buckets: int) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's smoothed shares, rounded down."""
    all_raw, all_target = float(sum(raw.values()) + buckets), float(sum(target.values()) + buckets)
    return np.array(
        [
            math.floor(
                1000 * math.log(
                    float(target.get(b, 0) + 1) * all_raw / (float(raw.get(b, 0) + 1) * all_target)
                )
            )
            for b in range(buckets)
        ],
        dtype=np.int64,
    )


class ImportanceDraw:
    """Documents scored by how much they resemble the target texts, and a draw of them.

    Null and blank texts have no words, no features and the weight 0.  A null key counts
    as empty text where the noise is drawn, and comes last among ties.  Repeated rows are
    documents of their own.  Other columns are not read.  Without target texts, or without
    documents, the smoothed shares still hold.
    """

    def __init__(
        self, documents: DataFrame, targets: DataFrame, key: str = "doc_id", text: str = "text",
        target_text: str = "text", draw: Draw = Draw(),
    ):
        if draw.longest < 1 or draw.buckets < 1:
            raise ValueError("runs have a word at least, and there is a bucket at least")
        self.documents, self.key, self.text, self.draw = documents, key, text, draw
        self.work = Workspace(documents.sparkSession, "importance")
        kind = "<u2" if draw.buckets <= 1 << 16 else "<u4"
        given = documents.select(F.col(f"`{key}`").alias("doc"), F.col(f"`{text}`").alias("text"))
        self.features = self.work.stage(self._features(given, kind), "features")
        wanted = targets.select(F.lit(None).cast("int").alias("doc"), F.col(f"`{target_text}`").alias("text"))
        self.gains = gains(
            self._counts(self.features, kind), self._counts(self._features(wanted, kind), kind), draw.buckets
        )
        self.scored = self.work.stage(self._scored(kind), "scored")
        self.work.drop("features")

    def _features(self, given: DataFrame, kind: str) -> DataFrame:
        longest, buckets = self.draw.longest, self.draw.buckets

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            dictionary = WordDictionary()
            for batch in batches:
                found = list(text_features(batch.column(1), dictionary, longest, buckets))
                marks = [bucket.astype(kind).tobytes() for _, bucket in found]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([n for n, _ in found], pa.int64()), pa.array(marks, pa.large_binary())],
                    ["doc", "n_words", "buckets"],
                )

        return given.mapInArrow(
            run, f"doc {given.schema['doc'].dataType.simpleString()}, n_words bigint, buckets binary"
        )

    def _counts(self, features: DataFrame, kind: str) -> dict[int, int]:
        """Occurrences by bucket: a row per bucket and task is shuffled, and one per bucket
        comes to the driver."""
        buckets = self.draw.buckets

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(buckets, dtype=np.int64)
            for batch in batches:
                for mark in batch.column(0):
                    total += np.bincount(np.frombuffer(mark.as_buffer(), kind), minlength=buckets)
            seen = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["bucket", "n"])

        counted = features.select("buckets").mapInArrow(run, "bucket bigint, n bigint")
        return dict(counted.groupBy("bucket").agg(F.sum("n")).collect())

    def _scored(self, kind: str) -> DataFrame:
        own = self.gains

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                numbers, weights = [], []
                for mark in batch.column(2):
                    bucket = np.frombuffer(mark.as_buffer(), kind)
                    numbers.append(len(bucket))
                    weights.append(int(own[bucket].sum()) // len(bucket) if len(bucket) else 0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(numbers, pa.int64()), pa.array(weights, pa.int64())],
                    ["doc", "n_words", "n_features", "weight"],
                )

        weighed = self.features.mapInArrow(
            run,
            f"doc {self.features.schema['doc'].dataType.simpleString()}, n_words bigint, "
            "n_features bigint, weight bigint",
        )
        name = F.concat(F.lit(f"{self.draw.seed}:"), F.coalesce(F.col("doc").cast("string"), F.lit("")))
        h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("bigint")
        noise = F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
        return weighed.withColumn("score", F.col("weight") + noise)

    def ranked(self) -> DataFrame:
        """One row per document: key, n_features, weight, score, and its rank if drawn.

        Scores are whole thousandths between bounds that the logarithms give (about 115,000
        values), so a table with a row per score is small whatever the corpus; it tells how
        many documents come before a score, and ranks within a score are taken apart.
        """
        able = F.col("n_words") >= self.draw.least_words
        down = Window.orderBy(F.desc("score"))
        before = F.coalesce(F.sum("n").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        size = F.expr(f"{self.draw.percent} * sum(n) OVER () div 100")
        cuts = self.work.stage(
            self.scored.filter(able).groupBy("score").agg(F.count("*").alias("n"))
            .select(F.col("score").alias("at"), before.alias("before"), size.alias("size"))
            .filter("before < size"),
            "cuts",
        )
        joined = self.scored.join(cuts, able & (F.col("score") == F.col("at")), "left")
        within = Window.partitionBy("at").orderBy(F.col("doc").asc_nulls_last(), "n_features", "weight")
        place = F.col("before") + F.row_number().over(within)
        top = joined.filter("at IS NOT NULL").withColumn("rank", F.when(place <= F.col("size"), place))
        rest = joined.filter("at IS NULL").withColumn("rank", F.lit(None).cast("bigint"))
        return top.unionByName(rest).select(
            F.col("doc").alias(self.key), "n_features", "weight", "score", F.col("rank").cast("bigint").alias("rank")
        )

    def drawn(self) -> DataFrame:
        """The documents drawn, whole rows; keys must be unique and not null."""
        chosen = self.ranked().filter("rank IS NOT NULL").select(F.col(f"`{self.key}`").alias("_drawn"))
        taken = self.documents.join(chosen, F.col(f"`{self.key}`") == chosen["_drawn"], "left_semi")
        return taken.select(*[f"`{c}`" for c in self.documents.columns])
