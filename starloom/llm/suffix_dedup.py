"""Removal of repeated byte strings by bucket-pointer refinement.

A suffix array is refined only where it can matter.  Every window of ``length`` bytes holds
a sampled position: the least hash among its q-grams.  The sampled q-grams are the initial
buckets, dealt over the cluster; a bucket with one member is done.  Neighbouring windows
share their sampled position, so a bucket's member is a run of windows with the bytes they
cover.  Runs equal as a whole are settled by their hash.  The rest is refined within the
bucket: positions are sorted on the pair of their own bucket's number and that of a later
offset, the new numbers are used for the next, longer offset, and members that are alone
drop out, until buckets stand for ``length`` equal bytes.  A bucket too large for that, of a
passage that very many texts have with other text around it, is dealt out as windows, which
are counted by their hashes with partial sums.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom.llm import textops as t
from starloom.llm.near_dup import groups_of, text_key
from starloom.sources.scratch import Workspace

GRAM = 64
HOT_BUCKET = 5_000
BATCH_BYTES = 4 << 20
#: A bucket is refined inside a task up to so many bytes of content; a larger one is counted
#: window by window all over the cluster.
BUCKET_BYTES = 4 << 20

#: A place packs a run: its first window, its length and its sampled position, and whether
#: the run was met before among the rows of the same task.
_RUN_BITS = 11
_RUN_MASK = (1 << _RUN_BITS) - 1
RUNS = "gram bigint, whole bigint, k1 bigint, k2 bigint, place bigint"
SETTLED = 2


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbouring values."""
    n = len(values) - width + 1
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(values)] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def window_runs(
    data: np.ndarray, offsets: np.ndarray, length: int, gram: int
) -> Iterator[tuple[np.ndarray, ...]]:
    """Per piece of the texts: gram hash, whole hash, row, first window, run length and
    sampled position (both relative to the first window) of each run."""
    width = length - gram + 1
    for i, j in t.row_blocks(offsets):
        begin, stop = int(offsets[i]), int(offsets[j])
        for start in range(begin, max(stop - length + 1, begin), t.PIECE_BYTES):
            # The last piece of a block takes what is left of it.
            end = min(start + t.PIECE_BYTES + length - 1, stop)
            piece = data[start:end]
            if len(piece) < length:
                continue
            prefix = t.prefix_hash(piece)
            at = np.arange(len(piece) - gram + 1)
            grams = t.span_hash(prefix, at, at + gram)
            low_bits = np.uint64(21)
            ranked = (grams >> low_bits << low_bits) | at.astype(np.uint64)
            sampled = (sliding_min(ranked, width) & np.uint64((1 << 21) - 1)).astype(np.int64)
            windows = np.arange(len(sampled))
            row = np.searchsorted(offsets[i : j + 1], windows + start, side="right") - 1 + i
            inside = windows + start + length <= offsets[row + 1]
            windows, row, sampled = windows[inside], row[inside], sampled[inside]
            if not len(windows):
                continue
            new = np.ones(len(windows), dtype=bool)
            new[1:] = (sampled[1:] != sampled[:-1]) | (row[1:] != row[:-1])
            first = np.flatnonzero(new)
            count = np.diff(np.append(first, len(windows)))
            lo, row, sampled = windows[first], row[first], sampled[first]
            whole = t.mix(
                t.span_hash(prefix, lo, lo + count - 1 + length)
                + (sampled - lo).astype(np.uint64) * np.uint64(t.ODD)
            )
            yield grams[sampled], whole, row, lo + start - offsets[row], count, sampled - lo


def _place(first: np.ndarray, count: np.ndarray, sampled: np.ndarray, seen: np.ndarray):
    """Window numbers have 63 - 2 * 11 - 2 bits."""
    return ((first << _RUN_BITS | count) << _RUN_BITS | sampled) << 2 | seen


def _unplace(place: np.ndarray) -> tuple[np.ndarray, ...]:
    return (
        place >> (2 * _RUN_BITS + 2),
        place >> (_RUN_BITS + 2) & _RUN_MASK,
        place >> 2 & _RUN_MASK,
        place & 3,
    )


def merged(row: np.ndarray, lo: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Spans of each row, overlapping and touching ones made one.  Rows are numbers >= 0."""
    if not len(row):
        return row, lo, end
    order = np.lexsort((lo, row))
    row, lo, end = row[order], lo[order], end[order]
    # Rows are set apart by more than any span is long, so one running maximum serves all.
    far = int(end.max()) + 2
    base = row - row.min()
    reach = np.maximum.accumulate(base * far + end)
    new = np.ones(len(row), dtype=bool)
    new[1:] = base[1:] * far + lo[1:] > reach[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(row)) - 1
    return row[first], lo[first], (reach - base * far)[last]


def runs(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """``texts`` (k1, k2, text) as runs of windows.

    Of equal runs in a batch only one goes on; the others are settled, as spans of bytes,
    and travel under a key of their own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            data, offsets = t.utf8(batch.column(2))
            found = list(window_runs(data, offsets, length, gram))
            if not found:
                continue
            grams, whole, row, first, count, sampled = map(np.concatenate, zip(*found))
            order = np.lexsort((whole, grams))
            same = (grams[order][1:] == grams[order][:-1]) & (whole[order][1:] == whole[order][:-1])
            repeated = np.zeros(len(grams), dtype=bool)
            repeated[order[1:]] = same
            seen = np.zeros(len(grams), dtype=np.int64)
            seen[order[:-1]] = same
            keep = np.flatnonzero(~repeated)
            # The one that goes on has been met twice already, if others are equal to it.
            out = pa.RecordBatch.from_arrays(
                [pa.array(grams[keep].view(np.int64)), pa.array(whole[keep].view(np.int64)),
                 pa.array(k1[row[keep]]), pa.array(k2[row[keep]]),
                 pa.array(_place(first[keep], count[keep], sampled[keep], seen[keep]))],
                ["gram", "whole", "k1", "k2", "place"],
            )
            yield out
            span_row, lo, end = merged(
                row[repeated], first[repeated], first[repeated] + count[repeated] - 1 + length
            )
            own = t.mix(lo.astype(np.uint64) ^ k1[span_row].view(np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(own), pa.array(end), pa.array(k1[span_row]), pa.array(k2[span_row]),
                 pa.array(lo << 2 | SETTLED)],
                ["gram", "whole", "k1", "k2", "place"],
            )

    return texts.mapInArrow(run, RUNS)


def settle(found: DataFrame) -> DataFrame:
    """Runs of buckets with more than one member: which are repeated as a whole, and one
    run of each content of the buckets that hold several contents (``onward``)."""
    bucket = W.partitionBy("gram")
    content = W.partitionBy("gram", "whole")
    seen = F.col("place").bitwiseAND(F.lit(3))
    return (
        found.filter(seen < SETTLED)
        .withColumn("_equal", F.count(F.lit(1)).over(content))
        .withColumn("_nth", F.row_number().over(content.orderBy("k1", "k2", "place")))
        .withColumn("_low", F.min("whole").over(bucket))
        .withColumn("_high", F.max("whole").over(bucket))
        .select(
            "gram", "k1", "k2", "place",
            ((F.col("_equal") > 1) | (seen == 1)).alias("repeated"),
            ((F.col("_nth") == 1) & (F.col("_low") != F.col("_high"))).alias("onward"),
        )
        .filter("repeated OR onward")
    )


def run_spans(settled: DataFrame, length: int) -> DataFrame:
    """(k1, k2, lo, hi): the bytes that runs repeated as a whole cover."""
    first = F.shiftright("place", 2 * _RUN_BITS + 2)
    count = F.shiftright("place", _RUN_BITS + 2).bitwiseAND(F.lit(_RUN_MASK))
    return settled.filter("repeated").select(
        "k1", "k2", first.alias("lo"), (first + count - 1 + length).alias("hi")
    )


CONTENTS = "bucket bigint, k1 bigint, k2 bigint, lo bigint, count int, content binary"


def contents(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """``texts`` (k1, k2, text, wanted) as the bytes of the wanted runs, by bucket.

    A hot bucket is refined once beforehand: a run's windows that reach far to the right of
    the sampled position go by the longer gram on that side, the others by that on the left.
    """
    reach = (length - gram) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = t.utf8(batch.column(2))
            rows: list[tuple] = []
            for k, wanted in enumerate(batch.column(3)):
                own = data[offsets[k] : offsets[k + 1]]
                k1, k2 = batch.column(0)[k].as_py(), batch.column(1)[k].as_py()
                for item in wanted.as_py():
                    first, count, sampled, _ = (int(x) for x in _unplace(np.int64(item["place"])))
                    parts = [(item["gram"], first, count)]
                    if item["hot"]:
                        at = first + sampled
                        left = min(max(at - reach - first, 0), count)
                        parts = []
                        for lo, n, begin in ((first, left, at - reach), (first + left, count - left, at)):
                            if n:
                                side = own[max(begin, 0) : begin + gram + reach]
                                mark = int(t.span_hash(t.prefix_hash(side), np.array([0]), np.array([len(side)]))[0])
                                parts.append((int(np.uint64(mark).view(np.int64)), lo, n))
                    for bucket, lo, n in parts:
                        rows.append((bucket, k1, k2, lo, n, own[lo : lo + n - 1 + length].tobytes()))
                if len(rows) > 2000 or k + 1 == batch.num_rows:
                    columns = list(zip(*rows)) or [[]] * 6
                    kinds = [pa.int64()] * 4 + [pa.int32(), pa.binary()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, kind) for c, kind in zip(columns, kinds)],
                        ["bucket", "k1", "k2", "lo", "count", "content"],
                    )
                    rows = []

    return texts.mapInArrow(run, CONTENTS)


def _numbered(values: np.ndarray) -> np.ndarray:
    """Bucket numbers of equal values; -1 for a value that is alone."""
    _, number, size = np.unique(values, return_inverse=True, return_counts=True)
    return np.where(size[number] > 1, number, -1)


def refine(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> np.ndarray:
    """For each position, whether its ``length`` bytes stand at another position too.

    Buckets start as equal q-grams.  Each round sorts positions on their bucket's number and
    that of the position as many bytes on as the buckets cover (at last, so many that the
    two cover ``length``).  Positions alone in a bucket take part no more.
    """
    owner_end = np.repeat(offsets[1:], np.diff(offsets))
    at = np.flatnonzero(np.arange(len(data)) + gram <= owner_end)
    bucket = np.full(len(data), -1, dtype=np.int64)
    bucket[at] = _numbered(t.span_hash(t.prefix_hash(data), at, at + gram))
    covered = gram
    while covered < length:
        step = min(covered, length - covered)
        covered += step
        at = at[(bucket[at] >= 0) & (at + covered <= owner_end[at])]
        at = at[bucket[at + step] >= 0]
        longer = np.full(len(data), -1, dtype=np.int64)
        longer[at] = _numbered(bucket[at] * len(data) + bucket[at + step])
        bucket = longer
    return bucket >= 0


def refined_spans(dealt: DataFrame, length: int, gram: int) -> DataFrame:
    """(k1, k2, lo, hi): repeated bytes found by refining whole buckets."""

    def spans(group: list[pa.Table]) -> pa.RecordBatch:
        rows = pa.concat_tables(group).combine_chunks()
        sizes = np.array([len(c) for c in rows["content"].to_pylist()], dtype=np.int64)
        data = np.frombuffer(b"".join(rows["content"].to_pylist()), np.uint8)
        offsets = np.concatenate(([0], np.cumsum(sizes)))
        again = np.flatnonzero(refine(data, offsets, length, gram))
        row = np.searchsorted(offsets, again, side="right") - 1
        first = again - offsets[row] + rows["lo"].to_numpy()[row]
        row, lo, hi = merged(row, first, first + length)
        return pa.RecordBatch.from_arrays(
            [pa.array(rows["k1"].to_numpy()[row]), pa.array(rows["k2"].to_numpy()[row]), pa.array(lo), pa.array(hi)],
            ["k1", "k2", "lo", "hi"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = [], 0
        for bucket in groups_of(batches, ("bucket",)):
            if held and held + bucket.nbytes > BATCH_BYTES:
                yield spans(group)
                group, held = [], 0
            group.append(bucket)
            held += bucket.nbytes
        if group:
            yield spans(group)

    return dealt.mapInArrow(run, "k1 bigint, k2 bigint, lo bigint, hi bigint")


def windows(large: DataFrame, length: int) -> DataFrame:
    """(w1, w2, k1, k2, lo): each window of contents under a hash of 128 bits, of which
    one half stands for the bucket and the first part of the window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for given in batches:
            # A content has some hundred windows.
            for begin in range(0, given.num_rows, 500):
                batch = given.slice(begin, 500)
                sizes = batch.column(5).to_numpy().astype(np.int64)
                data = np.frombuffer(b"".join(batch.column(4).to_pylist()), np.uint8)
                row = np.repeat(np.arange(len(sizes)), sizes)
                nth = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                at = nth + np.repeat(np.cumsum(sizes + length - 1) - (sizes + length - 1), sizes)
                prefix = t.prefix_hash(data)
                whole = t.span_hash(prefix, at, at + length)
                part = t.span_hash(prefix, at, at + length // 2)
                part = t.mix(part + batch.column(0).to_numpy().view(np.uint64)[row])
                lo = batch.column(3).to_numpy()[row] + nth
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part.view(np.int64)), pa.array(whole.view(np.int64)),
                     pa.array(batch.column(1).to_numpy()[row]), pa.array(batch.column(2).to_numpy()[row]), pa.array(lo)],
                    ["w1", "w2", "k1", "k2", "lo"],
                )

    given = large.select("bucket", "k1", "k2", "lo", "content", "count")
    return given.mapInArrow(run, "w1 bigint, w2 bigint, k1 bigint, k2 bigint, lo bigint")


def counted_spans(large: DataFrame, length: int, work: Workspace) -> DataFrame:
    """(k1, k2, lo, hi): repeated bytes of large buckets, found by counting windows.

    Windows met very often are few and are looked up by broadcast, the others by shuffle,
    so no task has all places of one window.
    """
    each = windows(large, length)
    found = work.stage(
        each.groupBy(F.col("w1").alias("c1"), F.col("w2").alias("c2")).count().filter("count > 1"),
        "counted",
    )
    same = (F.col("w1") == F.col("c1")) & (F.col("w2") == F.col("c2"))
    often, seldom = found.filter(F.col("count") > HOT_BUCKET), found.filter(F.col("count") <= HOT_BUCKET)
    places = each.join(F.broadcast(often), same).select("k1", "k2", "lo").union(
        each.join(F.broadcast(often), same, "left_anti").join(seldom, same).select("k1", "k2", "lo")
    )
    return places.select("k1", "k2", "lo", (F.col("lo") + length).alias("hi"))


class RepeatedBytes:
    """Bytes of the documents that lie in a string of ``length`` bytes found elsewhere.

    Texts are UTF-8 bytes (null: empty); strings do not cross documents, may overlap, and
    count within a document as well.  Repeated rows are documents of their own, so each
    repeats the other.  Null keys are allowed.
    """

    def __init__(
        self, documents: DataFrame, key: str = "doc_id", text: str = "text",
        length: int = 200, gram: int = GRAM,
    ):
        if not 2 * gram < length + 1 <= 1 << (_RUN_BITS - 1):
            raise ValueError("the gram must be shorter than half the length, at most 1023")
        self.documents, self.key, self.text = documents, key, text
        self.length = length
        work = self.work = Workspace(documents.sparkSession, "repeats")
        found = work.stage(runs(self._texts(), length, gram), "runs")
        settled = work.stage(settle(found), "settled")
        covers = run_spans(settled, length).union(
            found.filter(F.col("place").bitwiseAND(F.lit(3)) == SETTLED).select(
                "k1", "k2", F.shiftright("place", 2).alias("lo"), F.col("whole").alias("hi")
            )
        )
        given = work.stage(contents(self._wanted(settled), length, gram), "contents")
        size = F.sum(F.length("content").cast("bigint"))
        large = work.stage(
            given.groupBy(F.col("bucket").alias("of")).agg(size.alias("size")).filter(F.col("size") > BUCKET_BYTES),
            "large",
        )
        own = F.col("bucket") == F.col("of")
        dealt = given.join(F.broadcast(large), own, "left_anti")
        dealt = dealt.repartition("bucket").sortWithinPartitions("bucket")
        refined = refined_spans(dealt, length, gram)
        if not large.isEmpty():
            refined = refined.union(counted_spans(given.join(F.broadcast(large), own, "left_semi"), length, work))
        self.spans = work.stage(
            covers.union(refined).distinct()
            .groupBy("k1", "k2")
            .agg(F.collect_list("lo").alias("los"), F.collect_list("hi").alias("his"))
            .withColumnsRenamed({"k1": "s1", "k2": "s2"}),
            "spans",
        )
        work.drop("runs", "settled", "wanted", "hot", "contents", "large", "counted")

    def _keys(self) -> tuple[Column, Column]:
        return text_key(F.coalesce(F.col(f"`{self.text}`"), F.lit("")))

    def _texts(self, *more: Column) -> DataFrame:
        k1, k2 = self._keys()
        text = F.coalesce(F.col(f"`{self.text}`"), F.lit(""))
        return self.documents.select(k1.alias("k1"), k2.alias("k2"), text.alias("text"), *more)

    def _wanted(self, settled: DataFrame) -> DataFrame:
        """(k1, k2, text, wanted): the texts with runs to refine, of equal texts one."""
        onward = settled.filter("onward")
        hot = self.work.stage(
            onward.groupBy(F.col("gram").alias("of")).count().filter(F.col("count") > HOT_BUCKET),
            "hot",
        )
        marked = onward.join(hot, F.col("gram") == F.col("of"), "left")
        item = F.struct("gram", "place", F.col("of").isNotNull().alias("hot"))
        wanted = marked.groupBy("k1", "k2").agg(F.collect_list(item).alias("wanted"))
        k1, k2 = self._keys()
        doc = F.col(f"`{self.key}`")
        first = self.documents.select(k1.alias("f1"), k2.alias("f2"), doc.alias("doc")).groupBy("f1", "f2").agg(
            F.min(F.struct(F.col("doc").isNull().alias("last"), "doc")).alias("first")
        )
        one = (F.col("k1") == F.col("f1")) & (F.col("k2") == F.col("f2"))
        wanted = self.work.stage(
            wanted.join(first, one).select(
                F.col("k1").alias("w1"), F.col("k2").alias("w2"), F.col("first.doc").alias("of"), "wanted"
            ),
            "wanted",
        )
        given = self._texts(doc.alias("doc"))
        same = (F.col("k1") == F.col("w1")) & (F.col("k2") == F.col("w2")) & F.col("doc").eqNullSafe(F.col("of"))
        return given.join(wanted, same).select("k1", "k2", "text", "wanted")

    def _cut(self, columns: list[str], schema: str, rows_of) -> DataFrame:
        """Documents with their spans, through ``rows_of`` (batch, kept bytes and spans)."""
        k1, k2 = self._keys()
        texts = F.coalesce(F.col(f"`{self.text}`"), F.lit(""))
        given = self.documents.select(
            *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)],
            texts.alias("_text"), k1.alias("_k1"), k2.alias("_k2"),
        )
        # Equal texts have equal spans; a text that very many rows share is split by
        # adaptive execution, both sides being scans.
        same = (F.col("_k1") == F.col("s1")) & (F.col("_k2") == F.col("s2"))
        joined = given.join(self.spans, same, "left").select(
            "_text", "los", "his", *[f"c{i}" for i in range(len(columns))]
        )

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                data, offsets = t.utf8(batch.column(0))
                los, his = batch.column(1), batch.column(2)
                cuts = []
                for k in range(batch.num_rows):
                    own, lo, hi = data[offsets[k] : offsets[k + 1]], los[k].as_py() or [], his[k].as_py() or []
                    zero = np.zeros(len(lo), dtype=np.int64)
                    _, lo, hi = merged(zero, np.array(lo, np.int64), np.array(hi, np.int64))
                    edges = np.concatenate(([0], np.stack([lo, hi], 1).ravel(), [len(own)])).astype(int)
                    kept = b"".join(own[a:b].tobytes() for a, b in zip(edges[::2], edges[1::2]))
                    cuts.append((len(own), kept, len(lo)))
                yield rows_of(batch.select(range(3, batch.num_columns)), cuts)

        return joined.mapInArrow(run, schema)

    def report(self) -> DataFrame:
        """One row per document: sizes, number of spans, digest of what is left."""
        names = [self.key, "n_bytes", "n_removed", "n_spans", "kept_sha256"]

        def rows_of(batch: pa.RecordBatch, cuts: list[tuple[int, bytes, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([n for n, _, _ in cuts], pa.int64()),
                 pa.array([n - len(kept) for n, kept, _ in cuts], pa.int64()),
                 pa.array([spans for _, _, spans in cuts], pa.int64()),
                 pa.array([hashlib.sha256(kept).hexdigest() for _, kept, _ in cuts], pa.string())],
                names,
            )

        kind = self.documents.schema[self.key].dataType.simpleString()
        schema = f"`{self.key}` {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
        return self._cut([self.key], schema, rows_of)

    def cleaned(self) -> DataFrame:
        """The documents, whole rows, with the repeated bytes cut from their texts.

        A character of which a cut leaves only some bytes is dropped.
        """
        columns = self.documents.columns
        at = columns.index(self.text)

        def rows_of(batch: pa.RecordBatch, cuts: list[tuple[int, bytes, int]]) -> pa.RecordBatch:
            arrays = list(batch.columns)
            texts = [kept.decode("utf-8", "ignore") for _, kept, _ in cuts]
            had = arrays[at].is_valid().to_pylist()
            arrays[at] = pa.array([x if h else None for x, h in zip(texts, had)], arrays[at].type)
            return pa.RecordBatch.from_arrays(arrays, columns)

        return self._cut(columns, self.documents.schema, rows_of)
