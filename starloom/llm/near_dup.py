"""Near-duplicate documents: MinHash signatures joined within a Hamming distance.

A document's word shingles become a signature of 16-bit minima.  The signature is split
into chunks; two signatures that differ in at most 2 * chunks - 1 values agree in some
chunk up to one value (pigeonhole), so every chunk yields one key for each value left out
and all such pairs share a key.  Documents with equal shingle sets are one node from the
start.  A key's nodes are first linked to the key's best-supported node, and only keys
whose nodes then still lie in different components are searched pair by pair.  A link
counts once it is confirmed on the full shingle sets of both texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom.llm import textops as t
from starloom.llm.components import components
from starloom.sources.scratch import Workspace

STARS = 2
BLOCK_NODES = 256
SMALL_KEY = 16
KEYS_MOST = 128
#: Bits of the filter for wanted texts, 64 to a row: 2 ** 18 rows are broadcast at most.
FILTER_BITS = 24
_LONGEST_RUN = 1 << 15


@dataclass(frozen=True)
class Shape:
    """Words of a shingle, similarity in percent, and the layout of signatures."""

    words: int = 5
    percent: int = 80
    chunks: int = 10
    chunk_values: int = 6
    screen: int = 30

    @property
    def values(self) -> int:
        return self.chunks * self.chunk_values

    @property
    def guaranteed(self) -> int:
        """All pairs of signatures up to this distance share a key."""
        return 2 * self.chunks - 1


# --- shingles and signatures, in tasks ---------------------------------------------


def shingle_sets(column: pa.Array, words: int) -> Iterator[np.ndarray]:
    """The distinct shingle hashes of each text, sorted.

    A text with fewer words than a shingle has its whole word sequence as its one shingle;
    one without words has none.
    """
    data, offsets = t.utf8(column)
    hashes, counts = t.word_hashes(data, offsets, t.LOWER)
    ends = np.cumsum(counts)
    for end, n in zip(ends.tolist(), counts.tolist()):
        own = hashes[end - n : end]
        if n == 0:
            yield own
            continue
        size = min(words, n)
        rolled = np.full(n - size + 1, size, dtype=np.uint64)
        for k in range(size):
            rolled = t.mix(rolled * np.uint64(t.ODD) + own[k : n - size + 1 + k])
        yield np.unique(rolled)


def signature(shingles: np.ndarray, values: int) -> np.ndarray:
    factors = t.mix(np.arange(1, values + 1, dtype=np.uint64)) | np.uint64(1)
    low = np.full(values, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), _LONGEST_RUN):
        part = shingles[at : at + _LONGEST_RUN]
        np.minimum(low, np.multiply.outer(factors, part).min(axis=1), out=low)
    return (t.mix(low) >> np.uint64(48)).astype("<u2")


def text_key(text: Column) -> tuple[Column, Column]:
    """128 bits that stand for a text."""
    return F.xxhash64(text), F.xxhash64(F.lit(7), text)


def signatures(documents: DataFrame, key: str, text: str, shape: Shape) -> DataFrame:
    """A row per document: its key, text key, set size, set hash and signature."""
    kind = documents.schema[key].dataType.simpleString()
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    k1, k2 = text_key(whole)
    given = documents.select(F.col(f"`{key}`").alias("doc"), k1.alias("k1"), k2.alias("k2"), whole.alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, hashes, marks = [], [], []
            for shingles in shingle_sets(batch.column(3), shape.words):
                sizes.append(len(shingles))
                # Sums of mixed members stand for the set whatever the order.
                hashes.append(
                    (t.mix(shingles).sum(dtype=np.uint64), t.mix(shingles ^ np.uint64(t.ODD)).sum(dtype=np.uint64))
                )
                marks.append(signature(shingles, shape.values).tobytes() if len(shingles) else None)
            pair = np.array(hashes, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(sizes, pa.int64()),
                 pa.array(pair[:, 0]), pa.array(pair[:, 1]), pa.array(marks, pa.binary())],
                ["doc", "k1", "k2", "n_shingles", "s1", "s2", "signature"],
            )

    return given.mapInArrow(
        run,
        f"doc {kind}, k1 bigint, k2 bigint, n_shingles bigint, s1 bigint, s2 bigint, "
        "signature binary",
    )


def keys(nodes: DataFrame, shape: Shape) -> DataFrame:
    """(node, key): for every chunk, its values with one left out."""
    if shape.values > KEYS_MOST:
        raise ValueError(f"a signature has at most {KEYS_MOST} values")
    size = shape.chunk_values
    found = []
    for chunk in range(shape.chunks):
        first, end = 2 * chunk * size + 1, 2 * (chunk + 1) * size + 1
        for left_out in range(size):
            at = first + 2 * left_out
            rest = F.concat(
                F.substring("signature", first, at - first),
                F.substring("signature", at + 2, end - at - 2),
            )
            # The last bits tell which key of its node this is.
            hashed = F.xxhash64(rest).bitwiseAND(F.lit(-KEYS_MOST))
            found.append(hashed.bitwiseOR(F.lit(chunk * size + left_out)))
    return nodes.select("node", F.explode(F.array(*found)).alias("key"))


def first_shared(a: np.ndarray, b: np.ndarray, shape: Shape) -> np.ndarray:
    """Of each pair of signatures, the index of the first key they share; -1 if none."""
    same = (a == b).reshape(len(a), shape.chunks, shape.chunk_values)
    missing = shape.chunk_values - same.sum(axis=2)
    chunk = np.argmax(missing <= 1, axis=1)
    row = np.arange(len(a))
    left_out = np.where(missing[row, chunk] == 1, np.argmin(same[row, chunk], axis=1), 0)
    return np.where((missing <= 1).any(axis=1), chunk * shape.chunk_values + left_out, -1)


# --- the join ----------------------------------------------------------------------


class NearDuplicates:
    """Components of near-duplicate documents.

    Similarity is that of the distinct shingles of lower-cased (A to Z) words.  Null and
    blank texts have no shingles and are linked with nothing.  Null keys come last in
    order; repeated rows are equal documents.  Other columns are not read.
    """

    def __init__(
        self, documents: DataFrame, key: str = "doc_id", text: str = "text",
        shape: Shape = Shape(),
    ):
        self.documents, self.key, self.text, self.shape = documents, key, text, shape
        self.work = Workspace(documents.sparkSession, "near")
        self.signed = self.work.stage(
            signatures(documents, key, text, shape).withColumn(
                "node", F.monotonically_increasing_id()
            ),
            "signatures",
        )
        self.nodes = self.work.stage(self._nodes(), "nodes")
        self.shared = self.work.stage(self._shared_keys(), "shared")
        self.work.drop("key-sizes")
        self.texts = self.work.stage(self._texts(), "texts")
        self.work.drop("wanted")
        self._links: list[DataFrame] = []
        self.labels = self._search()
        self.work.drop("shared", "texts", *[f"links{k}" for k in range(STARS)], "links-small", "links-hot")

    def _nodes(self) -> DataFrame:
        """One node per shingle set: the document that comes first."""
        first = F.min(
            F.struct(F.col("doc").isNull().alias("last"), "doc", "node", "k1", "k2", "signature")
        )
        sets = self.signed.filter("n_shingles > 0").groupBy("s1", "s2").agg(first.alias("f"))
        return sets.select("s1", "s2", "f.node", "f.doc", "f.k1", "f.k2", "f.signature")

    def _shared_keys(self) -> DataFrame:
        """(key, node, size) of keys that several nodes have."""
        every = keys(self.nodes, self.shape)
        shared = self.work.stage(
            every.groupBy(F.col("key").alias("of")).agg(F.count("*").alias("size"))
            .filter("size > 1"),
            "key-sizes",
        )
        return every.join(shared, F.col("key") == F.col("of")).select("key", "node", "size")

    def _texts(self) -> DataFrame:
        """The texts of nodes that share a key."""
        wanted = self.work.stage(
            self.shared.select("node").distinct().join(
                self.nodes.select("node", F.col("doc").alias("d"), F.col("k1").alias("w1"), F.col("k2").alias("w2")),
                "node",
            ),
            "wanted",
        )
        whole = F.coalesce(F.col(f"`{self.text}`"), F.lit(""))
        k1, k2 = text_key(whole)
        given = self.documents.select(
            F.col(f"`{self.key}`").alias("doc"), whole.alias("text"), k1.alias("k1"), k2.alias("k2")
        )
        # Most texts are wanted by nobody.  Bits of the wanted texts' hashes, in a table of
        # constant size, hold those back before anything is shuffled; the join is exact.
        bit = F.col("w1").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
        bits = (
            wanted.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).alias("word"))
            .agg(F.expr("bit_or(shiftleft(1L, CAST(bit & 63 AS int)))").alias("bits"))
        )
        word = F.shiftright(F.col("k1").bitwiseAND(F.lit((1 << FILTER_BITS) - 1)), 6)
        given = (
            given.join(F.broadcast(bits), word == F.col("word"))
            .filter("shiftright(bits, CAST(k1 & 63 AS int)) & 1 = 1")
            .select("doc", "text", "k1", "k2")
        )
        same = (F.col("k1") == F.col("w1")) & (F.col("k2") == F.col("w2")) & F.col("doc").eqNullSafe(F.col("d"))
        # Rows that repeat both key and text give the same node twice; pairs are made
        # distinct after they are confirmed.
        return given.join(wanted, same).select("node", "text")

    def _confirmed(self, pairs: DataFrame, name: str) -> DataFrame:
        """The pairs (a, b) whose full shingle sets are similar enough."""
        words, percent = self.shape.words, self.shape.percent

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: tuple[int | None, np.ndarray | None] = (None, None)
            for batch in batches:
                a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                keep = np.zeros(len(a), dtype=bool)
                others = shingle_sets(batch.column(3), words)
                for row, second in enumerate(others):
                    if held[0] != a[row]:
                        held = (a[row], next(shingle_sets(batch.column(2).slice(row, 1), words)))
                    first = held[1]
                    both = len(np.intersect1d(first, second, assume_unique=True))
                    keep[row] = 100 * both >= percent * (len(first) + len(second) - both)
                yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], ["a", "b"])

        first = self.texts.select(F.col("node").alias("na"), F.col("text").alias("text_a"))
        second = self.texts.select(F.col("node").alias("nb"), F.col("text").alias("text_b"))
        with_texts = (
            pairs.join(second, F.col("b") == F.col("nb"))
            .join(first, F.col("a") == F.col("na"))
            .select("a", "b", "text_a", "text_b")
        )
        return self.work.stage(with_texts.mapInArrow(run, "a bigint, b bigint").distinct(), name)

    def _components(self, name: str) -> DataFrame:
        links = self._links[0]
        for more in self._links[1:]:
            links = links.union(more)
        return components(links, self.work, name)

    def _open_keys(self, labels: DataFrame | None, shared: DataFrame, name: str) -> DataFrame:
        """``shared`` with each node's component, of keys that still span several."""
        if labels is None:
            labelled = shared.withColumn("component", F.col("node"))
        else:
            labels = labels.withColumnRenamed("node", "n")
            labelled = shared.drop("component").join(labels, F.col("node") == F.col("n"), "left")
            labelled = labelled.select(
                "key", "node", "size", F.coalesce("component", "node").alias("component")
            )
        labelled = self.work.stage(labelled, f"{name}-labelled")
        spread = self.work.stage(
            labelled.groupBy(F.col("key").alias("of"))
            .agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
            .filter("lo <> hi").select("of"),
            f"{name}-spread",
        )
        opened = labelled.join(spread, F.col("key") == F.col("of"), "left_semi")
        opened = self.work.stage(opened, f"{name}-open")
        self.work.drop(f"{name}-labelled", f"{name}-spread")
        return opened

    def _star_pairs(self, opened: DataFrame, name: str) -> DataFrame:
        """Each node with the best-supported node of other components among its keys' hubs.

        A node's support is the number of nodes it meets; the text that others were copied
        from has most.
        """
        support = opened.groupBy("node").agg(F.sum("size").alias("support"))
        supported = self.work.stage(
            opened.join(support.withColumnRenamed("node", "n"), F.col("node") == F.col("n")),
            f"{name}-supported",
        )
        rank = F.struct(F.col("support"), (-F.col("node")).alias("early"), F.col("component").alias("hub_component"))
        hubs = self.work.stage(
            supported.groupBy(F.col("key").alias("of")).agg(F.max(rank).alias("hub")), f"{name}-hubs"
        )
        met = supported.join(hubs, F.col("key") == F.col("of")).filter(
            F.col("component") != F.col("hub.hub_component")
        )
        best = met.groupBy("node").agg(F.max("hub").alias("hub"))
        pairs = best.select((-F.col("hub.early")).alias("a"), F.col("node").alias("b"))
        pairs = self.work.stage(self._screened(pairs), f"{name}-pairs")
        self.work.drop(f"{name}-supported", f"{name}-hubs")
        return pairs

    def _screened(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose signatures are not too far apart; no text travels yet."""
        shape = self.shape
        first = self.nodes.select(F.col("node").alias("na"), F.col("signature").alias("mark_a"))
        second = self.nodes.select(F.col("node").alias("nb"), F.col("signature").alias("mark_b"))
        marked = (
            pairs.join(second, F.col("b") == F.col("nb"))
            .join(first, F.col("a") == F.col("na"))
            .select("a", "b", "mark_a", "mark_b")
        )

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                a, b = (
                    np.frombuffer(b"".join(batch.column(k).to_pylist()), "<u2").reshape(-1, shape.values)
                    for k in (2, 3)
                )
                near = (a != b).sum(axis=1) <= shape.screen
                kept = batch.filter(pa.array(near))
                yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1)], ["a", "b"])

        return marked.mapInArrow(run, "a bigint, b bigint")

    def _open_pairs(self, opened: DataFrame) -> DataFrame:
        """All pairs across components in keys of at most SMALL_KEY nodes, but those whose
        signatures are too far apart; each pair once, from the first key it shares."""
        shape = self.shape
        signed = self.nodes.select(F.col("node").alias("n"), "signature")
        rows = opened.join(signed, F.col("node") == F.col("n")).select("key", "node", "component", "signature")
        met = rows.repartition("key").sortWithinPartitions("key", "node")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out: list[np.ndarray] = []
            for group in groups_of(batches, ("key",)):
                nodes, parts = group["node"].to_numpy(), group["component"].to_numpy()
                index = group["key"][0].as_py() % KEYS_MOST
                marks = _marks(group, shape)
                x, y = np.triu_indices(len(nodes), 1)
                near = (parts[x] != parts[y]) & ((marks[x] != marks[y]).sum(axis=1) <= shape.screen)
                x, y = x[near], y[near]
                # The same pair met under an earlier key is left to that key.
                own = first_shared(marks[x], marks[y], shape) == index
                out.append(np.stack([nodes[x[own]], nodes[y[own]]], 1))
                if len(out) == 1000:
                    yield _pairs_batch(out)
                    out = []
            if out:
                yield _pairs_batch(out)

        return met.mapInArrow(run, "a bigint, b bigint")

    def _hot_links(self, opened: DataFrame, name: str) -> DataFrame:
        """Confirmed links between components among nodes that share large keys.

        Nodes that large keys connect form a cluster, dealt into blocks of bounded size; a
        task holds the texts of two blocks, confirms pairs on full sets as it goes, and
        gives no more links than it takes to join what it joined: no list of pairs arises.
        """
        shape, work = self.shape, self.work
        first = work.stage(
            opened.groupBy(F.col("key").alias("of")).agg(F.min("node").alias("b")), f"{name}-first"
        )
        star = opened.join(first, F.col("key") == F.col("of")).select(F.col("node").alias("a"), "b")
        clusters = components(star, work, f"{name}-cluster").select(
            F.col("node").alias("n"), F.col("component").alias("cluster")
        )
        sizes = work.stage(
            clusters.groupBy(F.col("cluster").alias("c")).agg(
                F.ceil(F.count("*") / BLOCK_NODES).cast("int").alias("blocks")
            ),
            f"{name}-blocks",
        )
        parts = opened.select(F.col("node").alias("p"), "component").distinct()
        signed = self.nodes.select("node", "signature")
        rows = work.stage(
            clusters.join(sizes, F.col("cluster") == F.col("c"))
            .join(parts, F.col("n") == F.col("p"))
            .join(signed, F.col("n") == F.col("node"))
            .select("cluster", "node", "component", "signature", "blocks",
                    F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block")),
            f"{name}-rows",
        )
        # Block i meets block j for all i <= j: a row goes to each meeting of its block.
        meetings = (
            rows.join(self.texts.withColumnRenamed("node", "n"), F.col("node") == F.col("n"))
            .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("cluster", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"),
                    "node", "component", "signature", "block", "text")
        )
        met = meetings.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j", "node")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for group in groups_of(batches, ("cluster", "i", "j")):
                yield _pairs_batch([_joined(group, shape)])

        return work.stage(met.mapInArrow(run, "a bigint, b bigint").distinct(), name)

    def _open_links(self, opened: DataFrame) -> list[DataFrame]:
        """Confirmed links for all pairs that open keys hold."""
        sizes = self.work.stage(
            opened.groupBy(F.col("key").alias("of")).agg(F.count("*").alias("n_open")), "open-sizes"
        )
        sized = self.work.stage(
            opened.join(sizes, F.col("key") == F.col("of")).select("key", "node", "component", "n_open"),
            "open-sized",
        )
        small = self._confirmed(self._open_pairs(sized.filter(F.col("n_open") <= SMALL_KEY)), "links-small")
        large = sized.filter(F.col("n_open") > SMALL_KEY)
        if large.isEmpty():
            return [small]
        hot = self._hot_links(large, "links-hot")
        parts = ("first", "cluster-components", "blocks", "rows")
        self.work.drop(*[f"links-hot-{part}" for part in parts])
        return [small, hot]

    def _search(self) -> DataFrame:
        labels, opened = None, self.shared
        for k in range(STARS):
            opened = self._open_keys(labels, opened, f"star{k}")
            pairs = self._star_pairs(opened, f"star{k}")
            self._links.append(self._confirmed(pairs, f"links{k}"))
            labels = self._components(f"c{k}")
            # What the round has used up; of its components the labels are kept.
            self.work.drop(f"star{k}-pairs", *[f"star{k - 1}-open", f"c{k - 1}-components"][: 2 * k])
        opened = self._open_keys(labels, opened, "rest")
        self.work.drop(f"star{STARS - 1}-open")
        if not opened.isEmpty():
            self._links += self._open_links(opened)
            labels = self._components("c-rest")
        self.work.drop("rest-open", "open-sizes", "open-sized")
        return labels

    def classes(self) -> DataFrame:
        """(c1, c2, component_id, first_k1, first_k2): for every shingle set, its
        component's first document."""
        labelled = self.work.stage(
            self.nodes.join(self.labels.withColumnRenamed("node", "n"), F.col("node") == F.col("n"), "left")
            .select("s1", "s2", "doc", "k1", "k2", "node", F.coalesce("component", "node").alias("component")),
            "labelled",
        )
        first = self.work.stage(
            labelled.groupBy(F.col("component").alias("c")).agg(
                F.min(F.struct(F.col("doc").isNull().alias("last"), "doc", "k1", "k2")).alias("f")
            ),
            "firsts",
        )
        found = self.work.stage(
            labelled.join(first, F.col("component") == F.col("c")).select(
                F.col("s1").alias("c1"), F.col("s2").alias("c2"), F.col("f.doc").alias("component_id"),
                F.col("f.k1").alias("first_k1"), F.col("f.k2").alias("first_k2"),
            ),
            "classes",
        )
        self.work.drop("labelled", "firsts")
        return found

    def membership(self) -> DataFrame:
        """One row per document: key, n_shingles, component_id and kept.

        ``component_id`` is the smallest key reachable; ``kept`` tells whether it is the
        document's own.  A document linked with nothing is its own component.
        """
        same = (F.col("s1") == F.col("c1")) & (F.col("s2") == F.col("c2")) & (F.col("n_shingles") > 0)
        component = F.when(F.col("c1").isNull(), F.col("doc")).otherwise(F.col("component_id"))
        return self.signed.join(self.classes(), same, "left").select(
            F.col("doc").alias(self.key), "n_shingles", component.alias("component_id"),
            F.col("doc").eqNullSafe(component).alias("kept"),
        )

    def survivors(self) -> DataFrame:
        """The documents, whole rows, less all but the first of each component.

        Documents linked with nothing stay, those without words among them.  Columns may
        have any names; they travel as one value.
        """
        same = (F.col("s1") == F.col("c1")) & (F.col("s2") == F.col("c2")) & (F.col("n_shingles") > 0)
        first = (
            F.col("c1").isNull()
            | (F.col("doc").eqNullSafe(F.col("component_id"))
               & (F.col("k1") == F.col("first_k1")) & (F.col("k2") == F.col("first_k2")))
        )
        staying = self.signed.join(self.classes(), same, "left").filter(first)
        staying = self.work.stage(
            staying.groupBy("doc", "k1", "k2")
            .agg(F.max(F.when(F.col("n_shingles") > 0, 1).otherwise(0)).alias("once")),
            "staying",
        )
        t1, t2 = text_key(F.coalesce(F.col(f"`{self.text}`"), F.lit("")))
        rows = self.documents.select(
            F.struct(*[F.col(f"`{c}`") for c in self.documents.columns]).alias("row"),
            F.col(f"`{self.key}`").alias("d"), t1.alias("t1"), t2.alias("t2"),
        )
        same = (F.col("t1") == F.col("k1")) & (F.col("t2") == F.col("k2")) & F.col("d").eqNullSafe(F.col("doc"))
        # Of rows equal in key and text one stays; texts without words are no duplicates.
        again = W.partitionBy("k1", "k2", "doc").orderBy(F.lit(0))
        return (
            rows.join(staying, same)
            .withColumn("nth", F.row_number().over(again))
            .filter((F.col("nth") == 1) | (F.col("once") == 0))
            .select("row.*")
        )


def _marks(group: pa.Table, shape: Shape) -> np.ndarray:
    return np.frombuffer(b"".join(group["signature"].to_pylist()), "<u2").reshape(-1, shape.values)


def _pairs_batch(pairs: list[np.ndarray]) -> pa.RecordBatch:
    both = np.concatenate(pairs).reshape(-1, 2).astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])


def _joined(group: pa.Table, shape: Shape) -> np.ndarray:
    """Links that join the components of two blocks' nodes, confirmed on full sets."""
    nodes, blocks = group["node"].to_numpy(), group["block"].to_numpy()
    i, j = group["i"][0].as_py(), group["j"][0].as_py()
    marks = _marks(group, shape)
    column = group["text"].combine_chunks() if isinstance(group["text"], pa.ChunkedArray) else group["text"]
    sets = list(shingle_sets(column, shape.words))
    parts = np.unique(group["component"].to_numpy(), return_inverse=True)[1]
    links = []
    inner = np.flatnonzero(blocks == j)
    for x in np.flatnonzero(blocks == i):
        others = inner[(inner > x) | (i != j)]
        others = others[parts[others] != parts[x]]
        others = others[(marks[others] != marks[x]).sum(axis=1) <= shape.screen]
        for y in others.tolist():
            if parts[y] == parts[x]:
                continue
            both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
            if 100 * both >= shape.percent * (len(sets[x]) + len(sets[y]) - both):
                links.append((nodes[x], nodes[y]))
                parts[parts == parts[y]] = parts[x]
    return np.array(links, dtype=np.int64).reshape(-1, 2)


def groups_of(batches: Iterator[pa.RecordBatch], by: tuple[str, ...]) -> Iterator[pa.Table]:
    """Tables of the rows with equal ``by``, from batches sorted by it."""
    held: list[pa.RecordBatch] = []
    mark = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in by]
        change = np.zeros(batch.num_rows, dtype=bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            own = tuple(c[start] for c in columns)
            if mark is not None and own != mark:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            held.append(batch.slice(start, end - start))
            mark = own
    if held:
        yield pa.Table.from_batches(held).combine_chunks()
