"""Mixing sources to target weights, in DataFrame functions only.

Each source's words form one stream, cut into blocks of fixed length.  A source's quota of
output slots follows from its target; the slots are dealt over the output shards by an
independent uniform draw each, so a shard's counts are multinomial given the quotas and
the totals meet the targets.  Slot k of a source is mapped to a block by a pseudorandom
permutation of the block indices (swap-or-not, one permutation per pass over the source),
and slots and blocks meet in a join on source and block index.

Nothing is ordered in one task: positions come from sums per chunk of rows, then sums
within a chunk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom.sources.scratch import Workspace

#: Fixed values of the mix: weights by rank of the source, repeated.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
PASSES = 2
BLOCK_WORDS = 128
SHARD_SLOTS = 4096
SEED = 17

_CHUNK_BITS = 12
_SLOT_CHUNK = 1 << 14
_ROUNDS = 16


def word_count(text: Column) -> Column:
    """Number of words; null has none.  Every word, with what follows it, becomes one x."""
    marked = F.regexp_replace(text, r"[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+", "x")
    return F.coalesce(F.length(F.translate(marked, " \t\n\x0b\x0c\r", "")), F.lit(0)).cast("bigint")


def running_totals(
    rows: DataFrame, by: list[str], order: list[str], chunk: Column, value: str, out: str
) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the rows of the same ``by`` that come before.

    ``chunk`` is a number that grows with ``order``.  Windows see one chunk, or one row per
    chunk, so a ``by`` that holds most rows is no single task.
    """
    keyed = rows.withColumn("_chunk", chunk)
    totals = keyed.groupBy(*by, "_chunk").agg(F.sum(value).alias("_sum"))
    ahead = W.partitionBy(*by).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)],
        F.col("_chunk").alias("_at"),
        F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_offset"),
    )
    within = (
        W.partitionBy(*by, "_chunk").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    )
    same = F.col("_at") == F.col("_chunk")
    for i, c in enumerate(by):
        same &= F.col(f"_by{i}").eqNullSafe(F.col(c))
    return (
        keyed.withColumn("_within", F.coalesce(F.sum(value).over(within), F.lit(0)))
        .join(offsets, same)
        .withColumn(out, F.col("_offset") + F.col("_within"))
        .drop("_chunk", "_at", "_offset", "_within", *[f"_by{i}" for i in range(len(by))])
    )


def targets(
    sources: DataFrame, share: float = SHARE, passes: int = PASSES, weights=WEIGHTS
) -> DataFrame:
    """``sources`` (source, source_size) with target: the words the mix wants of each.

    Sources by code point, null last, weigh ``weights`` in turn and share ``share`` of all
    words; a target stops at ``passes`` times its source's words and the excess is shared
    anew.  With caps ordered by cap over weight, the level at which sharing ends is that of
    the first source whose cap is not reached, so no iteration is needed.
    """
    # Sources are names in a mixing plan: one row each, far fewer than documents.
    name_order = W.orderBy(F.col("source").asc_nulls_last())
    ranked = sources.withColumn("_rank", (F.row_number().over(name_order) - 1) % len(weights))
    weighted = ranked.withColumn(
        "_weight", F.array(*[F.lit(float(w)) for w in weights])[F.col("_rank")]
    ).withColumn("_cap", F.col("source_size") * F.lit(float(passes)))
    order = W.orderBy(F.col("_cap") / F.col("_weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    onward = order.rowsBetween(W.currentRow, W.unboundedFollowing)
    everything = W.orderBy(F.lit(0)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    total = F.sum("source_size").over(everything) * F.lit(float(share))
    level = (
        total - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    ) / F.sum("_weight").over(onward)
    return (
        weighted.withColumn("_level", level)
        .withColumn(
            "_open", F.when(F.col("_level") * F.col("_weight") < F.col("_cap"), F.col("_level"))
        )
        # The first level below its cap is the final one; the later ones repeat it.
        .withColumn("_first", F.first("_open", ignorenulls=True).over(
            order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
        .withColumn(
            "target",
            F.coalesce(
                F.least(F.col("_cap"), F.col("_first") * F.col("_weight")), F.col("_cap")
            ),
        )
        .drop("_rank", "_weight", "_cap", "_level", "_open", "_first")
    )


def _rounds(key: Column, n: Column, reverse: bool) -> Column:
    order = range(_ROUNDS - 1, -1, -1) if reverse else range(_ROUNDS)
    rounds = [
        F.struct(
            F.pmod(F.xxhash64(key, F.lit(r), F.lit(SEED)), n).alias("shift"),
            F.lit(r).alias("r"),
        )
        for r in order
    ]
    return F.array(*rounds)


def permuted(index: Column, key: Column, n: Column, reverse: bool = False) -> Column:
    """A pseudorandom permutation of 0..n-1 chosen by ``key``, or its inverse.

    Swap-or-not: every round pairs x with shift - x and a hash of the pair decides whether
    they swap.  Each round is its own inverse, so running them backwards inverts all.
    """

    def step(x: Column, r: Column) -> Column:
        partner = F.pmod(r["shift"] - x, n)
        swap = F.xxhash64(F.greatest(x, partner), key, r["r"]) % 2 == 0
        return F.when(swap, partner).otherwise(x)

    return F.aggregate(_rounds(key, n, reverse), index.cast("bigint"), step)


def _quotas(sized: DataFrame, block: int) -> DataFrame:
    """Per source: blocks, words of the last block, slots, and words of the last slot.

    The last slot takes only so many words of its block that the source's total is its
    target, rounded to a word.
    """
    size, tail = F.col("source_size"), F.col("_tail_words")
    want, done = F.col("_want"), F.col("_pass_start")
    quotas = (
        sized.filter((size > 0) & (F.round("target") > 0))
        .withColumn("_want", F.round("target").cast("bigint"))
        .withColumn("_blocks", F.ceil(size / block).cast("bigint"))
        .withColumn("_tail_words", size - (F.col("_blocks") - 1) * block)
        .withColumn("_pass", F.floor((want - 1) / size).cast("bigint"))
        .withColumn("_pass_start", F.col("_pass") * size)
        .withColumn("_key", F.xxhash64("source", F.lit(SEED), "_pass"))
        .withColumn(
            "_tail_at", permuted(F.col("_blocks") - 1, F.col("_key"), F.col("_blocks"), True)
        )
        .withColumn("_left", want - done)
        .withColumn("_plain", F.ceil(F.col("_left") / block).cast("bigint"))
    )
    slots = F.when(F.col("_tail_at") >= F.col("_plain"), F.col("_plain")).otherwise(
        F.ceil((F.col("_left") + block - tail) / block).cast("bigint")
    )
    last = F.when(
        F.col("_tail_at") < F.col("_in_pass") - 1,
        F.col("_left") - (F.col("_in_pass") - 2) * block - tail,
    ).otherwise(F.col("_left") - (F.col("_in_pass") - 1) * block)
    return (
        quotas.withColumn("_in_pass", slots)
        .withColumn("_last_words", last)
        .withColumn("_slots", F.col("_pass") * F.col("_blocks") + F.col("_in_pass"))
        .select("source", "_blocks", "_slots", "_last_words")
    )


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _slots(quotas: DataFrame, shard_slots: int) -> DataFrame:
    """One row per output slot: shard, source, slot number and block index."""
    total = quotas.agg(F.sum("_slots")).first()[0] or 0
    shards = F.lit(max(1, -(-total // shard_slots)))
    chunks = quotas.withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col("_slots") - 1) / _SLOT_CHUNK)))
    )
    # A source with most of the slots has many chunks: deal them before they unfold.
    first = F.col("_chunk") * _SLOT_CHUNK
    final = F.least(first + _SLOT_CHUNK, F.col("_slots")) - 1
    slots = (
        chunks.repartition(shuffle_partitions(quotas), F.xxhash64("source", "_chunk"))
        .withColumn("slot", F.explode(F.sequence(first, final)))
        .withColumn("_key", F.xxhash64("source", F.lit(SEED), F.floor(F.col("slot") / F.col("_blocks"))))
    )
    return slots.select(
        F.pmod(F.xxhash64("source", "slot", F.lit(SEED + 1)), shards).alias("shard"),
        "source",
        "slot",
        permuted(F.col("slot") % F.col("_blocks"), F.col("_key"), F.col("_blocks")).alias("block"),
        F.when(F.col("slot") == F.col("_slots") - 1, F.col("_last_words")).alias("_only"),
    )


class Mix:
    """A mix of the documents' words.

    ``documents`` needs a text and a source; ``doc`` names the columns that identify a
    document in the results.  Null texts have no words and null sources form a source of
    their own.  Repeated rows are documents of their own.  Columns not named are not read;
    those named in ``keep`` are there for ``mixed``.
    """

    def __init__(
        self, documents: DataFrame, text: str = "text", source: str = "source",
        doc: tuple[str, ...] = ("doc_id",), block: int = BLOCK_WORDS,
        shard_slots: int = SHARD_SLOTS, keep: tuple[str, ...] = (),
    ):
        self.text, self.keep = text, keep
        self.block, self.shard_slots = block, shard_slots
        self.work = Workspace(documents.sparkSession, "mix")
        self.doc = list(doc)
        self.named = [f"_doc{i}" for i in range(len(doc))]
        counted = documents.select(
            *[F.col(f"`{c}`").alias(n) for c, n in zip(doc, self.named)],
            F.col(f"`{source}`").alias("source"),
            word_count(F.col(f"`{text}`")).alias("size"),
            F.monotonically_increasing_id().alias("_row"),
            *[F.col(f"`{c}`").alias(f"_keep{i}") for i, c in enumerate(keep)],
        )
        # Row numbers hold only for one reading of the input, so they are written down.
        self.rows = self.work.stage(counted, "rows")
        self.sizes = self.rows.select(*self.named, "source", "size", "_row")
        self.totals = self.work.stage(
            targets(
                self.sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
            ),
            "targets",
        )

    def segments(self) -> DataFrame:
        """One row per stretch of a document in a block of its source's stream."""
        placed = running_totals(
            self.sizes.filter("size > 0"), ["source"], ["_row"],
            F.shiftright("_row", _CHUNK_BITS), "size", "_start",
        )
        block = self.block
        pieces = placed.withColumn(
            "block",
            F.explode(
                F.sequence(
                    F.floor(F.col("_start") / block),
                    F.floor((F.col("_start") + F.col("size") - 1) / block),
                )
            ),
        )
        return pieces.select(
            "source", "block", "_row",
            F.greatest(F.col("_start") - F.col("block") * block, F.lit(0)).alias("in_block"),
            F.greatest(F.col("block") * block - F.col("_start"), F.lit(0)).alias("first_word"),
            (
                F.least(F.col("_start") + F.col("size"), (F.col("block") + 1) * block)
                - F.greatest(F.col("_start"), F.col("block") * block)
            ).alias("words"),
        )

    def slots(self) -> DataFrame:
        return _slots(_quotas(self.totals, self.block), self.shard_slots)

    def taken_pieces(self) -> DataFrame:
        """Slots joined to the stretches of their blocks; ``words`` is what is taken."""
        segments = self.segments().withColumnRenamed("source", "_source")
        same = (F.col("source").eqNullSafe(F.col("_source"))) & (
            F.col("block") == F.col("_block")
        )
        # Slots unfold from a few rows, so their size is not known beforehand: never broadcast.
        joined = self.slots().hint("merge").join(segments.withColumnRenamed("block", "_block"), same)
        words = F.least(
            F.col("words"),
            F.greatest(F.coalesce(F.col("_only"), F.lit(1 << 40)) - F.col("in_block"), F.lit(0)),
        )
        return (
            joined.withColumn("words", words)
            .filter("words > 0")
            .select("shard", "slot", "source", "block", "in_block", "_row", "first_word", "words")
        )

    def taken(self) -> DataFrame:
        """One row per document with the words the mix takes of it, also by output shard.

        ``shard_words`` maps each shard that holds any of them to their number; over all
        documents a shard's share follows the multinomial draw of the slots.
        """
        # Dealt by row once: both aggregates below then need no further shuffle.
        pieces = self.taken_pieces().select("_row", "shard", "words").repartition("_row")
        by_shard = pieces.groupBy("_row", "shard").agg(F.sum("words").alias("words"))
        used = by_shard.groupBy("_row").agg(
            F.sum("words").alias("taken"),
            F.map_from_entries(F.sort_array(F.collect_list(F.struct("shard", "words")))).alias("_shards"),
        )
        totals = self.totals.withColumnRenamed("source", "_source")
        none = F.create_map().cast("map<bigint,bigint>")
        return (
            self.sizes.join(used, "_row", "left")
            .join(totals, F.col("source").eqNullSafe(F.col("_source")))
            .select(
                *[F.col(n).alias(c) for n, c in zip(self.named, self.doc)],
                "size",
                "source_size",
                "target",
                F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"),
                F.coalesce("_shards", none).alias("shard_words"),
            )
        )

    def mixed(self) -> DataFrame:
        """The mix as texts: the kept columns, with the text cut to the words that are taken.

        Taken stretches of a document that follow one another in the same pass over its
        source are one row, so a document taken whole stays whole.  A text keeps its own
        white space between words.
        """
        pieces = self.taken_pieces().join(
            self.totals.select(
                F.col("source").alias("_source"),
                F.ceil(F.col("source_size") / self.block).alias("_blocks"),
            ),
            F.col("source").eqNullSafe(F.col("_source")),
        )
        pieces = pieces.withColumn("pass", F.floor(F.col("slot") / F.col("_blocks")))
        along = W.partitionBy("_row", "pass").orderBy("first_word")
        ends = F.lag(F.col("first_word") + F.col("words")).over(along)
        starts = F.when(ends == F.col("first_word"), 0).otherwise(1)
        runs = (
            pieces.withColumn("_starts", starts)
            .withColumn("_run", F.sum("_starts").over(along))
            .groupBy("_row", "pass", "_run")
            .agg(F.min("first_word").alias("first"), F.sum("words").alias("words"))
            .groupBy("_row")
            .agg(F.sort_array(F.collect_list(F.struct("pass", "first", "words"))).alias("_runs"))
        )
        kept = {c: F.col(f"_keep{i}") for i, c in enumerate(self.keep)}
        text, size = kept[self.text], F.col("size")
        # A text is joined and split into words once, however many runs are cut from it: the
        # generator keeps the words from being found again for each run.
        split = F.when(
            F.exists("_runs", lambda r: r["words"] < size),
            F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+[\x20\x09-\x0D]*)"), F.lit(1)),
        ).otherwise(F.array().cast("array<string>"))
        whole = runs.join(self.rows, "_row").select(
            *[f"_keep{i}" for i in range(len(self.keep))], "size", "_runs",
            F.explode(F.array(split)).alias("_words"),
        )
        first, length = (lambda r: (r["first"] + 1).cast("int")), (lambda r: r["words"].cast("int"))
        cuts = F.transform(
            "_runs",
            lambda r: F.when(r["words"] == size, text).otherwise(
                F.concat_ws("", F.slice("_words", first(r), length(r)))
            ),
        )
        cut = whole.select(*[f"_keep{i}" for i in range(len(self.keep))], F.explode(cuts).alias("_cut"))
        columns = {**kept, self.text: F.col("_cut")}
        return cut.select(*[column.alias(c) for c, column in columns.items()])
