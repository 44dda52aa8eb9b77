"""Quality rules: counted base rules, then a calibrated hashed n-gram classifier.

The classifier learns from a bounded sample of the labelled rows and scores every text in
Arrow batches against a fixed threshold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm import linear
from starloom.llm.signals import signs

#: The classifier is fitted on at most so many labelled rows of each class, those with the
#: smallest hashes of their ids; every fifth of them is kept for calibration.
SAMPLE_PER_CLASS = 2000
HELD_OUT = 5
THRESHOLD = 0.5
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50


def train(documents: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> linear.Linear:
    """A model of P(good).  Labels: doc_id and quality 0/1; null labels or ids are left out,
    and of several labels of a document the lowest holds.  Without rows of both classes
    the model gives the share of good ones, or a half."""
    each = (
        labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)")
        .groupBy(F.col("doc_id").alias("labelled")).agg(F.min("quality").alias("quality"))
    )
    totals = {r["quality"]: r["count"] for r in each.groupBy("quality").count().collect()}
    order = (F.xxhash64("labelled", F.lit(5)), F.col("labelled"))
    picked = None
    for quality in sorted(totals):
        part = each.filter(F.col("quality") == quality).orderBy(*order).limit(per_class)
        picked = part if picked is None else picked.union(part)
    if picked is None:
        return linear.fit([], np.zeros(0), np.zeros(0), 1 << linear.BITS, np.zeros(0, bool))
    # At most 2 * per_class ids: a proven bound for the broadcast.
    sample = documents.select(F.col("doc_id").alias("id"), "text").join(
        F.broadcast(picked), F.col("id") == F.col("labelled")
    )
    sample = sample.select(
        "text", (F.xxhash64("labelled", F.lit(6)) % HELD_OUT == 0).cast("int").alias("held"), "quality"
    ).limit(4 * per_class)
    rows, given = linear.sample_features(sample)
    y = np.array([float(r[1]) for r in given])
    held = np.array([bool(r[0]) for r in given], dtype=bool)
    seen = {q: max(int((y == q).sum()), 1) for q in (0, 1)}
    importance = np.array([totals.get(int(v), 1) / seen[int(v)] for v in y])
    return linear.fit(rows, y, importance, 1 << linear.BITS, held)


COLUMNS = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, base_failed boolean, probability double, kept boolean"
)


def judge(
    documents: DataFrame, model: linear.Linear, key: str = "doc_id", text: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per document: base counts, the base verdict, P(good) and ``kept``.

    A null text has no words and fails.  Null and repeated keys are kept as they are; other
    columns are not read; an empty table gives no rows.
    """
    kind = documents.schema[key].dataType.simpleString()
    names = [c.split()[0] for c in COLUMNS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for s, features in zip(signs(batch.column(1)), linear.text_features(batch.column(1))):
                failed = (
                    s.n_words < LEAST_WORDS
                    or 100 * s.n_repeat_words > MOST_REPEATED_PERCENT * s.n_words
                )
                p = model.probability(features)
                rows.append(
                    (s.n_words, s.word_chars, s.n_symbols, s.n_dup_lines, s.n_repeat_words,
                     failed, p, not failed and p >= threshold)
                )
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]
            columns = list(zip(*rows)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]], [key, *names]
            )

    given = documents.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    return given.mapInArrow(run, f"`{key}` {kind}, {COLUMNS}")
