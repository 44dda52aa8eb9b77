"""Quality classifier from weak labels.

Heuristic labellers vote good, junk or nothing on every document.  Expectation-maximisation
over the counts of all vote patterns estimates how often each labeller is right, and each
pattern's probability of good.  Those posterior labels train a hashed linear scorer, which
then judges every document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm import linear
from starloom.llm.signals import Signs, signs

#: The scorer is fitted on about so many documents of either posterior class, picked by hash
#: over all documents; a fifth of them is kept for calibration.
SAMPLE_PER_CLASS = 2500
HELD_OUT = 5
#: Documents stay unless they are probably junk, with room for doubt.
THRESHOLD = 0.3
EM_ROUNDS = 100

NOTHING, GOOD, JUNK = 0, 1, 2


def votes(s: Signs) -> tuple[int, ...]:
    """One vote of each labeller.  Every kind of junk is in reach of several of them."""
    n = max(s.n_words, 1)
    letters = max(s.n_upper + s.n_lower, 1)
    chars = max(s.word_chars, 1)
    long_enough = s.n_words >= 40
    stops, top = s.n_stops / n, s.top_word / n

    def junk(found: bool) -> int:
        return JUNK if found else NOTHING

    return (
        junk(s.n_symbols / n > 0.2),
        junk(s.n_symbols / chars > 0.05),
        junk(long_enough and not 0.02 < stops < 0.5) or (GOOD if 0.05 < stops < 0.35 else NOTHING),
        junk(s.n_repeat_words / n > 0.3),
        junk(long_enough and top > 0.2) or (GOOD if long_enough and top < 0.12 else NOTHING),
        junk(s.n_upper / letters > 0.3),
        junk(s.n_exclaims / n > 0.15),
        junk(s.n_lines >= 3 and s.n_dup_lines / max(s.n_lines, 1) > 0.3),
        junk(long_enough and s.n_distinct / n < 0.15),
        junk(s.n_bare / n > 0.15),
        junk(s.n_words == 0),
    )


LABELLERS = len(votes(Signs()))


def pattern(vote: tuple[int, ...]) -> int:
    """Votes as one number, three values a labeller."""
    return sum(v * 3**k for k, v in enumerate(vote))


def unpattern(number: int) -> tuple[int, ...]:
    return tuple(number // 3**k % 3 for k in range(LABELLERS))


#: Votes that each labeller is taken to have cast on documents of either class before any
#: is seen, and how it cast them: few, so that the figures are those of the documents.
PRIOR_VOTES = 20.0
PRIOR_GOOD = 0.85
#: Labellers that can vote for good, besides junk and nothing.
CAN_PRAISE = tuple(k in (2, 4) for k in range(LABELLERS))
#: Least and greatest chance of a vote that a labeller can cast.
LEAST_CHANCE = 1e-6


def _first_guess() -> np.ndarray:
    """P(vote | class) by class (junk, good), labeller and vote, before any document."""
    table = np.zeros((2, LABELLERS, 3))
    for k, praises in enumerate(CAN_PRAISE):
        table[1, k] = (0.55, 0.44, 0.01) if praises else (0.99, 0.0, 0.01)
        table[0, k] = (0.55, 0.15, 0.3) if praises else (0.7, 0.0, 0.3)
    return table


def _ordered(table: np.ndarray) -> np.ndarray:
    """The same chances, but that a vote for junk is never likelier on good documents, nor
    one for good on junk: where it would be, both classes get the chance of their mean.

    This alone tells the classes apart; it says nothing of how good a labeller is.
    """
    for vote, likelier in ((JUNK, 0), (GOOD, 1)):
        wrong = table[likelier, :, vote] < table[1 - likelier, :, vote]
        table[:, wrong, vote] = table[:, wrong, vote].mean(axis=0)
    table[:, :, NOTHING] = np.maximum(1 - table[:, :, GOOD] - table[:, :, JUNK], LEAST_CHANCE)
    return table / table.sum(axis=2, keepdims=True)


def estimate(counts: dict[int, int], rounds: int = EM_ROUNDS) -> tuple[dict[int, float], np.ndarray]:
    """P(good) of each vote pattern, and P(vote | class) of each labeller (junk, then good).

    Votes for nothing are an outcome like the others.  Besides PRIOR_VOTES votes a labeller,
    the figures come from the documents, however many there are.
    """
    numbers = np.array(sorted(counts), dtype=np.int64)
    weight = np.array([counts[n] for n in numbers.tolist()], dtype=float)
    vote = np.array([unpattern(n) for n in numbers.tolist()], dtype=np.int64).reshape(-1, LABELLERS)
    given = _first_guess()
    table, prior = np.maximum(given, LEAST_CHANCE), PRIOR_GOOD
    post = np.zeros(len(numbers))
    for _ in range(rounds):
        like = np.log(table[:, np.arange(LABELLERS), vote]).sum(axis=2)
        post = linear.sigmoid(like[1] - like[0] + np.log(prior / (1 - prior)))
        for c, share in ((1, post), (0, 1 - post)):
            for v in range(3):
                seen = ((weight * share)[:, None] * (vote == v)).sum(axis=0)
                table[c, :, v] = np.maximum(seen + PRIOR_VOTES * given[c, :, v], LEAST_CHANCE)
            table[c] /= table[c].sum(axis=1, keepdims=True)
        table = _ordered(table)
        prior = float(np.clip((weight * post).sum() / max(weight.sum(), 1), 0.01, 0.99))
    return dict(zip(numbers.tolist(), post.tolist())), table


def vote_patterns(documents: DataFrame, text: str, carried: list) -> DataFrame:
    """``carried`` columns with each text's vote pattern."""
    given = documents.select(F.col(f"`{text}`").alias("text"), *carried)
    names = given.columns[1:]
    kinds = "".join(f", {c} {given.schema[c].dataType.simpleString()}" for c in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [pattern(votes(s)) for s in signs(batch.column(0))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.int32()), *batch.columns[1:]], ["pattern", *names]
            )

    return given.mapInArrow(run, f"pattern int{kinds}")


class WeakQuality:
    """P(good) of documents without a single label.

    A text without words counts as junk.  Null and repeated keys are kept as they are.
    Other columns are not read.
    """

    def __init__(
        self, documents: DataFrame, key: str = "doc_id", text: str = "text",
        per_class: int = SAMPLE_PER_CLASS,
    ):
        self.documents, self.key, self.text = documents, key, text
        # At most 3 ** LABELLERS rows.
        counted = vote_patterns(documents, text, []).groupBy("pattern").count().collect()
        counts = {r["pattern"]: r["count"] for r in counted}
        self.posterior, self.accuracy = estimate(counts)
        self.model = self._fit(counts, per_class)

    def _fit(self, counts: dict[int, int], per_class: int) -> linear.Linear:
        posterior = self.posterior
        size = {
            c: sum(n for p, n in counts.items() if (posterior[p] >= 0.5) == c) for c in (True, False)
        }
        share = {c: min(1.0, per_class / max(n, 1)) for c, n in size.items()}
        text = F.coalesce(F.col(f"`{self.text}`"), F.lit(""))
        # Uniform in 0..1 by id and text; copies under other ids are drawn independently.
        draw = F.pmod(F.xxhash64(F.col(f"`{self.key}`"), text, F.lit(3)), F.lit(1 << 30)) / (1 << 30)
        drawn = self.documents.select(text.alias("text"), draw.alias("draw")).filter(
            F.col("draw") < max(share.values())
        )

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                draws = batch.column(1).to_pylist()
                good = [posterior[pattern(votes(s))] for s in signs(batch.column(0))]
                keep = [d < share[p >= 0.5] for d, p in zip(draws, good)]
                out = pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(draws, pa.float64()), pa.array(good, pa.float64())],
                    ["text", "draw", "good"],
                )
                yield out.filter(pa.array(keep, pa.bool_()))

        chosen = drawn.mapInArrow(run, "text string, draw double, good double")
        # The draw keeps about per_class rows of a class; the limit bounds the driver.
        rows, given = linear.sample_features(chosen.limit(4 * per_class))
        good = np.array([g for _, g in given])
        held = np.array([int(d * (1 << 30)) % HELD_OUT == 0 for d, _ in given], dtype=bool)
        importance = np.array([1 / share[g >= 0.5] for g in good])
        return linear.fit(rows, good, importance, 1 << linear.BITS, held)

    def scored(self, threshold: float = THRESHOLD) -> DataFrame:
        """One row per document: votes' posterior, the scorer's P(good), and ``kept``."""
        kind = self.documents.schema[self.key].dataType.simpleString()
        posterior, model, key = self.posterior, self.model, self.key

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = list(_judged(batch.column(1), posterior, model, threshold))
                columns = list(zip(*found)) or [[]] * 4
                kinds = (pa.int64(), pa.float64(), pa.float64(), pa.bool_())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                    [key, "n_words", "posterior", "probability", "kept"],
                )

        given = self.documents.select(
            F.col(f"`{self.key}`").alias("key"), F.col(f"`{self.text}`").alias("text")
        )
        return given.mapInArrow(
            run, f"`{key}` {kind}, n_words bigint, posterior double, probability double, kept boolean"
        )

    def good(self, threshold: float = THRESHOLD) -> DataFrame:
        """The documents, whole rows, that the scorer accepts."""
        posterior, model = self.posterior, self.model
        columns = self.documents.columns
        at = columns.index(self.text)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                kept = [j[3] for j in _judged(batch.column(at), posterior, model, threshold)]
                yield batch.filter(pa.array(kept, pa.bool_()))

        given = self.documents.select(*[F.col(f"`{c}`") for c in columns])
        return given.mapInArrow(run, self.documents.schema)


def _judged(column: pa.Array, posterior: dict[int, float], model: linear.Linear, threshold: float):
    for s, features in zip(signs(column), linear.text_features(column)):
        p = model.probability(features) if s.n_words else 0.0
        yield s.n_words, posterior.get(pattern(votes(s)), 0.5), p, p >= threshold
