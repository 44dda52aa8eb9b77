"""Secrets in texts: base patterns, and strings that look drawn at random.

Two character Markov models, one of random strings and one of ordinary identifiers, are
trained from labelled samples.  A run of token characters that no base pattern covers is
reported if the log-likelihood ratio of the two models passes a threshold, which is set on
samples held out, so that one ordinary identifier in a thousand passes at most.
"""

from __future__ import annotations

import builtins
import importlib
import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm import textops as t

# The base patterns, in order, and what a match must have.
ASSIGN = re.compile(
    rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE,
)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "random")
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 6, 20, 24

#: Token characters; a run of fewer than LEAST_RUN is never taken for random.
TOKEN = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
LEAST_RUN = 16
_RUN = re.compile(rb"[A-Za-z0-9+/_=-]{%d,}" % LEAST_RUN)
# Of all runs of hex digits these are the ones long enough: a run's first digit comes first.
_LONG_HEX = re.compile(rb"[0-9a-f]{%d,}" % LEAST_HEX)
_WORD = re.compile(rb"[A-Za-z0-9+/_=-]{6,}")

#: The samples' bounds: strings of each class, the documents that ordinary ones come from,
#: the longest string, strings drawn at random for the random class, every how manieth is
#: held out, and the share of ordinary strings that may pass.
SAMPLE = 10_000
SAMPLE_DOCUMENTS = 2_000
LONGEST_SAMPLE = 200
GENERATED = 4_000
HELD_OUT = 5
FALSE_SHARE = 0.001

#: Least likelihood ratio of a span: one run of token characters in a thousand is a secret.
LEAST_RATIO = math.log(1000)

#: Modules whose public names are ordinary identifiers beside those of the corpus.
NAME_MODULES = (
    "argparse ast asyncio calendar codecs collections concurrent.futures configparser csv ctypes "
    "datetime decimal difflib email.message errno functools gettext gzip hashlib html http.client "
    "inspect io itertools json logging mailbox multiprocessing operator optparse os pathlib pickle "
    "platform random re sched selectors shutil signal smtplib socket sqlite3 ssl statistics string "
    "struct subprocess tarfile tempfile textwrap threading tokenize traceback types typing "
    "unittest urllib.parse uuid warnings weakref xml.dom.minidom xml.sax zipfile"
).split()

# Alphabets of common random strings.
_DIGITS, _LOW, _UP = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ALPHABETS = (
    _DIGITS + "abcdef",
    _DIGITS + "ABCDEF",
    _UP + "234567",
    _DIGITS + _LOW,
    _DIGITS + _LOW + _UP,
    _DIGITS + _LOW + _UP + "+/",
    _DIGITS + _LOW + _UP + "-_",
)

_START = len(TOKEN)
_CODE = np.full(256, _START, dtype=np.int64)
_CODE[list(TOKEN)] = np.arange(len(TOKEN))


# --- the two models --------------------------------------------------------------------


def _contexts(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every character of all strings, with the two before it in its string."""
    # Two start marks before each string keep strings apart.
    joined = _CODE[np.frombuffer(b"".join(b"\0\0" + s for s in strings), np.uint8)]
    here = np.flatnonzero(joined < _START)
    return joined[here - 2], joined[here - 1], joined[here]


def _chances(strings: list[bytes], strength: float = 4.0) -> np.ndarray:
    """P(character | two before it), each context leaning on the one that is shorter."""
    states, size = _START + 1, _START
    two, one, now = _contexts(strings)
    single = np.bincount(now, minlength=size) + 1.0
    chance = single / single.sum()
    pairs = np.bincount(one * size + now, minlength=states * size).reshape(states, size)
    chance = (pairs + strength * chance) / (pairs.sum(1, keepdims=True) + strength)
    triples = np.bincount((two * states + one) * size + now, minlength=states**2 * size)
    triples = triples.reshape(states, states, size)
    return (triples + strength * chance) / (triples.sum(2, keepdims=True) + strength)


@dataclass
class RandomOrName:
    """Log-likelihood ratios by context and character, and the threshold for a string."""

    ratios: np.ndarray
    threshold: float

    def scores(self, strings: list[bytes]) -> np.ndarray:
        """The ratio of each string's likelihoods; above 0 speaks for a random string."""
        if not strings:
            return np.zeros(0)
        two, one, now = _contexts(strings)
        ends = np.cumsum([len(s) for s in strings])
        sums = np.concatenate(([0.0], np.cumsum(self.ratios[two, one, now], dtype=np.float64)))
        return sums[ends] - sums[ends - [len(s) for s in strings]]


def fit(drawn: list[bytes], ordinary: list[bytes]) -> RandomOrName:
    """Models of both classes; every fifth string of each is held out for the threshold.

    The threshold is what one in a thousand ordinary strings of those held out passes, and
    LEAST_RATIO at least.  Without a string of either class nothing passes.
    """
    if not drawn or not ordinary:
        return RandomOrName(np.zeros((_START + 1, _START + 1, _START), np.float32), float("inf"))
    parts = {k: ([s for i, s in enumerate(v) if (i % HELD_OUT == 0) == held] or v)
             for k, v, held in (("drawn", drawn, False), ("ordinary", ordinary, False), ("held", ordinary, True))}
    ratios = np.log(_chances(parts["drawn"])) - np.log(_chances(parts["ordinary"]))
    model = RandomOrName(ratios.astype(np.float32), LEAST_RATIO)
    scores = np.sort(model.scores([s for s in parts["held"] if len(s) >= LEAST_RUN]))
    if len(scores):
        model.threshold = max(LEAST_RATIO, float(scores[int((1 - FALSE_SHARE) * (len(scores) - 1))]))
    return model


def generated(number: int = GENERATED, seed: int = 13) -> list[bytes]:
    """Strings of 16 to 64 characters drawn from the common alphabets in turn."""
    draw = random.Random(seed)
    return [
        "".join(draw.choices(ALPHABETS[k % len(ALPHABETS)], k=draw.randint(16, 64))).encode()
        for k in range(number)
    ]


def library_words() -> list[bytes]:
    """Words of the names that Python's own library offers, in lower case."""
    names = set(dir(builtins))
    for module in map(importlib.import_module, NAME_MODULES):
        names.update(dir(module))
        for one in [o for o in vars(module).values() if isinstance(o, type)]:
            names.update(dir(one))
    parts = {w.lower() for name in names for w in re.findall("[A-Z]?[a-z]+|[A-Z]+", name)}
    return sorted(w.encode() for w in parts if len(w) > 2)


def composed(words: list[bytes], number: int = GENERATED, seed: int = 17) -> list[bytes]:
    """Names as programs have them, of two to four of the words."""
    plain = [w.lower() for w in words if w.isalpha()]
    if not plain:
        return []
    draw, out = random.Random(seed), []
    for k in range(number):
        own = draw.choices(plain, k=draw.randint(2, 4))
        joined = (
            b"_".join(own), b"-".join(own), b"/".join(own), b"_".join(own).upper(),
            own[0] + b"".join(w.capitalize() for w in own[1:]), b"".join(w.capitalize() for w in own),
        )[k % 6]
        out.append(joined[:LONGEST_SAMPLE] + (b"%d" % draw.randint(1, 2030) if k % 7 == 0 else b""))
    return out


def labelled_samples(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(value, random): labelled strings of the corpus, SAMPLE of each class at most.

    Random are the values that base patterns find in any document; ordinary are the other
    runs of six token characters or more, of the SAMPLE_DOCUMENTS documents whose keys and
    texts have the smallest hashes.  Of both, the distinct strings with the smallest hashes
    are taken, up to LONGEST_SAMPLE characters long.
    """
    whole = F.col(f"`{text}`")

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: set[bytes] = set()
            for own in _texts(batch.column(0)):
                found.update(own[a:b] for a, b in _values(own))
            yield _strings(found)

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = set()
            for own in _texts(batch.column(0)):
                taken = [(a, b) for _, a, b in base_spans(own)]
                found.update(m[0] for m in _WORD.finditer(own) if not _meets(taken, m.start(), m.end()))
            yield _strings(found)

    def smallest(strings: DataFrame, label: int) -> DataFrame:
        able = strings.filter(F.length("value") <= LONGEST_SAMPLE).distinct()
        return (
            able.orderBy(F.xxhash64("value", F.lit(label)), "value").limit(SAMPLE)
            .withColumn("random", F.lit(label))
        )

    # Only hashes are ordered; the texts themselves never travel.  Repeated rows have one hash
    # and add no strings.
    order = F.xxhash64(F.col(f"`{key}`"), whole)
    least = documents.select(order.alias("order")).orderBy("order").limit(SAMPLE_DOCUMENTS)
    bound = least.agg(F.max("order")).first()[0]
    picked = documents.filter(order <= F.lit(bound).cast("bigint"))
    drawn = documents.select(whole).mapInArrow(values, "value string")
    return smallest(drawn, 1).union(smallest(picked.select(whole).mapInArrow(others, "value string"), 0))


def train(samples: DataFrame) -> RandomOrName:
    """The models from labelled samples (value, random 0/1), at most SAMPLE of each class.

    Strings drawn from common alphabets join the random class, and names composed of the
    ordinary words and of those of Python's library join the other, so that both hold what
    the corpus lacks.  Rows with a null, or with other characters than those of tokens, are
    left out.
    """
    able = samples.filter("value RLIKE '^[A-Za-z0-9+/_=-]+$' AND random IN (0, 1)").select("value", "random")
    rows = sorted((r[0].encode(), r[1]) for r in able.limit(2 * SAMPLE).collect())
    drawn = [value for value, label in rows if label == 1]
    ordinary = [value for value, label in rows if label == 0]
    words = library_words()
    ordinary += words + composed(ordinary) + composed(words, seed=19)
    return fit(drawn + generated(), ordinary)


# --- scanning --------------------------------------------------------------------------


def _texts(column: pa.Array) -> Iterator[bytes]:
    data, offsets = t.utf8(column)
    whole, ends = data.tobytes(), offsets.tolist()
    for start, end in zip(ends, ends[1:]):
        yield whole[start:end]


def _strings(found: set[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([s.decode() for s in sorted(found)], pa.string())], ["value"])


def _assignments(text: bytes) -> Iterator[re.Match]:
    # Most texts hold none of the names; looking for those is quicker than the pattern.
    low = text.lower()
    if any(name in low for name in (b"passw", b"secret", b"token", b"apikey", b"api_key")):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= LEAST_VALUE:
                yield m


def base_spans(text: bytes) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base patterns' matches in UTF-8 bytes, in order of start."""
    found = [(0, *m.span()) for m in _assignments(text)]
    found += [(1, *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    found += [(2, *m.span()) for m in _LONG_HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], s[0]))


def _values(text: bytes) -> Iterator[tuple[int, int]]:
    """Where the secret itself stands in each match that is long enough to train on."""
    for m in _assignments(text):
        if len(m[2]) >= LEAST_RUN:
            yield m.span(2)
    for kind, start, end in base_spans(text):
        if kind:
            yield start, end


def _meets(spans: list[tuple[int, int]], start: int, end: int) -> bool:
    return any(a < end and start < b for a, b in spans)


def spans(text: bytes, model: RandomOrName) -> list[tuple[int, int, int, float | None]]:
    """Base spans, and those runs beside them that the models take for random.

    A run of token characters is cut where a base span covers it; what is left of it counts
    if it still has LEAST_RUN characters.
    """
    base = base_spans(text)
    taken = [(a, b) for _, a, b in base]
    runs = []
    for m in _RUN.finditer(text):
        at, end = m.span()
        for a, b in (s for s in taken if s[0] < end and at < s[1]):
            if a - at >= LEAST_RUN:
                runs.append((at, a))
            at = max(at, b)
        if end - at >= LEAST_RUN:
            runs.append((at, end))
    scores = model.scores([text[a:b] for a, b in runs])
    found = [(kind, a, b, None) for kind, a, b in base]
    found += [(3, a, b, float(s)) for (a, b), s in zip(runs, scores) if s > model.threshold]
    return sorted(found, key=lambda s: (s[1], s[0]))


def _in_characters(text: bytes, places: list[int]) -> list[int]:
    """Byte offsets as offsets in code points."""
    if text.isascii():
        return places
    lead = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80
    upto = np.concatenate(([0], np.cumsum(lead)))
    return upto[places].tolist()


_SPANS = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
)


def scan(
    documents: DataFrame, model: RandomOrName, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: its key and ``spans``, in order of start and kind.

    A span has its kind, start and end in code points (end exclusive), and for the kind
    ``random`` the log-likelihood ratio.  A null or empty text has none.  Null and repeated
    keys are kept as they are; other columns are not read; an empty table gives no rows.
    """
    kind = documents.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for own in _texts(batch.column(1)):
                found = spans(own, model)
                places = _in_characters(own, [p for s in found for p in s[1:3]]) if found else []
                rows.append(
                    [{"kind": KINDS[s[0]], "start": a, "end": b, "score": s[3]}
                     for s, a, b in zip(found, places[::2], places[1::2])]
                )
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, _SPANS)], [key, "spans"])

    given = documents.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    return given.mapInArrow(
        run, f"`{key}` {kind}, spans array<struct<kind:string,start:bigint,end:bigint,score:double>>"
    )


def _listed(found: Column) -> Column:
    named = F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.array_join(named, ",")


def report(scanned: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, the digest of the base spans, and all spans as text."""
    of = lambda *kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    return scanned.select(
        F.col(f"`{key}`"),
        *[F.size(of(k)).cast("bigint").alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(_listed(of(*KINDS[:3])), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
    )


def masked(
    documents: DataFrame, model: RandomOrName, text: str = "text", mask: str = "[secret]"
) -> DataFrame:
    """The documents, whole rows, each stretch of spans that touch replaced by ``mask``."""
    names, at = documents.columns, documents.columns.index(text)
    hidden = mask.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(at)
            out = []
            for own, given in zip(_texts(column), column.is_valid().to_pylist()):
                pieces, done = [], 0
                for _, a, b, _ in spans(own, model):
                    if a >= done:
                        pieces += [own[done:a], hidden]
                    done = max(done, b)
                out.append(b"".join([*pieces, own[done:]]).decode() if given else None)
            columns = list(batch.columns)
            columns[at] = pa.array(out, column.type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return documents.select(*[f"`{c}`" for c in names]).mapInArrow(run, documents.schema)
