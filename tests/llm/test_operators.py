"""The training-data operators against brute force, on edge rows and small tables."""

import base64
import hashlib
import io
import random
import re
import zipfile
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from pyspark.sql import functions as F

from starloom.llm import (
    ann, components, html_text, licenses, linear, mixing, near_dup, packing, quality_rules, signals,
    suffix_dedup, textops, warc, weak_quality,
)
from starloom.sources.scratch import Workspace

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint, size int, node string"


def documents(spark, texts, ids=None, sources=None):
    """Documents with two extra columns whose names the operators use themselves."""
    ids = list(range(len(texts))) if ids is None else ids
    sources = ["s"] * len(texts) if sources is None else sources
    rows = [
        (i, x, "en", s, len(x or ""), 7, "n") for i, x, s in zip(ids, texts, sources)
    ]
    return spark.createDataFrame(rows, DOCUMENTS).repartition(3)


def prose(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choices("abcdefghij", k=r.randint(2, 7))) for _ in range(n))


EDGES = [None, "", " \t\n", "word", "Word", "é ü word", "a b", "a  b", "x" * 5000, "tie tie", "tie tie"]


# --- shared text operations ----------------------------------------------------------


def test_words_hashes_and_counts(monkeypatch):
    monkeypatch.setattr(textops, "PIECE_BYTES", 64)
    texts = EDGES + [prose(1, 400), "y" * 500 + " z"]
    data, offsets = textops.utf8(pa.array(texts))
    hashes, counts = textops.word_hashes(data, offsets)
    words = [WORD.findall(x or "") for x in texts]
    assert counts.tolist() == [len(w) for w in words]
    flat = [w for own in words for w in own]
    assert len(hashes) == len(flat)
    assert len(set(hashes.tolist())) == len(set(flat))
    assert len(set(zip(hashes.tolist(), flat))) == len(set(flat))


# --- 1 packing ---------------------------------------------------------------------


def encoder():
    return packing.text_encoder(
        public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, "text"
    )


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    texts = [*EDGES, prose(2, 900), prose(3, 2000), "a <|endoftext|> b"]
    limits = packing.Limits(64, 5, 64)
    got = packing.pack(documents(spark, texts), "doc_id", ["text"], encoder(), limits, True).collect()
    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for i, text in enumerate(texts):
        ids = [*coder.encode(text or "", add_special_tokens=False).ids, 0]
        own = sorted((r for r in got if r.doc_id == i), key=lambda r: r.start)
        assert [x for r in own for x in r.ids] == ids
        assert [r.start for r in own] == np.cumsum([0, *(r.length for r in own)])[:-1].tolist()
        assert all(r.doc_tokens == len(ids) and r.length == len(r.ids) for r in own)
        assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in own)
    for number in {r.sequence_id for r in got}:
        own = sorted((r for r in got if r.sequence_id == number), key=lambda r: r.offset)
        assert [r.offset for r in own] == np.cumsum([0, *(r.length for r in own)])[:-1].tolist()
        assert sum(r.length for r in own) <= 64 and len(own) <= 5


def test_packing_keeps_all_three_limits():
    r = random.Random(4)
    limits = packing.Limits(100, 4, 30)
    packer = packing.Packer(limits, waiting=16)
    total = 0
    for k in range(300):
        n = r.randint(1, 250)
        total += n
        packer.add(k, np.arange(n, dtype=np.uint32), np.array(r.choices([0, 1], [3, 1], k=n)))
    packer.finish()
    assert sum(len(p.ids) for s in packer.done for p in s) == total
    for sequence in packer.done:
        assert sum(len(p.ids) for p in sequence) <= 100
        assert len(sequence) <= 4
        assert sum(p.loss_sum() for p in sequence) <= 30


def test_packing_empty_arrays_and_names(spark):
    empty = documents(spark, [])
    assert packing.pack(empty, "doc_id", ["text"], encoder()).count() == 0
    with pytest.raises(ValueError):
        packing.pack(empty.withColumnRenamed("doc_id", "start"), "start", ["text"], encoder())
    given = spark.createDataFrame([(1, [5, None, 7], [1]), (2, None, None)], "k long, ids array<int>, loss array<int>")
    got = packing.pack(given, "k", ["ids", "loss"], packing.array_encoder("ids", "loss"), with_ids=True).collect()
    assert [(r.k, r.ids, r.loss_tokens) for r in got] == [(1, [5, 0, 7], 1)]


@pytest.mark.parametrize("texts", [["a", "b c", "d e f"] * 4000, [None] * 9000])
def test_sequences_of_short_texts_are_full(spark, texts):
    given = documents(spark, texts)
    limits = packing.Limits(1024, 1024, 1024)
    got = packing.pack(given.coalesce(1), "doc_id", ["text"], encoder(), limits)
    used = got.selectExpr("sum(length) AS n", "count(DISTINCT sequence_id) AS m").first()
    assert used["n"] / 1024 > 0.99 * (used["m"] - 1)


# --- 2 licences --------------------------------------------------------------------


def test_licenses(spark):
    texts = [prose(k, 60) + "\n" + prose(k + 100, 9) for k in range(60)]
    texts += [None, "", "All rights reserved.", "x\nReleased under the MIT License.\n" + prose(7, 20)]
    docs = documents(spark, texts)
    got = licenses.scan(docs, licenses.train(docs)).filter("confirmed").collect()
    assert {(r.doc_id, r.paragraph, r.family) for r in got} == {(62, 0, "reserved"), (63, 1, "mit")}
    empty = documents(spark, [])
    assert licenses.scan(empty, licenses.train(empty)).count() == 0


WRAPPED = {
    "bsd": "Redistribution and use in source and binary forms, with or without\n"
    "modification, are permitted provided that the following conditions\nare met:",
    "gpl": " * This program is free software: you can redistribute it and/or modify\n"
    " * it under the terms of the GNU General Public License as published by\n * the Free Software Foundation",
    "apache": "Licensed under the Apache License, Version 2.0 (the \"License\");\n"
    "you may not use this file except in compliance with the License.",
}


def test_wrapped_notices_are_confirmed_line_by_line(spark):
    texts = [prose(k, 60) + "\n" + prose(k + 100, 9) for k in range(60)]
    for notice in WRAPPED.values():
        texts.append(prose(7, 20) + "\n\n" + notice + "\n" + prose(8, 20))
    docs = documents(spark, texts)
    got = licenses.scan(docs, licenses.train(docs)).filter("confirmed").collect()
    expected = {(60 + k, 2 + i, f) for k, (f, x) in enumerate(WRAPPED.items()) for i in range(x.count("\n") + 1)}
    assert {(r.doc_id, r.paragraph, r.family) for r in got} == expected


def test_the_sample_of_none_is_distinct(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(licenses, "fit", lambda negative: taken.append(len({w.tobytes() for w in negative})))
    licenses.train(documents(spark, ["the same line"] * 300 + [prose(k, 9) for k in range(50)]), sample=51)
    licenses.train(documents(spark, []))
    assert taken == [51, 0]


# --- 3 nearest neighbours ----------------------------------------------------------


def test_nearest_neighbours(spark):
    random_ = np.random.default_rng(5)
    vectors = random_.standard_normal((600, 16)).astype(np.float32)
    vectors[100:300] = vectors[7]
    rows = [(k, v.tolist(), "x") for k, v in enumerate(vectors)]
    rows += [(700, None, "x"), (750, [0.0] * 16, "x"), (800, [float("nan")] * 16, "x"), (None, [1.0] * 16, "x"), (850, [1.0, None] * 8, "x")]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, list string").repartition(4)
    got = ann.search(df, every=50, best=5, index=ann.Index(lists=8, probes=8)).collect()
    wide = vectors.astype(float)
    for query in range(0, 600, 50):
        own = sorted((r for r in got if r.query_id == query), key=lambda r: r.rank)
        others = np.array([k for k in range(600) if k != query])
        score = ann.exact_cosine(np.repeat(wide[[query]], len(others), 0), wide[others])
        order = np.lexsort((others, -score))[:5]
        assert [(r.vec_id, r.score) for r in own] == list(zip(others[order].tolist(), score[order].tolist()))
    assert {r.query_id for r in got} == set(range(0, 600, 50))
    assert ann.search(df.limit(0)).count() == 0


def test_recall_on_the_test_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    got = ann.search(df).collect()
    rows = df.select("vec_id", "embedding").collect()
    ids = np.array([r[0] for r in rows])
    units = np.array([r[1] for r in rows], float)
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    found = 0
    for k in np.flatnonzero(ids % 50 == 0):
        near = np.where(ids == ids[k], -9, units @ units[k])
        found += len(set(ids[np.argsort(-near)[:5]]) & {r.vec_id for r in got if r.query_id == ids[k]})
    assert found / (5 * (ids % 50 == 0).sum()) >= 0.9


# --- 4 and 10 quality --------------------------------------------------------------


def brute_signs(text):
    words = WORD.findall(text or "")
    grams = Counter(zip(words, words[1:], words[2:]))
    covered = [False] * len(words)
    for k in range(len(words) - 2):
        if grams[tuple(words[k : k + 3])] > 1:
            covered[k] = covered[k + 1] = covered[k + 2] = True
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, sum(covered)


def test_signs_equal_brute_force():
    texts = [*EDGES, "a b c a b c d", "l\nl\n\nm\nl", "# $x é|", prose(3, 200) + "\n" + prose(3, 200)]
    got = list(signals.signs(pa.array(texts)))
    assert [(s.n_words, s.word_chars, s.n_symbols, s.n_dup_lines, s.n_repeat_words) for s in got] == [
        brute_signs(x) for x in texts
    ]


def test_quality_rules_on_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = quality_rules.train(docs, labels.filter("doc_id % 2 = 0"))
    got = quality_rules.judge(docs, model).filter("NOT base_failed").join(labels, "doc_id").filter("doc_id % 2 = 1")
    right = got.filter((F.col("quality") == 1) == F.col("kept")).count()
    assert right >= 0.95 * got.count()


def test_quality_edges(spark):
    docs = documents(spark, [*EDGES, prose(1, 80)], ids=[None, *range(len(EDGES))])
    for labels in ([], [(None, 1), (3, None)], [(0, 1), (1, 0), (1, 1)]):
        table = spark.createDataFrame(labels, "doc_id bigint, quality int")
        got = quality_rules.judge(docs, quality_rules.train(docs, table)).collect()
        assert len(got) == len(EDGES) + 1
        assert all(r.base_failed and not r.kept for r in got if r.n_words < 50)
    got = weak_quality.WeakQuality(docs).scored().collect()
    assert len(got) == len(EDGES) + 1 and not any(r.kept for r in got if r.n_words == 0)
    assert weak_quality.WeakQuality(documents(spark, [])).scored().count() == 0


def test_weak_labels_find_junk_without_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = weak_quality.WeakQuality(docs).scored().join(labels, "doc_id").collect()
    assert sum((r.quality == 1) == r.kept for r in got) >= 0.93 * len(got)


@pytest.mark.parametrize("n, junk", [(20_000, 0.4), (20_000, 0.6), (200_000, 0.05), (200_000, 0.6)])
def test_labellers_of_known_accuracy_are_recovered(n, junk):
    draw = np.random.default_rng(int(n * junk))
    good = draw.random(n) > junk
    hits, alarms = np.linspace(0.95, 0.3, weak_quality.LABELLERS), np.full(weak_quality.LABELLERS, 0.02)
    cast = draw.random((n, weak_quality.LABELLERS)) < np.where(good[:, None], alarms, hits)
    patterns = [weak_quality.pattern(tuple(v)) for v in np.where(cast, weak_quality.JUNK, 0).tolist()]
    posterior, table = weak_quality.estimate(Counter(patterns))
    assert np.abs(table[0, :, weak_quality.JUNK] - hits).max() < 0.03
    assert np.abs(table[1, :, weak_quality.JUNK] - alarms).max() < 0.03
    judged = np.array([posterior[p] >= 0.5 for p in patterns])
    assert (judged == good).mean() > 0.99


def test_good_documents_are_whole_rows(spark):
    texts = [prose(k, 300) for k in range(30)] + ["$$$ ### " * 60, None, "", "%%% &&&& " * 80]
    given = spark.createDataFrame(
        [(k, x, "p", k) for k, x in enumerate(texts)], "doc_id long, text string, probability string, kept long"
    )
    got = weak_quality.WeakQuality(given).good()
    assert got.schema == given.schema
    kept = {r["doc_id"]: tuple(r) for r in got.collect()}
    assert kept and all(kept[k] == (k, texts[k], "p", k) for k in kept)
    scored = weak_quality.WeakQuality(given).scored().filter("kept").select("doc_id").collect()
    assert {r[0] for r in scored} == set(kept) and not {31, 32} & set(kept)


# --- 5 mixing ----------------------------------------------------------------------


def brute_targets(sizes):
    """Sources in code point order, null last; the excess is shared until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-32-be"))
    names += [None] * (None in sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    total, capped = 1.5 * sum(sizes.values()), set()
    while True:
        rest = total - sum(2 * sizes[s] for s in capped)
        level = rest / max(sum(weight[s] for s in names if s not in capped), 1)
        over = {s for s in names if s not in capped and level * weight[s] > 2 * sizes[s]}
        if not over:
            return {s: 2 * sizes[s] if s in capped else level * weight[s] for s in names}
        capped |= over


def test_mixing_targets_and_takes(spark):
    texts = [*EDGES, *[prose(k, 40 * k + 1) for k in range(30)]]
    sources = [[None, "b", "a", "é", "z", "Z"][k % 6] for k in range(len(texts))]
    docs = documents(spark, texts, sources=sources)
    got = mixing.Mix(docs, block=16).taken().collect()
    size = {k: len(WORD.findall(x or "")) for k, x in enumerate(texts)}
    totals = Counter()
    for k, s in enumerate(sources):
        totals[s] += size[k]
    want = brute_targets(dict(totals))
    assert len(got) == len(texts)
    taken = Counter()
    for r in got:
        s = sources[r.doc_id]
        assert (r.size, r.source_size) == (size[r.doc_id], totals[s])
        assert r.target == pytest.approx(want[s]) and 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
    assert all(abs(taken[s] - want[s]) <= 1 for s in want)
    again = mixing.Mix(docs, block=16).taken().collect()
    assert sum(r.taken for r in again) == sum(r.taken for r in got)
    assert mixing.Mix(documents(spark, [])).taken().count() == 0


def test_shards_hold_the_taken_words_as_drawn(spark):
    texts = [prose(k, 400) for k in range(60)] + [None, "", "one"]
    given = documents(spark, texts, sources=[f"s{k % 3}" for k in range(len(texts))])
    mix = mixing.Mix(given, block=8, shard_slots=256)
    rows = mix.taken().collect()
    assert all(sum(r.shard_words.values()) == r.taken for r in rows)
    by_shard = Counter()
    for r in rows:
        by_shard.update(r.shard_words)
    slots = Counter(r.shard for r in mix.slots().collect())
    n, shards = sum(slots.values()), max(slots) + 1
    assert set(by_shard) == set(slots) and shards == -(-n // 256) > 8
    # Each slot is drawn alone: counts vary as those of a multinomial do, no more, no less.
    chi = sum((slots[k] - n / shards) ** 2 / (n / shards) for k in range(shards))
    assert 0.2 * (shards - 1) < chi < 3 * (shards - 1)


def test_a_text_is_split_once_for_all_its_runs(spark):
    given = documents(spark, [" ".join(f"w{k}" for k in range(3000)), prose(1, 500)], sources=["a", "b"])
    mix = mixing.Mix(given, block=4, keep=tuple(given.columns))
    got = mix.mixed()
    text = got._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("regexp_extract_all") == 1 and "lambda" in text
    taken = {r.doc_id: r.taken for r in mix.taken().collect()}
    words = Counter()
    for r in got.collect():
        words[r.doc_id] += len(WORD.findall(r.text))
    assert dict(words) == {k: n for k, n in taken.items() if n}


def test_permutation_is_a_bijection(spark):
    for n in (1, 2, 7, 100):
        df = spark.range(n).select(
            "id", mixing.permuted(F.col("id"), F.lit(99), F.lit(n).cast("bigint")).alias("to")
        )
        df = df.withColumn("back", mixing.permuted(F.col("to"), F.lit(99), F.lit(n).cast("bigint"), True))
        rows = df.collect()
        assert sorted(r.to for r in rows) == list(range(n)) and all(r.back == r.id for r in rows)


def test_mixed_texts_hold_the_taken_words(spark):
    texts = [" lead  two\tspaces\n", *[prose(k, 90) for k in range(6)]]
    docs = documents(spark, texts, sources=list("aabbccc"))
    mix = mixing.Mix(docs, block=16, keep=tuple(docs.columns))
    taken = {r.doc_id: r.taken for r in mix.taken().collect()}
    words = Counter()
    for r in mix.mixed().collect():
        own = WORD.findall(r.text)
        assert " ".join(own) in " ".join(WORD.findall(texts[r.doc_id]))
        words[r.doc_id] += len(own)
    assert {k: v for k, v in taken.items() if v} == dict(words)


# --- 6 archives --------------------------------------------------------------------


def test_archives_round_trip(spark):
    html = ["<p>a</p>", None, "", "<p>a</p>", "é" * 3000, "<p>a</p>"]
    ids = [9, 1, 4, 3, 5, None]
    urls = ["http://x/é a", None, "u\nv", "", "http://y", "z"]
    pages = spark.createDataFrame(list(zip(ids, urls, html, ["k"] * 6)), "page_id bigint, url string, html string, row string").repartition(3)
    got = {(r.page_id): r for r in warc.archive_pages(pages, with_payload=True).collect()}
    first = {}
    for i, h in sorted(((i, h or "") for i, h in zip(ids, html)), key=lambda x: (x[0] is None, x[0])):
        first.setdefault(h, i)
    for i, h in zip(ids, html):
        r, payload = got[i], (h or "").encode()
        assert r.payload_bytes == len(payload)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        response = first[h or ""] == i
        assert r.record_type == ("response" if response else "revisit")
        assert r.refers_to == (None if response else first[h or ""])
        assert r.payload == (payload if response else None)
    assert warc.archive_pages(pages.limit(0)).count() == 0


def test_zip64_directories(monkeypatch):
    for name, value in (("ZIP64_LIMIT", 40), ("ZIP_FILECOUNT_LIMIT", 1)):
        monkeypatch.setattr(zipfile, name, value)
    for comment in (b"", b"PK\x05\x06 comment"):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as archive:
            for k in range(4):
                archive.writestr(f"m{k}", b"%d" % k * (30 + 20 * k))
            archive.comment = comment
        data = out.getvalue()
        assert b"PK\x06\x06" in data

        class Ranges:
            def read_at(self, n, at):
                return data[at : at + n]

        members = warc.central_directory(Ranges(), len(data))
        assert [m["name"] for m in members] == ["m0", "m1", "m2", "m3"]
        for k, m in enumerate(members):
            at = warc.data_start(Ranges(), m)
            assert data[at : at + m["size"]] == b"%d" % k * (30 + 20 * k)


# --- 7 near-duplicates -------------------------------------------------------------


def brute_components(texts, words, percent):
    low = {k: k + 32 for k in range(65, 91)}
    sets = []
    for x in texts:
        w = WORD.findall((x or "").translate(low))
        n = min(words, len(w))
        sets.append({tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if w else set())
    label = list(range(len(texts)))
    for _ in texts:
        for a in range(len(texts)):
            for b in range(a):
                both = len(sets[a] & sets[b])
                if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    label[a] = label[b] = min(label[a], label[b])
    return sets, label


def variants(seed, copies, changes):
    r = random.Random(seed)
    base = prose(seed, 100).split()
    out = []
    for _ in range(copies):
        own = list(base)
        for _ in range(changes):
            own[r.randrange(len(own))] = "".join(r.choices("klmnop", k=6))
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("small_key", [16, 2])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, small_key):
    monkeypatch.setattr(near_dup, "SMALL_KEY", small_key)
    monkeypatch.setattr(near_dup, "BLOCK_NODES", 8)
    texts = [*EDGES, *variants(1, 12, 3), *variants(2, 25, 5), *[prose(k, 50) for k in range(10)]]
    texts += [texts[12].upper(), texts[12]]
    got = near_dup.NearDuplicates(documents(spark, texts), shape=near_dup.Shape(words=2)).membership().collect()
    sets, label = brute_components(texts, 2, 80)
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got} == {
        (k, len(sets[k]), label[k], label[k] == k) for k in range(len(texts))
    }


def test_survivors_and_edges(spark):
    texts = ["same text here now and then", "same text here now and then", None, None, "other words"]
    docs = documents(spark, texts, ids=[5, 3, None, 4, 3])
    docs = docs.union(docs.filter("doc_id = 3"))
    got = near_dup.NearDuplicates(docs).survivors().collect()
    assert sorted((r.doc_id or -1, r.text or "") for r in got) == sorted(
        [(3, "same text here now and then"), (-1, ""), (4, ""), (3, "other words")]
    )
    assert got[0].asDict().keys() == set(docs.columns)
    assert near_dup.NearDuplicates(documents(spark, [])).membership().count() == 0


def test_survivors_keep_columns_of_any_name(spark):
    names = ["_t1", "_t2", "_nth", "_once", "_k1", "k1", "row", "nth", "doc", "c1", "a.b"]
    text = " ".join(f"w{k}" for k in range(50))
    rows = [(k, text if k < 3 else f"{text} {k} " * k, *[f"{n}{k}" for n in names]) for k in range(6)]
    ddl = "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names)
    given = spark.createDataFrame(rows, ddl)
    got = near_dup.NearDuplicates(given).survivors()
    assert got.columns == given.columns
    kept = {r["doc_id"]: tuple(r) for r in got.collect()}
    assert 0 in kept and not {1, 2} & set(kept) and all(kept[k] == rows[k] for k in kept)


def test_signature_distance_is_guaranteed():
    shape, r = near_dup.Shape(), np.random.default_rng(1)
    a = r.integers(0, 1 << 16, (200, shape.values))
    b = a.copy()
    for row in b:
        row[r.choice(shape.values, shape.guaranteed, replace=False)] += 1
    assert (near_dup.first_shared(a, b, shape) >= 0).all()


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(30)] + [(100, k) for k in range(101, 120)] + [(200, 200)]
    got = components.components(spark.createDataFrame(links, "a bigint, b bigint"), Workspace(spark, "t"), "x")
    label = {r.node: r.component for r in got.collect()}
    assert all(label[k] == 0 for k in range(31)) and all(label[k] == 100 for k in range(100, 120))


# --- 8 repeated bytes --------------------------------------------------------------


@pytest.mark.parametrize("piece, hot", [(1 << 20, 5000), (300, 0)])
def test_repeated_bytes_equal_brute_force(spark, monkeypatch, piece, hot):
    monkeypatch.setattr(textops, "PIECE_BYTES", piece)
    monkeypatch.setattr(suffix_dedup, "HOT_BUCKET", hot)
    monkeypatch.setattr(suffix_dedup, "BATCH_BYTES", 1000)
    shared, r = [prose(k, 30) for k in range(3)], random.Random(3)
    texts = [*EDGES, "ab" * 300, prose(8, 300), prose(8, 300)]
    for k in range(20):
        cut = r.randrange(50)
        texts.append(prose(50 + k, 20) + shared[k % 3][cut : 140 + cut] + prose(90 + k, 15) + "é" * (k % 3))
    length = 60
    got = suffix_dedup.RepeatedBytes(documents(spark, texts), length=length, gram=20).report().collect()
    data = [(x or "").encode() for x in texts]
    count = Counter(d[k : k + length] for d in data for k in range(len(d) - length + 1))
    expected = set()
    for i, d in enumerate(data):
        cover = np.zeros(len(d) + 1, bool)
        for k in range(len(d) - length + 1):
            if count[d[k : k + length]] > 1:
                cover[k : k + length] = True
        cover = cover[: len(d)]
        kept = bytes(np.frombuffer(d, np.uint8)[~cover])
        spans = int((np.diff(np.concatenate(([0], cover.astype(int)))) == 1).sum())
        expected.add((i, len(d), int(cover.sum()), spans, hashlib.sha256(kept).hexdigest()))
    assert {tuple(r) for r in got} == expected


@pytest.mark.parametrize("often", [0, 3, 5000])
def test_large_buckets_never_meet_in_one_task(spark, monkeypatch, often):
    """A passage that all documents share, each with other text before and after it."""
    length, bound, refined = 60, 3000, suffix_dedup.refined_spans

    def bounded(dealt, *more):
        sizes = dealt.groupBy("bucket").agg(F.sum(F.length("content")).alias("size"))
        assert sizes.filter(F.col("size") > bound).isEmpty()
        return refined(dealt, *more)

    monkeypatch.setattr(suffix_dedup, "refined_spans", bounded)
    monkeypatch.setattr(suffix_dedup, "HOT_BUCKET", often)
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", bound, raising=False)
    shared, other = prose(1, 20), prose(2, 16)
    texts = [prose(50 + k, 5) + shared[: 90 - k % 4] + prose(150 + k, 5 + k % 3) for k in range(80)]
    texts += [prose(300 + k, 15) + other + prose(310 + k, 15) for k in range(3)] + ["", None]
    got = suffix_dedup.RepeatedBytes(documents(spark, texts), length=length, gram=20).report().collect()
    data = [(x or "").encode() for x in texts]
    count = Counter(d[k : k + length] for d in data for k in range(len(d) - length + 1))
    for r in got:
        d = data[r.doc_id]
        gone = {k + i for k in range(len(d) - length + 1) if count[d[k : k + length]] > 1 for i in range(length)}
        kept = bytes(b for k, b in enumerate(d) if k not in gone)
        assert (r.n_removed, r.kept_sha256) == (len(gone), hashlib.sha256(kept).hexdigest())
    assert len(got) == len(texts) and sum(r.n_removed for r in got) > 80 * length


def test_cleaned_documents_keep_their_columns(spark):
    docs = documents(spark, [prose(1, 80), "x " + prose(1, 80), None], ids=[1, None, 2])
    got = suffix_dedup.RepeatedBytes(docs).cleaned().collect()
    assert {(r.doc_id, r.text) for r in got} == {(1, ""), (None, "x "), (2, None)}
    assert got[0].asDict().keys() == set(docs.columns)
    assert suffix_dedup.RepeatedBytes(documents(spark, [])).report().count() == 0


# --- 9 main text -------------------------------------------------------------------

PAGE = """<html><head><title>t</title><script>x='<p>no</p>'</script></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></ul></nav>
<div class="cookie-notice">We use cookies</div><div class="wrap"><div class="%s">
<h1>Title &amp; more</h1><p>First <b>bold</b>&nbsp;text<br>goes on, long enough to count as running text.
<p>Second paragraph, with an <a href="#">inline link</a> in its middle and more words.</p>
<div class="ad">Buy now</div><ul><li>one item<li>two items</ul>
<div id="comments"><p>A reader's comment that is long and rambling and not part of it.</p></div>
</div><aside>Side</aside></div><form><p>Search</p></form><footer>Foot</footer></body></html>"""
TEXT = (
    "Title & more\nFirst bold text goes on, long enough to count as running text.\n"
    "Second paragraph, with an inline link in its middle and more words.\none item\ntwo items"
)


def test_main_text(spark):
    pages = [(k, "http://h.example/%d" % k, PAGE % f"post-{k}", "w") for k in range(4)]
    pages += [(5, None, None, "w"), (6, "http://h.example/", "", "w"), (7, "x", "<nav>menu</nav>", "w"),
              (8, "http://h.example/b", "<p>unclosed <i>text", "w"), (None, "http://H.example:80/c", PAGE % "post", "w")]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string, host string").repartition(2)
    got = {r.page_id: r for r in html_text.extract(df).collect()}
    assert all(got[k].text == TEXT for k in (0, 1, 2, 3, None))
    assert all(got[k].text == "" and got[k].n_chars == 0 for k in (5, 6, 7))
    assert got[8].text == "unclosed text" and got[0].n_chars == len(TEXT)
    assert html_text.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize(
    "name", ["overflow-hidden", "content with-sidebar", "no-sidebar", "hasSidebar", "social-studies", "post-alert",
             "social", "notice"],
)
def test_side_words_in_layout_names_keep_the_text(name):
    lead, body = "A lead of the article, a whole sentence.", prose(4, 60)
    for outer in ("article", "div"):
        inner = f"<p>{lead}</p><p>{body}</p><div class='share-buttons'>Tell all</div><div id=comments>{prose(5, 400)}</div>"
        page = f"<body><{outer}><div class='{name}'>{inner}</div></{outer}></body>"
        assert html_text.Page(page).text([]) == f"{lead}\n{body}"


@pytest.mark.parametrize(
    "inner",
    [
        '<span style="display:none">SECRET</span>', '<span class="ad">Buy now</span>',
        '<span class="share">x</span>', '<b aria-hidden="true">x</b>', "<a hidden>x</a>",
        '<span class="ad">Buy <i>now <span class="share">y</span></i></span>',
        '<script>var x = "<p>text</p>";</script>', "<style>p {}</style>", "<noscript>Turn it on</noscript>",
        '<button type="button">Go</button>', "<select><option>one</option></select>",
        '<svg class="i"><path d="M0"/></svg>',
    ],
)
def test_side_elements_within_a_line_leave_it_whole(inner):
    page = html_text.Page(f"<html><body><article><p>Hello there {inner} world of text.</p><p>Next.</p></article>")
    assert [b[1] for b in page.blocks] == ["Hello there world of text.", "Next."]


@pytest.mark.parametrize("name", ['id="google_ads_1"', 'class="advertisement-block"', 'class="top-ads"'])
def test_adverts_with_compound_names_go(name):
    page = html_text.Page(f"<body><p>Hello there, this is text.</p><div {name}>Buy this</div><p>More of it.</p>")
    assert [b[1] for b in page.blocks] == ["Hello there, this is text.", "More of it."]


def test_an_unclosed_side_ends_with_its_block():
    page = html_text.Page('<body><p>Hello <span class="ad">Buy <i>now</i></p><p>Next one</p>')
    assert [b[1] for b in page.blocks] == ["Hello", "Next one"]


def test_side_names_still_name_sides():
    for name in ("ad", "ad-slot-3", "cookie-notice", "article-comments", "leftSidebar", "site-header", "hidden"):
        page = f"<body><div class=x><p>{prose(4, 60)}</p><div class='{name}'>Not of it</div></div></body>"
        assert html_text.Page(page).text([]) == prose(4, 60)
    for outer in ("article", "div class=post"):
        short = f"<body><div class=ad>{prose(3, 30)}</div><{outer}><h1>One word</h1></{outer.split()[0]}></body>"
        assert html_text.Page(short).text([]) == "One word"
    # Of a page with nothing but sides, the texts come back.
    only = f"<body><div class=ad>{prose(1, 9)}</div><div class=promo>{prose(2, 9)}</div><nav>menu</nav></body>"
    assert html_text.Page(only).text([]) == f"{prose(1, 9)}\n{prose(2, 9)}"


def test_a_winning_path_leaves_out_no_part_of_the_article():
    teaser, rest = prose(1, 40), prose(2, 70)
    page = f"<body><div class=wrap><div class=story><p>{teaser}</p></div><div class=more><p>{rest}</p></div></div></body>"
    assert html_text.Page(page).text(["div.wrap>div.story"]) == f"{teaser}\n{rest}"
    # What leaves out little still wins over a container that is too wide.
    wide = f"<body><div class=wrap><div class=a1><p>{prose(3, 300)}</p></div><div class=x><p>{prose(4, 24)}</p></div></div></body>"
    assert html_text.Page(wide).text([]) == f"{prose(3, 300)}\n{prose(4, 24)}"
    assert html_text.Page(wide).text(["div.wrap>div.a#"]) == prose(3, 300)


@pytest.mark.parametrize("outer, inner", [("post", "entry"), ("c12", "entry"), ("c12", "c13"), ("post", "c13")])
def test_titles_and_leads_stay_however_long_the_text(outer, inner):
    pages = []
    for k, words in enumerate((12, 40, 900)):
        lead = "A lead of the story, which is one whole sentence."
        body = f"{prose(k, words)}\n{prose(k + 9, 2)}\n{prose(k + 20, words)}"
        inside = "<p>%s</p><h2>%s</h2><p>%s</p>" % tuple(body.split("\n"))
        page = f"<body><div id=top><a href=/>Site</a></div><div class={outer}><h1>Title</h1><p>{lead}</p><div class={inner}>{inside}</div></div></body>"
        pages.append((html_text.Page(page), f"Title\n{lead}\n{body}"))
    ranked = Counter()
    for page, _ in pages:
        ranked.update(dict(page.votes()))
    for page, text in pages:
        assert page.text([path for path, _ in ranked.most_common(3)]) == text
        assert page.text([f"div.{outer}>div.{inner}"]) == text


def test_calibration_gives_shares():
    r = np.random.default_rng(2)
    scores = r.standard_normal(4000) * 3
    labels = (r.random(4000) < linear.sigmoid(0.5 * scores - 1)).astype(float)
    slope, shift = linear.calibrate(scores, labels, np.ones(4000))
    assert slope == pytest.approx(0.5, abs=0.1) and shift == pytest.approx(-1, abs=0.15)
