"""Collocations against a plain count of all phrases."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from casebook.llm import collocations as co


def docs(seed: int):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(40)] + ["é", "ÜBER", "The", "a-b", "x\x00y", "日本"]
    fixed = ["new york city council", "per se", "The Quick Brown fox", "a a a a a", "deep in the woods of"]
    rows = []
    for k in range(120):
        out = []
        for _ in range(rng.randrange(0, 60)):
            out.append(rng.choice(fixed) if rng.random() < 0.3 else words[min(int(rng.expovariate(0.15)), len(words) - 1)])
            out.append(rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "! ?", "\r\n", "\x0b", " "]))
        rows.append((k, "".join(out), rng.choice(["en", "en", "de", None, "und"])))
    return rows + [(200, None, "en"), (201, "", "de"), (202, " \n. ", "fr"), (203, "hot pair here " * 900, "en"), (204, "hot pair there " * 400, "en"), (3, rows[3][1], "en")]


def plain(rows, min_count, longest, share, top):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    found = {g: c for g, c in f.items() if len(g[1]) > 1 and c >= min_count}
    dropped = set()
    for (lang, g), c in found.items():
        for m in range(2, len(g)):
            for i in range(len(g) - m + 1):
                if 100 * c >= share * f[lang, g[i : i + m]]:
                    dropped.add((lang, g[i : i + m]))
    rows = []
    for (lang, g), a in found.items():
        if (lang, g) not in dropped:
            cuts = [(2000000 * a // (f[lang, g[:k]] + f[lang, g[k:]]), k, f[lang, g[:k]], f[lang, g[k:]]) for k in range(1, len(g))]
            s, _, l, r = min(cuts)
            rows.append((lang, -s, -a, " ".join(g).encode(), a, l, r, n[lang], s))
    out, place = [], Counter()
    for lang, _, _, g, *rest in sorted(rows):
        place[lang] += 1
        if place[lang] <= top:
            out.append((lang, place[lang], g.decode(), *rest))
    return sorted(out)


def mined(spark, rows, **more):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for c in ("n", "phrase", "bucket", "word", "id", "score", "a"):
        df = df.withColumn(c, F.lit("own"))
    return sorted(tuple(r) for r in co.collocations(df.repartition(4), **more).collect())


@pytest.mark.parametrize(
    ("seed", "more"),
    [
        (1, {}),
        (2, {"min_count": 5, "bucket_rows": 40, "filter_bits": 1 << 15, "top": 30}),  # nearly every pair is hot
        (3, {"min_count": 3, "longest": 5, "share": 60, "bucket_rows": 900}),
        (4, {"min_count": 4, "longest": 2}),
    ],
)
def test_equals_plain_count(spark, seed, more):
    rows = docs(seed)
    got = mined(spark, rows, **more)
    assert got and got == plain(rows, more.get("min_count", 30), more.get("longest", 4), more.get("share", 80), more.get("top", 2000))


def test_small_chunks(spark, monkeypatch):
    monkeypatch.setattr(co, "CHUNK", 300)  # in this process: the chunks of a batch
    import pyarrow as pa

    rows = docs(7)
    batch = pa.RecordBatch.from_pydict({"lang": pa.array([x[2] or "und" for x in rows]), "text": pa.array([x[1] or "" for x in rows])})
    parts = list(co._chunks(batch))
    assert len(parts) > 20
    assert sorted((lang, t) for lang, a in parts for t in a.to_pylist()) == sorted((x[2] or "und", x[1] or "") for x in rows)


@pytest.mark.parametrize("parts", [False, True])
def test_quicksort_counts_prefixes(parts):
    rng = np.random.default_rng(5)
    words = rng.integers(-3, 4, (3000, 4))
    words[words == 0] = 7
    length = rng.integers(2, 5, 3000)
    words[np.arange(4)[None, :] >= length[:, None]] = 0
    n = rng.integers(1, 4, 3000)
    want = Counter()
    for w, c in zip(words.tolist(), n.tolist()):
        for d in range(2, 5):
            if w[d - 1] != 0:
                want[tuple(w[:d])] += c
    want = {k: c for k, c in want.items() if c >= 40 or parts and len(k) < 4}
    got = {tuple(p): int(c) for ps, cs in co.multikey_quicksort(words, n, 40, parts) for p, c in zip(ps.tolist(), cs)}
    assert got == want


def test_filter_never_loses_a_pair(spark):
    rng = np.random.default_rng(6)
    pairs = rng.integers(-(2**63), 2**63 - 1, (5000, 2))
    df = spark.createDataFrame([tuple(map(int, p)) for p in pairs[:4000]], "w1 long, w2 long")
    for bits in (1 << 15, 1 << 20):
        f = co.PairFilter(df, bits)
        assert f.holds(pairs[:4000, 0].copy(), pairs[:4000, 1].copy()).all()
    assert f.holds(pairs[4000:, 0].copy(), pairs[4000:, 1].copy()).mean() < 0.05


def test_no_candidates(spark):
    assert mined(spark, [(1, "one two three", "en"), (2, None, None)]) == []
    df = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert co.collocations(df).collect() == []


def test_chunks_bound_a_task():
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"lang": pa.array(["en"] * 600), "text": pa.array(["word " * 2000] * 600)})
    parts = [a for _, a in co._chunks(batch)]
    assert sum(map(len, parts)) == 600 and max(a.nbytes for a in map(pa.concat_arrays, ([a] for a in parts))) < 3 << 20
