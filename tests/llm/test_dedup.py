"""Exact, line, byte-string and near-duplicate removal against brute force."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from casebook.llm import exact_dedup, jaccard_join, line_dedup, suffix_dedup
from casebook.llm.components import components
from tests.llm.cases import corpus, frame, jaccard_components, shingle_set


def sha(x) -> str:
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def low(i):
    return -(1 << 63) if i is None else i


def test_exact(spark, tmp_path):
    rows = corpus()
    half = len(rows) // 2
    path = str(tmp_path / "docs")
    frame(spark, rows[:half]).coalesce(1).write.parquet(path)
    frame(spark, rows[half:]).coalesce(1).write.mode("append").parquet(path)
    got = exact_dedup.deduplicate(spark, path, files_per_batch=1).collect()
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    want = [(i, max(groups[t or ""], key=low), len(groups[t or ""]), sha(t or "")) for i, t in rows]
    assert Counter(want) == Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got)
    assert Counter(r.text_sha256 for r in got if r.kept) == Counter(map(sha, groups))
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_state_goes_on(spark, tmp_path):
    path, state = str(tmp_path / "docs"), str(tmp_path / "state")
    spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string").coalesce(1).write.parquet(path)
    exact_dedup.update_state(spark, path, state)
    spark.createDataFrame([(7, "a")], "doc_id long, text string").coalesce(1).write.mode("append").parquet(path)
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.deduplicate(spark, path, state=state).collect()}
    assert got == {1: (7, 2, False), 2: (2, 1, True), 7: (7, 2, True)}


def test_exact_collision_is_split(spark, tmp_path, monkeypatch):
    """Under a weak digest, full bytes decide."""
    path = str(tmp_path / "docs")
    spark.createDataFrame([(1, "ab"), (2, "cd"), (3, "ab"), (4, "xyz")], "doc_id long, text string").write.parquet(path)
    real = exact_dedup._digested

    def weak(df):
        from pyspark.sql import functions as F

        return real(df).withColumn("digest", F.length("text").cast("string").cast("binary"))

    monkeypatch.setattr(exact_dedup, "_digested", weak)
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.deduplicate(spark, path).collect()}
    assert got == {1: (3, 2, False), 2: (2, 1, True), 3: (3, 2, True), 4: (4, 1, True)}


def brute_lines(rows, least):
    docs = sorted({(low(i), t or "") for i, t in rows})
    first, runs = {}, defaultdict(list)
    for d, (i, t) in enumerate(docs):
        lines = t.split("\n")
        words = [x.count(" ") + 1 if x.strip(" ") else 0 for x in lines]
        for a in range(len(lines)):
            total = 0
            for b in range(a, min(len(lines), a + 60)):
                total += words[b]
                if total >= least:
                    run = tuple(lines[a : b + 1])
                    runs[d].append((a, b, run))
                    first.setdefault(run, (d, a))
    out = {}
    for d, (i, t) in enumerate(docs):
        lines = t.split("\n")
        gone = {k for a, b, run in runs[d] if first[run] != (d, a) for k in range(a, b + 1)}
        out[i, t] = len(lines), len(gone), "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return out


@pytest.mark.parametrize("least", [1, 8, 30])
def test_lines(spark, least):
    rows = [r for r in corpus(2) if r[0] not in (50, 51, 121)]
    got = line_dedup.dedup_lines(frame(spark, rows), min_words=least)
    assert set(frame(spark, rows).columns) | {"n_removed"} == set(got.columns)
    want = brute_lines(rows, least)
    assert Counter((i, *want[low(i), t or ""]) for i, t in rows) == Counter((r.doc_id, r.n_lines, r.n_removed, r.text) for r in got.collect())


def test_lines_of_long_copies(spark):
    """Runs longer than a power of two, one document inside another, and a document that repeats itself."""
    lines = [f"line {k} of it" for k in range(37)]
    rows = [(1, "\n".join(lines)), (2, "\n".join(["x y z", *lines[3:30], "w"])), (3, "\n".join(["a b"] * 40))]
    got = {r.doc_id: (r.n_removed, r.text) for r in line_dedup.dedup_lines(frame(spark, rows), min_words=9).collect()}
    want = brute_lines(rows, 9)
    assert got == {i: want[i, t][1:] for i, t in rows}
    assert got[2][0] == 27


def brute_bytes(rows, n=100):
    docs = sorted({(low(i), (t or "").encode()) for i, t in rows})
    place = {}
    for i, t in docs:
        for p in range(len(t) - n + 1):
            g = t[p : p + n]
            place[g] = min(place.get(g, (i, p)), (i, p))
    out = {}
    for i, t in docs:
        gone = np.zeros(len(t) + 2, bool)
        for p in range(len(t) - n + 1):
            if place[t[p : p + n]] < (i, p):
                gone[p + 1 : p + n + 1] = True
        out[i, t] = len(t), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum()), sha(bytes(c for c, g in zip(t, gone[1:], strict=False) if not g))
    return out


@pytest.mark.parametrize("small", [False, True])
def test_bytes(spark, monkeypatch, small):
    rows = corpus(3) + [(200, "ab" * 400), (201, "x" * 99), (202, "x" * 100), (203, "x" * 101), (204, "yz" + "ab" * 300)]
    got = suffix_dedup.remove_repeats(frame(spark, rows)).collect()
    want = brute_bytes(rows)
    assert Counter((i, *want[low(i), (t or "").encode()]) for i, t in rows) == Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got)
    assert all(sha(bytes(r.kept)) == r.kept_sha256 for r in got)


def test_bytes_in_pieces(monkeypatch):
    """The task functions with tiny pieces, outputs and blocks."""
    import pyarrow as pa

    for name, value in (("STEP", 700), ("LONGEST", 900), ("EMIT", 2500), ("BLOCK", 3000)):
        monkeypatch.setattr(suffix_dedup, name, value)
    rows = [(i, t) for i, t in corpus(4) if i is not None and i not in (120, 121)]
    t = pa.table({"_id": pa.array([i for i, _ in rows], pa.int64()), "_row": pa.array([0] * len(rows), pa.int64()), "text": [t for _, t in rows]})
    blocks = defaultdict(list)
    for b in suffix_dedup.deal(5)(iter(t.to_batches(max_chunksize=7))):
        for k, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            blocks[k].append(x)
    ranges = defaultdict(list)
    for v in blocks.values():
        for r in suffix_dedup.sort_bucket(pa.table({"block": pa.array(v, pa.binary())})).to_pylist():
            ranges[r["_id"]].append((r["start"], r["stop"]))
    want = brute_bytes(rows)
    for i, t in rows:
        gone = np.zeros(len((t or "").encode()), bool)
        for a, b in ranges[i]:
            gone[a:b] = True
        assert gone.sum() == want[i, (t or "").encode()][1], i


@pytest.mark.parametrize(("words", "percent"), [(3, 90), (5, 80)])
def test_near(spark, words, percent):
    rows = corpus(5)
    got = jaccard_join.near_duplicates(frame(spark, rows), words=words, percent=percent).collect()
    want = jaccard_components(rows, words, percent)
    assert Counter((i, len(shingle_set(t, words)), want[i]) for i, t in rows) == Counter((r.doc_id, r.n_shingles, r.component_id) for r in got)


@pytest.mark.parametrize(("words", "percent"), [(3, 90), (5, 80)])
def test_near_group(spark, words, percent):
    """A group of near copies, copies of copies and common passages, most pairs of which don't link."""
    import random

    from tests.llm.cases import text

    rng = random.Random(words)
    base = text(rng, 150).split(" ")
    made = [base]
    for k in range(130):
        t = list(rng.choice(made) if rng.random() < 0.4 else base)
        for _ in range(rng.randrange(1, 9)):
            t[rng.randrange(len(t))] = rng.choice(["x", "y", f"w{rng.randrange(400)}"])
        if rng.random() < 0.3:
            t = rng.choice(["one common line of several words here", "another line that many documents have"]).split() + t
        if rng.random() < 0.2:
            del t[rng.randrange(len(t)) :][: rng.randrange(1, 20)]
        made.append(t)
    rows = [(k, " ".join(t)) for k, t in enumerate(made)]
    rng.shuffle(rows)
    got = {r.doc_id: r.component_id for r in jaccard_join.near_duplicates(frame(spark, rows), words=words, percent=percent).collect()}
    want = jaccard_components(rows, words, percent)
    assert got == want and 1 < len(set(want.values())) < len(rows)


def test_components(spark):
    chain = [(k + 1, k) for k in range(20)] + [(50, 40), (41, 50), (7, 7), (50, 40)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(1, 21)}, 50: 40, 41: 40}


def test_empty_tables(spark, tmp_path):
    none = frame(spark, [])
    assert line_dedup.dedup_lines(none).count() == 0
    assert suffix_dedup.remove_repeats(none).count() == 0
    assert jaccard_join.near_duplicates(none).count() == 0
    assert jaccard_join.one_of_each(none).count() == 0
    path = str(tmp_path / "none")
    none.write.parquet(path)
    assert exact_dedup.deduplicate(spark, path).count() == 0


@pytest.mark.parametrize(("words", "percent"), [(3, 90), (5, 80)])
def test_near_of_other_sizes(spark, words, percent):
    """Texts with a passage appended or cut off, across size bands, one of each family with many exact copies."""
    import random

    from tests.llm.cases import text

    rng = random.Random(words)
    made = []
    for size in (60, 104, 170, 240, 310):
        for most in (True, False):
            base = text(rng, size).split()
            new = [f"new{rng.randrange(10**9)}" for _ in range(size)]
            family = [base]
            for share in (3, 8, 14, 19):
                k = size * share // 100
                family += [base + new[:k], base[: size - k], new[-k:] + base]
            made += family + [base if most else family[4]] * 35
    rows = [(k, " ".join(t)) for k, t in enumerate(made)]
    got = {r.doc_id: r.component_id for r in jaccard_join.near_duplicates(frame(spark, rows), words=words, percent=percent).collect()}
    want = jaccard_components(rows, words, percent)
    assert got == want and 1 < len(set(want.values())) < len(rows)


@pytest.mark.parametrize("percent", [50, 60, 70])
def test_near_of_small_sets(spark, percent):
    """A link of small sets shares fewer shingles than the longest match."""
    rows = []
    for k in range(12):
        n = 5 + k % 3
        t = [f"f{k}w{j}" for j in range(n + 3)]
        rows += [(10 * k + j, " ".join(t[: n + j])) for j in range(4)] + [(10 * k + 5, " ".join(["x", *t[:n]]))]
    got = {r.doc_id: r.component_id for r in jaccard_join.near_duplicates(frame(spark, rows), words=3, percent=percent).collect()}
    assert got == jaccard_components(rows, 3, percent)
