"""The pipeline, stage by stage, against brute force on its predecessor's output."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from casebook.llm import packing, quality
from casebook.llm import textarray as ta
from casebook.llm.queries import tokenizer_path
from tests.llm.cases import corpus, jaccard_components, text
from tests.llm.test_dedup import brute_lines, low
from tests.llm.test_text import leaked_pairs

JUNK = ["buy buy buy now now now !!! $$$", "click here >>> here >>> here >>> 999 999 999", "zzzz qqqq zzzz qqqq zzzz ###"]


def tables(spark, path):
    rng = random.Random(21)
    docs = [(i, t) for i, t in corpus(5) if i not in (50, 51, 121)]
    docs += [(1000 + k, " ".join(rng.choice(JUNK) for _ in range(12))) for k in range(40)]
    docs += [(1100 + k, text(rng, 200)) for k in range(60)]
    items = [(k, ". ".join(text(rng, 14).replace("\n", " ") for _ in range(3)) + ".") for k in range(12)]
    docs += [(1200 + k, text(rng, 60) + " " + items[k][1] + " " + text(rng, 60)) for k in range(8)]
    spark.createDataFrame([(i, t, None, "s", len(t or "")) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    labels = [(i, 0 if 1000 <= i < 1100 else 1, 0) for i, _ in docs if i is not None and i >= 1000]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return items


def plain_score(model, t):
    """Votes of the nearest labelled vectors, one document and one neighbour at a time."""
    raw = (t or "").encode()
    x = quality.counts(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0] * model.weight
    x = x / max(np.linalg.norm(x), 1e-9)
    v = x @ model.basis
    v = v / max(np.linalg.norm(v), 1e-9)
    near = sorted(((float(np.dot(v, w)), int(y)) for w, y in zip(model.vectors, model.labels)), reverse=True)[: model.neighbours]
    votes = [0.0, 0.0]
    for c, y in near:
        votes[y] += max(c, 0.0) ** model.sharpness * model.shares[y] / max(int((model.labels == y).sum()), 1)
    return votes[1] / sum(votes) if sum(votes) > 0 else float(model.shares[1])


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """(items, [documents, output of each stage])."""
    path = f"file:{tmp_path_factory.mktemp('pipeline')}"
    items = tables(spark, path)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(corpus_pipeline.stored(stage(spark, out[-1], path), f"test-{name}"))
    return path, items, out


def test_columns_and_order(stages):
    _, _, out = stages
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination", "packing"]
    assert all(df.columns == out[0].columns for df in out[:5])


def test_quality_stage(spark, stages):
    path, _, out = stages
    model = quality.learn(out[0], spark.read.parquet(f"{path}/labels.parquet"))
    scores = [(i, t, plain_score(model, t)) for i, t in rows_of(out[0])]
    got = quality.classify(out[0], model).collect()
    want, have = sorted((low(i), s) for i, _, s in scores), sorted((low(r.doc_id), r.score) for r in got)
    assert [i for i, _ in want] == [i for i, _ in have] and np.allclose([s for _, s in want], [s for _, s in have], atol=2e-3)
    clear = [x for x in scores if abs(x[2] - 0.5) > 1e-3]
    kept = Counter(rows_of(out[1]))
    assert all((kept[i, t] > 0) == (s >= 0.5) for i, t, s in clear)
    assert not any(i is not None and 1000 <= i < 1100 for i, _ in kept) and sum(i is not None and 1100 <= i < 1200 for i, _ in kept) > 55


def test_line_stage(stages):
    _, _, out = stages
    rows = rows_of(out[1])
    want = brute_lines(rows, 8)
    left = Counter((i, want[low(i), t or ""][2]) for i, t in rows if not (want[low(i), t or ""][1] and not want[low(i), t or ""][2].strip()))
    assert Counter(rows_of(out[2])) == left


def test_near_duplicate_stage(stages):
    _, _, out = stages
    rows = rows_of(out[2])
    component = jaccard_components(rows, 5, 80)
    assert Counter(rows_of(out[3])) == Counter((i, t) for i, t in rows if component[i] == i)


def test_decontamination_stage(stages):
    _, items, out = stages
    rows = rows_of(out[3])
    bad = {i for i, _ in leaked_pairs(rows, items)}
    assert Counter(rows_of(out[4])) == Counter((i, t) for i, t in rows if i not in bad) and len(bad) >= 6


def test_packing_stage(stages):
    _, _, out = stages
    coder = packing.Coder(tokenizer_path())
    want = Counter()
    for i, t in rows_of(out[4]):
        buf, off = ta.texts_of(pa.array([t or ""]))
        want[i, len(coder.batch(buf, off, 2)[0])] += 1
    got = Counter()
    for r in out[5].collect():
        got[r.doc_id, r.doc_tokens] += r.length
    assert got == Counter({(i, n): n * c for (i, n), c in want.items()})


def test_run_is_the_stages(spark, stages):
    path, _, out = stages
    assert corpus_pipeline.run(spark, path).select("doc_id", "start", "length", "ids_crc32").exceptAll(out[5].select("doc_id", "start", "length", "ids_crc32")).isEmpty()
    assert corpus_pipeline.ORACLE_SQL is None
