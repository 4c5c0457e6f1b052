"""Small corpora with the odd cases every operator must survive, and brute-force answers."""

from __future__ import annotations

import random
import re

WORDS = "the of and alpha beta gamma delta house river stone light water green under about seven".split()


def text(rng: random.Random, n: int) -> str:
    out = []
    for k in range(n):
        out.append(rng.choice(WORDS) + rng.choice(["", "", "er", "ing", str(rng.randrange(30))]))
        out.append("\n" if rng.random() < 0.12 else " ")
    return "".join(out).strip()


def corpus(seed: int = 1) -> list[tuple[int | None, str | None]]:
    """(doc_id, text): exact and near copies, shared passages, nulls, empty and long texts, repeated rows."""
    rng = random.Random(seed)
    docs: list[tuple[int | None, str | None]] = [(i, text(rng, rng.randrange(1, 120))) for i in range(40)]
    long = text(rng, 6000)
    passage = text(rng, 70)
    docs += [(50, long), (51, long + " more"), (52, None), (53, ""), (54, "   \n\n "), (55, "one"), (56, "é ü ß \U0001f600 \U0001f600")]
    docs += [(60 + k, docs[3][1]) for k in range(12)]
    docs += [(80 + k, passage + "\n" + text(rng, 20) + "\n" + passage) for k in range(6)]
    base = text(rng, 400).split(" ")
    for k in range(8):
        near = list(base)
        near[rng.randrange(len(near))] = f"changed{k}"
        docs.append((100 + k, " ".join(near)))
    docs += [(None, passage), (120, "repeated row here " * 20), (120, "repeated row here " * 20), (121, "first text of an id"), (121, "second text of that id " * 12)]
    rng.shuffle(docs)
    return docs


def frame(spark, rows, extra: bool = True):
    """documents with further columns whose names operators use inside."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "doc_id long, text string")
    if extra:
        for c in ("lang", "source"):
            df = df.withColumn(c, F.lit(None).cast("string"))
        for c in ("start", "rank", "n_lines", "node", "rep", "rules", "size", "_text", "bucket"):
            df = df.withColumn(c, F.lit(7))
    return df


def shingle_set(t: str | None, k: int) -> frozenset:
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def jaccard_components(rows, k: int, percent: int) -> dict:
    sets = [(i, shingle_set(t, k)) for i, t in rows]
    low = {i: -1 if i is None else i for i, _ in rows}
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            both = len(x & y)
            if x and y and 100 * both >= percent * (len(x) + len(y) - both):
                p, q = sorted((find(i), find(j)), key=low.get)
                parent[q] = p
    return {i: find(i) for i, _ in rows}
