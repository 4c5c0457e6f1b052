"""N-gram Jaccard join with adaptive multi-match prefixes.

A document's set is its distinct ``words``-word shingles; two documents link when ``100 * |intersection| >=
percent * |union|``. The result is each document's connected component.

1. Equal sets collapse to one class (a copy is linked with its class, never with every other copy).
2. Shingles are ordered by estimated frequency, rarest first, from a count sketch of fixed size over all documents.
3. A linked pair must share at least ``l`` shingles among the first ``n - ceil(percent * n / 100) + l`` of each, for
   any ``l`` up to the least overlap of a link. Each class takes the ``l`` (1 to ``LONGEST``) of least estimated cost:
   entries of the posting lists to read, plus the candidates they can make (entries / l) times the price of verifying
   one. A pair is a candidate if it shares the smaller of its two ``l``.
4. Groups of near copies would make all pairs, linked or not. So each class is first compared with one leader of its
   posting lists, and then with a larger leader that most of its lists name. Classes that resemble a leader (``NEAR``)
   have it as pivot; among classes of one pivot only those pairs are looked at that share a *difference* from it (see
   ``around_pivots``), which loses no component. All other candidate pairs, of different pivots and components, are
   generated from the posting lists.
5. Verification counts the shingles of both whole texts, or of the differences from a common pivot.

Words are lower-cased (A-Z) runs of bytes that are not ASCII white space; 64-bit hashes stand for words and shingles,
128 bits for a whole set. Edge cases: null or empty texts have an empty set and stand alone; a text with fewer words
than a shingle is one shingle; rows that repeat a doc_id are one node and may tie their texts together; a null doc_id is
a node of its own, smaller than all others; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm import textarray as ta
from casebook.llm.components import components
from casebook.llm.frames import stored
from casebook.llm.textarray import U64

LEAST_BITS, MOST_BITS = 14, 24  # slots of the frequency sketch: 16 KB to 16 MB
LONGEST = 4
VERIFY = 50  # price of one verification in posting entries
NEAR = 50  # least similarity, in percent, with a pivot
LEAST_ID = -(1 << 63)


def shingle_sets(buf: np.ndarray, off: np.ndarray, words: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    start, end, doc = ta.words_of(buf, off, ta.SPACE)
    h = ta.hash_words(ta.LOWER[buf], start, end)
    begin = np.searchsorted(doc, np.arange(len(off)))
    full = np.full(max(len(h) - words + 1, 0), U64(words))
    for k in range(words):
        full = ta.mix((full ^ h[k : k + len(full)]) * ta.M1 + ta.M2)
    for a, b in zip(begin[:-1], begin[1:], strict=True):
        if b - a >= words:
            s = np.sort(full[a : b - words + 1])
            yield s[np.concatenate([[True], s[1:] != s[:-1]])]
        elif b > a:
            x = np.array([b - a], U64)
            for w in h[a:b]:
                x = ta.mix((x ^ w) * ta.M1 + ta.M2)
            yield x
        else:
            yield full[:0]


def frequencies(texts: DataFrame, words: int) -> np.ndarray:
    """Saturating counts of documents by shingle slot, over all documents.

    There is a slot for about eight shingles, within 2 ** MOST_BITS of one byte each: the broadcast stays bounded
    whatever the input. Counts only order the shingles, so a coarse sketch costs time, never a result.
    """
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = int(np.clip(np.ceil(np.log2(max(size, 1) / 50)), LEAST_BITS, MOST_BITS))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, np.uint8)
        for t in ta.gathered(batches, 1, 1 << 20):
            buf, off = ta.texts_of(t.column(1))
            for i, j in ta.slices(off, 1 << 20):
                slot, n = np.unique(_slot(np.concatenate(list(shingle_sets(buf[off[i] : off[j]], off[i : j + 1] - off[i], words))), bits), return_counts=True)
                total[slot] = np.minimum(total[slot].astype(np.int64) + n, 255)
        for k, part in enumerate(total.reshape(-1, 1 << LEAST_BITS)):
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())], names=["slice", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(1 << LEAST_BITS, np.int64)
        for x in table.column("counts"):
            total += np.frombuffer(zlib.decompress(x.as_py()), np.uint8)
        return pa.table({"slice": table.column("slice").slice(0, 1), "counts": pa.array([zlib.compress(np.minimum(total, 255).astype(np.uint8).tobytes(), 1)], pa.binary())})

    rows = texts.mapInArrow(count, "slice int, counts binary").groupBy("slice").applyInArrow(add, "slice int, counts binary").collect()
    out = np.zeros((1 << (bits - LEAST_BITS), 1 << LEAST_BITS), np.uint8)
    for r in rows:
        out[r["slice"]] = np.frombuffer(zlib.decompress(r["counts"]), np.uint8)
    return out.ravel()


def _slot(s: np.ndarray, bits: int) -> np.ndarray:
    return (s >> U64(64 - bits)).astype(np.int64)


def prefixes(texts: DataFrame, words: int, percent: int) -> DataFrame:
    """(node, n, d1, d2, prefix): set size, set digest and the LONGEST-match prefix, rarest shingles first."""
    held = texts.sparkSession.sparkContext.broadcast(frequencies(texts, words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = held.value
        bits = len(count).bit_length() - 1
        for t in ta.gathered(batches, 1, 1 << 20):
            buf, off = ta.texts_of(t.column(1))
            for i, j in ta.slices(off, 1 << 20):
                rows = []
                for s in shingle_sets(buf[off[i] : off[j]], off[i : j + 1] - off[i], words):
                    n = len(s)
                    take = min(n, n - -(-percent * n // 100) + LONGEST)
                    order = np.lexsort((s, count[_slot(s, bits)]))[:take]
                    rows.append((n, *(int(ta.mix(s ^ x).sum(dtype=U64).astype(np.int64)) for x in (ta.M1, ta.M3)), s[order].astype(np.int64)))
                n, d1, d2, p = zip(*rows, strict=True)
                flat = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, p)]), pa.int32()), pa.array(np.concatenate(p), pa.int64()))
                yield pa.RecordBatch.from_arrays([t.column(0).slice(i, j - i).combine_chunks(), *[pa.array(c, pa.int64()) for c in (n, d1, d2)], flat], names=["node", "n", "d1", "d2", "prefix"])

    return texts.mapInArrow(run, "node long, n long, d1 long, d2 long, prefix array<long>")


def compared(pairs: DataFrame, texts: DataFrame, words: int, percent: int, near: int) -> DataFrame:
    """Exact comparison of ``pairs`` (a, ad, b, bd: nodes and set digests) by their whole texts.

    Rows of the pairs that link or whose similarity is at least ``near`` percent: (a, ad, b, bd, link, an, bn, apart,
    diff), ``apart`` the size of the symmetric difference and ``diff`` its shingles if ``near`` is under 100.
    """
    one = texts.select(F.col("node").alias("a"), F.col("text").alias("at"))
    two = texts.select(F.col("node").alias("b"), F.col("text").alias("bt"))
    rows = pairs.join(one, "a").join(two, "b").select("a", "ad", "at", "b", "bd", "bt")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            known: dict[tuple, np.ndarray | None] = {}

            def sets(ids, digests, column) -> list:
                keys = list(zip(ids, digests, strict=True))
                todo = [k for k, key in enumerate(keys) if known.get(key) is None]
                found = shingle_sets(*ta.texts_of(column.take(pa.array(todo, pa.int64()))), words) if todo else ()
                out: list = [known.get(key) for key in keys]
                for k, s in zip(todo, found, strict=True):
                    right = int(ta.mix(s ^ ta.M1).sum(dtype=U64).astype(np.int64)) == digests[k]  # else another text of that id
                    out[k] = known[keys[k]] = s if right else None
                return out

            a, ad, b, bd = (t.column(c).to_pylist() for c in (0, 1, 3, 4))
            keep: list[tuple] = []
            for k, (x, y) in enumerate(zip(sets(a, ad, t.column(2)), sets(b, bd, t.column(5)), strict=True)):
                if x is not None and y is not None:
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    union = len(x) + len(y) - both
                    if 100 * both >= min(near, percent) * union:
                        diff = np.setxor1d(x, y, assume_unique=True).astype(np.int64) if near < 100 else None
                        keep.append((a[k], ad[k], b[k], bd[k], 100 * both >= percent * union, len(x), len(y), union - both, diff))
            types = [*[pa.int64()] * 4, pa.bool_(), *[pa.int64()] * 3, pa.list_(pa.int64())]
            cols = list(zip(*keep, strict=True)) or [()] * 9
            yield pa.RecordBatch.from_arrays([pa.array(c, ty) for c, ty in zip(cols, types, strict=True)], names=["a", "ad", "b", "bd", "link", "an", "bn", "apart", "diff"])

    return rows.mapInArrow(run, "a long, ad long, b long, bd long, link boolean, an long, bn long, apart long, diff array<long>")


def most_apart(total, percent: int):
    """The largest symmetric difference of two sets that link, given the sum of their sizes."""
    return total - 2 * F.ceil(total * percent / (100 + percent))


def size_band(percent: int):
    """Number of the band of set sizes; sizes of links lie in one band or in neighbours."""
    return F.floor(F.log(F.col("n")) / float(-np.log(percent / 100))) if percent < 100 else F.col("n")


def leaders(postings: DataFrame, percent: int) -> DataFrame:
    """(a, ad, b, bd): each class with the root of its chain of leaders, if that is another class.

    A posting list's leader, in each band of set sizes, is the class of least hash; a class follows the leader it
    meets in most of its lists, if in at least half of them. Leaders have ever smaller hashes, so chains have ends.
    """
    p = postings.withColumn("band", size_band(percent)).withColumn("me", F.struct(F.xxhash64("rep", "d1").alias("draw"), "rep", "d1"))
    lead = p.groupBy("tok", "band").agg(F.min("me").alias("lead"))
    met = p.join(lead, ["tok", "band"]).groupBy("me", "lead").agg(F.count("*").alias("shared"))
    best = met.groupBy("me").agg(F.max(F.struct("shared", "lead")).alias("m"), F.sum("shared").alias("lists"))
    up = stored(best.where("m.shared * 2 >= lists and m.lead <> me").select("me", F.col("m.lead").alias("up")), "jaccard-leaders")
    root = up
    for _ in range(3):
        step = up.select(F.col("me").alias("up"), F.col("up").alias("next"))
        root = root.join(step, "up", "left").select("me", F.coalesce("next", "up").alias("up"))
    return root.select(F.col("me.rep").alias("a"), F.col("me.d1").alias("ad"), F.col("up.rep").alias("b"), F.col("up.d1").alias("bd"))


def larger_pivots(near: DataFrame, postings: DataFrame, percent: int) -> DataFrame:
    """(a, ad, b, bd): classes whose lists mostly name one larger pivot than their own, with that pivot.

    Chains of leaders may end at several roots within one group of near copies, and some classes of it follow no leader,
    as their lists name many. Such classes would meet in the posting lists, pair by pair. So each list names its largest
    pivot in each band of set sizes, and a class moves to the one that at least half of its lists name.
    """
    pivot = F.struct("b", "bd")
    size = near.groupBy(pivot.alias("p")).agg(F.count("*").alias("size"))
    of = near.select(F.col("a").alias("rep"), F.col("ad").alias("d1"), pivot.alias("p"))
    of = of.unionByName(size.select(F.col("p.b").alias("rep"), F.col("p.bd").alias("d1"), "p").join(of.select("rep", "d1"), ["rep", "d1"], "left_anti"))
    own = F.when(F.col("size").isNotNull(), F.struct("size", "p"))
    entries = postings.select("tok", "rep", "d1", size_band(percent).alias("band")).join(of.join(size, "p"), ["rep", "d1"], "left")
    entries = entries.select("tok", "band", "rep", "d1", own.alias("own"))
    lead = entries.where("own is not null").groupBy("tok", "band").agg(F.max("own").alias("lead"))
    named = entries.join(lead, ["tok", "band"], "left").groupBy("rep", "d1", "own", "lead").agg(F.count("*").alias("shared"))
    best = named.groupBy("rep", "d1", "own").agg(F.sum("shared").alias("lists"), F.max(F.when(F.col("lead").isNotNull(), F.struct("shared", "lead"))).alias("m"))
    best = best.where("2 * m.shared >= lists and (own is null or m.lead > own)")
    to = F.col("m.lead.p")
    return best.where((F.col("rep") != to["b"]) | (F.col("d1") != to["bd"])).select(F.col("rep").alias("a"), F.col("d1").alias("ad"), to["b"].alias("b"), to["bd"].alias("bd"))


def around_pivots(near: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between classes of one pivot that aren't both linked with it.

    Let D(x) be the difference of x from the pivot. Two classes link if ``|D(x)| + |D(y)| - 2 |D(x) & D(y)|`` is small
    enough. If it were so without a shared difference, both would link with the pivot; so a pair must share
    differences, which are few and rare, while the classes share nearly all their shingles. Prefixes of D in order of
    frequency around the pivot find such pairs: x can only link if it shares ``|D(x)| - most apart`` of them, and if
    it links with the pivot itself, about half. A class is first compared with the class of least difference in each of
    its lists, as many pairs as entries; then with all those of other components.
    """
    x = near.select(F.col("a").alias("rep"), F.col("ad").alias("d1"), F.struct("b", "bd").alias("pivot"), "link", F.col("an").alias("n"), F.col("bn").alias("pn"), "apart", "diff")
    largest = x.groupBy("pivot").agg(F.max("n").alias("largest"))
    each = x.select("rep", "d1", "pivot", F.explode("diff").alias("tok"))
    df = each.groupBy("pivot", "tok").agg(F.count("*").alias("df"))
    order = each.join(df, ["pivot", "tok"]).groupBy("rep", "d1", "pivot").agg(F.array_sort(F.collect_list(F.struct("df", "tok"))).alias("order"))
    must = F.greatest(
        F.lit(1),
        F.col("apart") - most_apart(F.col("n") + F.least("largest", F.floor(F.col("n") * 100 / percent)), percent) - 1,
        F.when(F.col("link"), F.ceil((F.col("apart") + 1 - F.abs(F.col("n") - F.col("pn"))) / 2)).otherwise(1),
    )
    x = x.drop("diff").join(order, ["rep", "d1", "pivot"]).join(largest, "pivot").withColumn("must", must.cast("int"))
    x = x.withColumn("may", F.size(F.filter("order", lambda o: o["df"] > 1))).where("may >= must")
    x = x.withColumn("prefix", F.filter(F.slice("order", 1, F.greatest(F.col("apart") - F.col("must") + 1, F.lit(0)).cast("int")), lambda o: o["df"] > 1)["tok"])
    x = stored(x.withColumn("diff", F.col("order")["tok"]).drop("order"), "jaccard-satellites")
    key = x.select("rep", "d1", "pivot", "link", "n", "apart", "may", F.explode("prefix").alias("tok"))
    one, two = (key.select("pivot", "tok", *[F.col(c).alias(f"{c}{k}") for c in ("rep", "d1", "n", "apart", "may", "link")]) for k in (1, 2))

    def possible(n, apart, may):
        return F.col("apart1") + apart - 2 * F.least("may1", may) <= most_apart(F.col("n1") + n, percent)

    def linked(pairs: DataFrame, name: str) -> DataFrame:
        """The (rep1, rep2) of pairs (rep1, d11, rep2, d12, n1, n2) that link, by their differences."""
        left = x.select(F.col("rep").alias("rep1"), F.col("d1").alias("d11"), F.col("apart").alias("apart1"), F.col("diff").alias("diff1"))
        right = x.select(F.col("rep").alias("rep2"), F.col("d1").alias("d12"), F.col("apart").alias("apart2"), F.col("diff").alias("diff2"))
        rows = pairs.distinct().join(left, ["rep1", "d11"]).join(right, ["rep2", "d12"])
        apart = F.col("apart1") + F.col("apart2") - 2 * F.size(F.array_intersect("diff1", "diff2"))
        rows = rows.where(apart <= most_apart(F.col("n1") + F.col("n2"), percent))
        return stored(rows.select(F.col("rep1").alias("a"), F.col("rep2").alias("b")), name)

    best = key.groupBy("pivot", "tok").agg(F.min(F.struct("apart", "rep", "d1", "n", "may")).alias("l"))
    met = one.where("not link1").join(best, ["pivot", "tok"]).where((F.col("l.rep") != F.col("rep1")) & possible(F.col("l.n"), F.col("l.apart"), F.col("l.may")))
    first = linked(met.select("rep1", "d11", F.col("l.rep").alias("rep2"), F.col("l.d1").alias("d12"), "n1", F.col("l.n").alias("n2")), "jaccard-around")
    known = near.where("link").select("a", "b").unionByName(first)
    comp = components(known)
    sides = []
    for k, side in ((1, one.where("not link1")), (2, two)):
        c = comp.select(F.col("node").alias(f"rep{k}"), F.col("component").alias("_c"))
        sides.append(side.join(c, f"rep{k}", "left").withColumn(f"comp{k}", F.coalesce("_c", f"rep{k}")).drop("_c"))
    one, two = sides
    differ = (F.col("comp1") != F.col("comp2")) & (F.col("link2") | (F.struct("rep1", "d11") < F.struct("rep2", "d12")))
    on = [one[c] == two[c] for c in ("pivot", "tok")]
    met = one.join(two, [*on, differ, possible(F.col("n2"), F.col("apart2"), F.col("may2"))])
    return first.unionByName(linked(met.select("rep1", "d11", "rep2", "d12", "n1", "n2"), "jaccard-around"))


def can_link(a: str, b: str, percent: int):
    """Whether entries ``a`` and ``b`` of one shingle (struct columns: n, before, rest, own) leave room for a link.

    The common order splits both sets at the shingle. What they share before it lies in both prefixes, so no more than
    the shared entries ``before`` it there. What they share after it is at most the ``rest`` of either; and of the
    prefix that ends first, those shingles that no other class has in its prefix can't lie in the other set at all
    (``own`` is the rest without them). Such shingles of the prefix that ends last may: the other set can hold them
    beyond its prefix. Of groups, the least n and the greatest of the others are given.
    """
    after = F.greatest(F.least(F.col(f"{a}.own"), F.col(f"{b}.rest")), F.least(F.col(f"{a}.rest"), F.col(f"{b}.own")))
    both = F.least(F.col(f"{a}.before"), F.col(f"{b}.before")) + 1 + after
    return both * (100 + percent) >= (F.col(f"{a}.n") + F.col(f"{b}.n")) * percent


def cross_pairs(members: DataFrame, percent: int) -> DataFrame:
    """All candidate pairs (a, ad, b, bd) of different pivots and components that share enough prefix entries.

    ``members`` are posting entries (tok, rep, d1, n, before, rest, own, ell, pivot, comp); for before, rest and own see
    ``can_link``. Classes of one pivot never meet here.
    """
    p = members.select("tok", "pivot", "comp", "rep", "d1", "ell", "n", "before", "rest", "own")
    groups = p.groupBy("tok", "pivot").agg(F.max("n").alias("most"), F.struct(F.min("n").alias("n"), *[F.max(c).alias(c) for c in ("before", "rest", "own")]).alias("g"))
    several = groups.groupBy("tok").agg(F.count("*").alias("c")).where("c > 1").select("tok")
    groups = groups.join(several, "tok")
    left = groups.select("tok", F.col("pivot").alias("pa"), F.col("most").alias("ma"), F.col("g").alias("ga"))
    right = groups.select("tok", F.col("pivot").alias("pb"), F.col("most").alias("mb"), F.col("g").alias("gb"))
    sizes = (F.col("ma") * 100 >= F.col("gb.n") * percent) & (F.col("mb") * 100 >= F.col("ga.n") * percent)
    met = left.join(right, [left["tok"] == right["tok"], F.col("pa") < F.col("pb"), sizes, can_link("ga", "gb", percent)]).select(left["tok"], "pa", "pb", "gb", "mb")
    entry = F.struct("n", "before", "rest", "own")
    one = p.select("tok", F.col("pivot").alias("pa"), F.col("comp").alias("ca"), F.col("rep").alias("a"), F.col("d1").alias("ad"), entry.alias("ea"), F.col("ell").alias("al"))
    two = p.select("tok", F.col("pivot").alias("pb"), F.col("comp").alias("cb"), F.col("rep").alias("b"), F.col("d1").alias("bd"), entry.alias("eb"), F.col("ell").alias("bl"))
    sizes = (F.col("mb") * 100 >= F.col("ea.n") * percent) & (F.col("ea.n") * 100 >= F.col("gb.n") * percent)
    half = met.join(one, [met["tok"] == one["tok"], met["pa"] == one["pa"], sizes, can_link("ea", "gb", percent)]).select(met["tok"], "pb", "ca", "a", "ad", "ea", "al")
    fits = (F.col("ea.n") * 100 >= F.col("eb.n") * percent) & (F.col("eb.n") * 100 >= F.col("ea.n") * percent)
    pairs = half.join(two, [half["tok"] == two["tok"], half["pb"] == two["pb"], F.col("ca") != F.col("cb"), fits, can_link("ea", "eb", percent)])
    counted = pairs.groupBy("a", "ad", "b", "bd").agg(F.count("*").alias("shared"), F.min(F.least("al", "bl")).alias("need"))
    return counted.where("shared >= need").select("a", "ad", "b", "bd")


def links(texts: DataFrame, sets: DataFrame, words: int, percent: int) -> DataFrame:
    """Edges (a, b) whose components are those of the similarity graph between classes."""
    classes = stored(sets.where("n > 0").groupBy("n", "d1", "d2").agg(F.min("node").alias("rep"), F.first("prefix").alias("prefix")), "jaccard-classes")
    postings = classes.select("rep", "d1", "n", F.posexplode("prefix").alias("pos", "tok"))
    shared = postings.groupBy("tok").agg(F.count("*").alias("df")).where("df > 1")
    postings = stored(postings.join(shared, "tok"), "jaccard-postings")
    base = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    reads = [F.sum(F.when(F.col("pos") < base + ell, F.col("df") - 1).otherwise(0)).alias(f"c{ell + 1}") for ell in range(LONGEST)]
    overlap = F.ceil(F.col("n") * percent / 100)  # the least that any link of the class shares
    cost = [F.when(overlap >= e, F.struct((F.col(f"c{e}") * (1 + VERIFY / e)).alias("cost"), F.lit(e).alias("ell"))) for e in range(1, LONGEST + 1)]
    held = postings.groupBy("rep", "d1").agg(F.first("n").alias("n"), *reads, F.array_sort(F.collect_list(F.struct("pos", "tok"))).alias("held"))
    held = held.withColumn("ell", F.least(*cost)["ell"]).select("rep", "d1", "n", "ell", F.size("held").alias("many"), F.posexplode("held").alias("before", "at"))
    rest = F.col("n") - F.col("at.pos") - 1
    alone_after = F.least("n", base + LONGEST - 1) - F.col("many") - (F.col("at.pos") - F.col("before"))
    postings = stored(
        held.where(F.col("at.pos") < base + F.col("ell") - 1).select("at.tok", "rep", "d1", "n", "before", rest.alias("rest"), (rest - alone_after).alias("own"), "ell"), "jaccard-prefixes"
    )
    known = stored(texts.join(postings.select(F.col("rep").alias("node")).distinct(), "node"), "jaccard-texts")
    near = stored(compared(leaders(postings, percent), known, words, percent, NEAR), "jaccard-near")
    moved = stored(compared(larger_pivots(near, postings, percent), known, words, percent, NEAR), "jaccard-moved")
    linked = near.where("link").select("a", "b")
    near = stored(near.join(moved.select("a", "ad"), ["a", "ad"], "left_anti").unionByName(moved), "jaccard-near")
    found = stored(linked.unionByName(moved.where("link").select("a", "b")).unionByName(around_pivots(near, percent)), "jaccard-links")
    comp = components(found).select(F.col("node").alias("rep"), F.col("component").alias("comp"))
    pivot = near.select(F.col("a").alias("rep"), F.col("ad").alias("d1"), F.struct("b", "bd").alias("_p"))
    me = F.struct(F.col("rep").alias("b"), F.col("d1").alias("bd"))
    members = postings.join(pivot, ["rep", "d1"], "left").join(comp, "rep", "left").withColumn("pivot", F.coalesce("_p", me)).withColumn("comp", F.coalesce("comp", "rep"))
    more = compared(cross_pairs(stored(members.drop("_p"), "jaccard-members"), percent), known, words, percent, 100)
    return found.unionByName(stored(more.select("a", "b"), "jaccard-links"))


def near_duplicates(docs: DataFrame, *, words: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles and component_id, the smallest doc_id reachable by links."""
    texts = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST_ID)).alias("node"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    sets = stored(prefixes(texts, words, percent), "jaccard-sets")
    between = links(texts, sets, words, percent)
    full = sets.where("n > 0")
    rep = full.groupBy("n", "d1", "d2").agg(F.min("node").alias("b"))
    within = full.join(rep, ["n", "d1", "d2"]).select(F.col("node").alias("a"), "b")
    found = components(between.unionByName(within))
    return sets.join(found, "node", "left").select(
        F.nullif("node", F.lit(LEAST_ID)).alias("doc_id"), F.col("n").alias("n_shingles"), F.nullif(F.coalesce("component", "node"), F.lit(LEAST_ID)).alias("component_id")
    )


def one_of_each(docs: DataFrame, *, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, unchanged, that stand for their component: those with its smallest doc_id."""
    found = near_duplicates(docs, words=words, percent=percent)
    gone = found.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(stored(gone, "near-duplicates"), F.col("doc_id").cast("long").eqNullSafe(F.col("_gone")), "left_anti")
