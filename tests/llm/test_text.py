"""Language, quality, decontamination, packing, pseudonyms and secrets."""

import calendar
import hashlib
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from casebook.llm import decontaminate, language_id, packing, pseudonyms, quality, secret_scan
from casebook.llm import textarray as ta
from casebook.llm.queries import tokenizer_path
from tests.llm.cases import corpus, frame, text

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def crc_fold(i, mod):
    return zlib.crc32(("" if i is None else str(i)).encode()) % mod


def test_words_and_hashes():
    texts = ["a bc  d", "", " x", None, "é\tü "]
    buf, off = ta.texts_of(pa.array(texts))
    start, end, doc = ta.words_of(buf, off, ta.SPACE)
    got = [(int(d), bytes(buf[a:b]).decode()) for a, b, d in zip(start, end, doc, strict=True)]
    assert got == [(i, w) for i, t in enumerate(texts) for w in (t or "").split()]
    rng = random.Random(1)
    words = list({"".join(rng.choice("ab") for _ in range(rng.randrange(1, 30))) for _ in range(3000)})
    buf, off = ta.texts_of(pa.array(words))
    assert len(set(ta.hash_words(buf, off[:-1], off[1:]).tolist())) == len(words)


def test_training():
    """Backpropagation through time learns two alphabets."""
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.integers(97, 103, (40, 32)), rng.integers(101, 108, (40, 32))]).astype(np.uint8)
    y = np.repeat([0, 1], 40)
    size = np.full(80, 32)

    def accuracy(net):
        p = net.position_scores(x.T).mean(0)
        return (p.argmax(1) == y).mean()

    assert accuracy(language_id.train(x, size, y, ["a", "b"], rounds=60)) > 0.95


def test_language(spark, documents):
    net = language_id.learn(documents)
    got = {r.doc_id: r for r in language_id.identify(documents, net).collect()}
    truth = {r.doc_id: r.lang for r in documents.select("doc_id", "lang").collect()}
    held = [i for i in got if crc_fold(i, 5) == 0]
    assert all(got[i].held_out == (crc_fold(i, 5) == 0) for i in got)
    assert np.mean([got[i].lang_pred == truth[i] for i in held]) > 0.95
    odd = {r.doc_id: r for r in language_id.identify(frame(spark, [(1, None), (2, ""), (3, "12 34 !!"), (None, "the house of"), (4, "the " * 9000)]), net).collect()}
    assert [odd[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and odd[4].lang_pred == "en"
    assert all(0 <= r.score <= 1 for r in [*got.values(), *odd.values()])
    none = language_id.learn(documents.where("false"))
    assert language_id.identify(frame(spark, [(1, "a b")]), none).first().lang_pred == "und"
    assert language_id.identify(documents.where("false"), net).count() == 0


def test_quality(spark, documents):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.learn(documents, labels)
    got = {r.doc_id: r for r in quality.classify(documents, model).collect()}
    truth = {r.doc_id: r.quality for r in labels.collect()}
    held = [i for i in truth if i in got and crc_fold(i, 3) == 1]
    assert np.mean([got[i].predicted == truth[i] for i in held]) > 0.95
    kept = {r.doc_id for r in quality.split(documents, model).select("doc_id").collect()}
    assert kept == {i for i, r in got.items() if r.predicted == 1}
    odd = quality.classify(frame(spark, corpus()), model).collect()
    assert len(odd) == len(corpus()) and all(0 <= r.score <= 1 for r in odd)
    nothing = quality.learn(documents, labels.where("false"))
    assert {r.score for r in quality.classify(frame(spark, corpus()), nothing).collect()} == {0.5}
    assert quality.classify(documents.where("false"), model).count() == 0
    odd_labels = spark.createDataFrame([(1, None), (1, 0), (1, 1), (None, 1), (10**9, 0)], "doc_id long, quality int")
    quality.learn(documents, odd_labels)


def nearest(words, doc):
    """Least edits between words and any run of doc, by the plain recurrence."""
    row = [0] * (len(doc) + 1)
    for k, w in enumerate(words):
        new = [k + 1]
        for j, d in enumerate(doc):
            new.append(min(row[j] + (w != d), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def leaked_pairs(docs, items):
    """(doc_id, item_id) whose question and answer stand in the document to 80 %, by shingles or, if few, by words in order."""

    def sh(t):
        w = re.findall(r"[^\W_]+", (t or "").lower())
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    def full(t):  # any sub-length of words, as parts may be shorter than a shingle
        w = re.findall(r"[^\W_]+", (t or "").lower())
        return {tuple(w[a : a + n]) for n in range(1, 6) for a in range(len(w) - n + 1)}

    def overlaps(t, have, doc):
        w = re.findall(r"[^\W_]+", t.lower())
        return len(sh(t) & have) >= 0.8 * len(sh(t)) or len(sh(t)) < 25 and nearest(w, doc) <= 0.2 * len(w) + 1e-9

    want = set()
    for i, t in docs:
        have, doc = full(t), re.findall(r"[^\W_]+", (t or "").lower())
        for k, item in items:
            parts = [p for p in decontaminate.SENTENCE.split(item or "") if sh(p)]
            q, a = (" ".join(parts[:-1]), parts[-1]) if len(parts) > 1 else (" ".join(parts), "")
            if parts and overlaps(q, have, doc) and overlaps(a, have, doc):
                want.add((i, k))
    return want


def test_edits():
    rng = np.random.default_rng(2)
    for _ in range(200):
        words, doc = rng.integers(0, 4, rng.integers(1, 9)), rng.integers(0, 4, rng.integers(0, 15))
        assert decontaminate.edits(words.astype(np.uint64), doc.astype(np.uint64)) == nearest(words.tolist(), doc.tolist())


def test_leaks_with_a_changed_word(spark):
    """One word changed, dropped or put in, in the question and in the answer, however short they are."""
    rng = random.Random(12)
    items = [(k, ". ".join(text(rng, n).replace("\n", " ") for n in (12, 13, 6)) + ".") for k in range(30)]
    docs = []
    for k, t in items:
        parts = [p for p in decontaminate.SENTENCE.split(t)]
        for at in (0, len(parts) - 1):
            for way in range(3):
                w = parts[at].split(" ")
                j = len(w) // 2
                w[j : j + 1] = ["otherword"] if way == 0 else [] if way == 1 else [w[j], "newword"]
                now = [*parts[:at], " ".join(w), *parts[at + 1 :]]
                docs.append((k * 10 + at // max(1, len(parts) - 1) * 3 + way, text(rng, 60) + " " + " ".join(now) + " " + text(rng, 60)))
    docs += [(1000 + k, text(rng, 200)) for k in range(30)]
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert {(i, i // 10) for i, _ in docs if i < 1000} <= got
    assert got == leaked_pairs(docs, items) and all(i < 1000 for i, _ in got)


def test_leaks(spark):
    rng = random.Random(8)
    items = [(k, ". ".join(text(rng, 14).replace("\n", " ") for _ in range(3)) + ".") for k in range(40)] + [(90, None), (91, ""), (92, items_one := "solitary words of an item")]
    docs = [(i, t) for i, t in corpus(6)]
    docs += [(300 + k, text(rng, 90) + " " + items[k][1].upper() + " " + text(rng, 300)) for k in range(20)]
    docs += [(400, text(rng, 30) + " " + items_one + "!"), (401, " ".join(items[30][1].split()[:20]))]
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()}

    want = leaked_pairs(docs, items)
    assert got == want and len(got) >= 21
    clean = decontaminate.clean(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string"))
    assert Counter(r.doc_id for r in clean.collect()) == Counter(i for i, _ in docs if i not in {d for d, _ in want})
    assert clean.columns == frame(spark, docs).columns
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.leaks(frame(spark, docs), none).count() == 0
    assert decontaminate.leaks(frame(spark, []), spark.createDataFrame(items, "item_id long, text string")).count() == 0


def test_leaks_in_shards(spark):
    rng = random.Random(9)
    items = [(k, text(rng, 30)) for k in range(23)]
    docs = [(k, text(rng, 200) + " " + t) for k, t in items]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(frame(spark, docs), bench, shard_items=6).collect()}
    assert {(k, k) for k in range(23)} <= got
    assert got == {(r.doc_id, r.item_id) for r in decontaminate.leaks(frame(spark, docs), bench).collect()}


def test_three_hundred_languages(spark):
    rng = random.Random(9)
    rows = [(k, f"{rng.choice('abc')}word {k % 300} text", f"l{k % 300:03d}") for k in range(3000)]
    net = language_id.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"), per_language=3, rounds=2)
    assert len(net.languages) == 300
    got = language_id.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"), net).collect()
    assert len(got) == 3000 and {r.lang_pred for r in got} <= {x[2] for x in rows} and all(0 <= r.score <= 1 for r in got)


def test_packing(spark):
    from tokenizers import Tokenizer

    rows = corpus(7) + [(500, "don't <|endoftext|> x<|STARTOFTEXT|> ,'s 12ab,c ж あ İ ẞ é ́a a\x85b\x1cc　d")]
    t = Tokenizer.from_file(tokenizer_path())
    ids = [(i, t.encode(x or "", add_special_tokens=False).ids + [2]) for i, x in rows]
    got = packing.pack(frame(spark, rows).coalesce(2), tokenizer_path(), group_tokens=5000, step_tokens=8192).collect()
    left = Counter((i, tuple(x)) for i, x in ids)
    pieces: dict = {}
    for r in got:
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    for (i, n), rs in pieces.items():
        want = [x for j, x in ids if j == i and len(x) == n]
        copies = len(want)
        assert sum(r.length for r in rs) == n * copies
        for r in rs:
            assert any(zlib.crc32(np.array(x[r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32 for x in want)
        cover = Counter(k for r in rs for k in range(r.start, r.start + r.length))
        assert set(cover.values()) == {copies} and len(cover) == n
    assert set(pieces) == {(i, len(x)) for i, x in left}
    sequences: dict = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    padding = total = 0
    for s in sequences.values():
        s.sort()
        assert s[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(s, s[1:], strict=False))
        size = s[-1][0] + s[-1][1]
        assert size <= 4096
        total += size
        padding += 0 if size & (size - 1) == 0 else 4096 - size
    assert sum(size & (size - 1) != 0 for size in (s[-1][0] + s[-1][1] for s in sequences.values())) <= total // 5000 + 2
    assert packing.pack(frame(spark, []), tokenizer_path()).count() == 0


def test_packing_with_a_cased_vocabulary(spark):
    """Splits and lower-casing hold for one file; with another one, whole texts are encoded."""
    from public_tokenizers import path
    from tokenizers import Tokenizer

    assert packing.Coder(tokenizer_path()).by_word and not packing.Coder(path("byte_bpe_50k.json")).by_word
    t = Tokenizer.from_file(path("byte_bpe_50k.json"))
    rows = [(k, x) for k, (_, x) in enumerate(corpus(8))] + [(900, "The QUICK  brown\tFox's"), (901, "\U0001f600 é İ")]
    want = {k: np.array(t.encode(x or "", add_special_tokens=False).ids + [2], "<u4") for k, x in rows}
    got = packing.pack(frame(spark, rows), path("byte_bpe_50k.json")).collect()
    assert sum(r.length for r in got) == sum(map(len, want.values()))
    for r in got:
        assert r.doc_tokens == len(want[r.doc_id]) and r.ids_crc32 == zlib.crc32(want[r.doc_id][r.start : r.start + r.length].tobytes())


def test_ids_over_16_bits():
    coder = packing.Coder(tokenizer_path())
    plain = coder._plain
    coder._plain = lambda words: [[i + 70_000 for i in x] for x in plain(words)]
    ids, off = coder.batch(np.frombuffer(b"one two", np.uint8), np.array([0, 7]), 2)
    assert (ids[:-1] - 70_000).tolist() == plain(["one two"])[0] and ids[-1] == 2 and off.tolist() == [0, len(ids)]


def test_step_groups_are_even():
    sizes = [random.Random(k).choice([512, 1024, 4096, 4096]) for k in range(200)]
    held = Counter()
    for g, n in zip(packing.step_groups(sizes, 65536), sizes, strict=True):
        held[g] += n
    assert max(held.values()) - min(held.values()) <= 1024


def luhn(d):
    return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(d))) % 10 == 0


def test_pseudonyms(spark):
    rows = [
        (1, "mail Jo.doe42@mail8.example.com, ip 152.143.123.131 card 4785380592391139 again 4785-3805-9239-1139."),
        (2, "4785380592391139 and Jo.doe42@mail8.example.com on 2021-02-28 or 28/02/2021, 28.02.2021; bad 2021-02-30"),
        (3, "+1 (988) 555-2485 ssn 123-45-6789 bad 000-12-3456 666-12-3456 4111111111111112 999.1.1.1 1.2.3.4.5"),
        (4, None), (None, ""), (5, "no data"), (5, "a@b.co"), (6, "x 4785380592391139 " * 300),
    ]
    got = pseudonymise = pseudonyms.pseudonymise(frame(spark, rows), "key")
    by = {}
    for r in got.collect():
        by.setdefault(r.doc_id, []).append(r)
    one, two, three = by[1][0], by[2][0], by[3][0]
    assert (one.n_email, one.n_ip, one.n_card) == (1, 1, 2) and (two.n_date, two.n_card, three.n_phone, three.n_ssn) == (3, 1, 1, 1)
    assert (three.n_card, three.n_ip) == (0, 0) and "2021-02-30" in two.text and "000-12-3456 666-12-3456 4111111111111112 999.1.1.1 1.2.3.4.5" in three.text
    for (i, t), r in zip([(1, rows[0][1]), (2, rows[1][1])], (one, two), strict=True):
        for s in r.spans.split(","):
            kind, a, b = s.split(":")
            assert t[int(a) : int(b)] not in r.text, kind
    card = re.search(r"\b\d{16}\b", one.text)[0]
    assert luhn(card) and card in two.text and card == re.search(r"[\d-]{19}", one.text)[0].replace("-", "")
    assert re.search(r"[A-Z][a-z]\.[a-z]{3}\d\d@mail8\.example\.com", one.text)[0] in two.text
    assert re.search(r"\+1 \(\d{3}\) \d{3}-\d{4}", three.text) and len(by[5]) == 2 and by[4][0].text == ""
    y, m, d = re.search(r"(\d{4})-(\d\d)-(\d\d) or", two.text).groups()
    assert f"{d}/{m}/{y}" in two.text and f"{d}.{m}.{y}" in two.text
    back = pseudonyms.pseudonymise(pseudonymise, "key", reverse=True)
    assert Counter(r.text for r in back.collect()) == Counter(t or "" for _, t in rows)
    other = {r.doc_id: r.text for r in pseudonyms.pseudonymise(frame(spark, rows), "other").collect()}
    assert other[1] != one.text and pseudonyms.pseudonymise(frame(spark, []), "key").count() == 0


def test_pseudonyms_are_one_to_one(spark):
    ssn = [f"{a:03d}-{g:02d}-{s:04d}" for a in (1, 665, 667, 899) for g in (1, 50, 99) for s in range(1, 60)]
    dates = [f"{y}-{m:02d}-{d:02d}" for y in (1900, 1999, 2099) for m in range(1, 13) for d in range(1, 29)]
    out = pseudonyms.pseudonymise(spark.createDataFrame([(k, x) for k, x in enumerate(ssn + dates)], "doc_id long, text string"), "k").collect()
    assert len({r.text for r in out}) == len(out) and all(r.n_ssn + r.n_date == 1 for r in out)
    again = pseudonyms.pseudonymise(spark.createDataFrame([(r.doc_id, r.text) for r in out], "doc_id long, text string"), "k").collect()
    assert all(r.n_ssn + r.n_date == 1 for r in again), "a pseudonym is valid in its kind"


OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
FORMS = [  # plain forms, in the order in which they are tried at a place
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    rf"(?<![0-9.]){OCTET}\.{OCTET}\.{OCTET}\.{OCTET}(?![0-9]|\.[0-9])",
    r"(?<![0-9/.-])(?:(?:19|20)\d\d-[01]\d-[0-3]\d|[0-3]\d/[01]\d/(?:19|20)\d\d|[0-3]\d\.[01]\d\.(?:19|20)\d\d)(?![0-9]|[/.-][0-9])",
    r"(?<![0-9-])\d{3}-\d\d-\d{4}(?![0-9]|-[0-9])",
    r"(?<![0-9+])\+\d{1,3}[ .-]?\(?\d{2,4}\)?[ .-]?\d{3,4}[ .-]?\d{3,4}(?![0-9])",
    r"(?<![0-9+])\d(?:[ -]?\d){12,18}(?![0-9])",
]


def brute_private(t):
    """kind:start:end of each valid value, by plain search and arithmetic."""
    out = []
    for m in re.finditer("|".join(f"({f})" for f in FORMS), t, re.ASCII):
        kind, x = ("email", "ip", "date", "ssn", "phone", "card")[m.lastindex - 1], m[0]
        if kind == "date":
            y, mo, d = (int(v) for v in (x.split("-") if "-" in x else reversed(re.split("[/.]", x))))
            ok = 1 <= mo <= 12 and 1 <= d <= calendar.monthrange(y, mo)[1]
        elif kind == "ssn":
            a, g, n = x.split("-")
            ok = a not in ("000", "666") and a[0] != "9" and g != "00" and n != "0000"
        else:
            ok = kind != "card" or luhn(re.sub("[ -]", "", x))
        if ok:
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def test_pseudonym_places_match_plain_search(spark):
    rng = random.Random(11)
    parts = ["4785380592391139", "4785-3805-9239-1139", "4785380592391138", "jo.doe@a-b.example.com", "x1@c.org", "a@b", "a@b..com", "a@x.co1", "_%+-@m.de", "é@ü.de",
             "152.143.123.131", "999.1.1.1", "1.2.3.4.5", "2021-02-28", "2021-02-30", "28/02/2021", "28.02.2021", "123-45-6789", "666-45-6789", "000-12-3456",
             "+1 (988) 555-2485", "+49 30 1234 5678", "base64", "@", ".", "-", "com", "a", "12", "\U0001f600"]
    texts = ["".join(rng.choice(parts) + rng.choice(["", "", " ", ", ", "\n"]) for _ in range(rng.randrange(1, 14))) for _ in range(3000)]
    got = pseudonyms.pseudonymise(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "key").select("doc_id", "spans").collect()
    for r in got:
        assert r.spans == brute_private(texts[r.doc_id]), texts[r.doc_id]


def test_pseudonyms_of_very_long_runs(spark):
    """Runs that made the e-mail form recurse once a label, or try every place of a run."""
    n = 1_000_000
    rows = [(1, "x@" + "a." * (n // 2) + "com"), (2, "aB3" * (n // 3)), (3, "x@" + "a" * n), (4, "a@" * (n // 2)), (5, "12345678901" * (n // 11)), (6, "u." * (n // 2) + "v@w.org")]
    began = time.monotonic()
    got = {r.doc_id: r for r in pseudonyms.pseudonymise(spark.createDataFrame(rows, "doc_id long, text string"), "key").collect()}
    assert time.monotonic() - began < 60
    assert all(got[k].text == t for k, t in rows[:5]) and got[6].spans == f"email:0:{n + 7}"


ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)


def brute_secrets(t):
    spans = [[(m.start(), 0, f"assign:{m.start()}:{m.end()}") for m in ASSIGN.finditer(t) if len(m[2]) >= 6]]
    spans.append([(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20])
    spans.append([(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24])
    return (*map(len, spans), hashlib.sha256(",".join(x[2] for x in sorted(sum(spans, []))).encode()).hexdigest())


def test_secrets(spark, documents):
    rng = random.Random(4)
    pieces = ["password", "PassWd", "api_key", "apikey", "Token", "secret", "=", ": ", " ", '"', "'", "abc", "abcdefgh", "0123456789abcdef", "AKIA", "ABCDEFGHIJKLMNOP", "é", "\U0001f600", "\n", "ſecret", "ghp_" + "a1" * 18, "-----BEGIN RSA PRIVATE KEY-----"]
    rows = [(k, "".join(rng.choice(pieces) for _ in range(rng.randrange(40)))) for k in range(400)] + corpus(9)
    got = secret_scan.secrets(frame(spark, rows)).collect()
    assert Counter((i, *brute_secrets(t or "")) for i, t in rows) == Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got)
    assert any("ghp:" in r.spans for r in got) and any("pem:" in r.spans for r in got)
    real = {r.doc_id: (r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in secret_scan.secrets(documents).collect()}
    assert real == {r.doc_id: brute_secrets(r.text) for r in documents.select("doc_id", "text").collect()}
    assert secret_scan.secrets(frame(spark, [])).count() == 0


def test_trigram_queries():
    q = secret_scan.trigram_query
    assert q("abcd") == [frozenset({"abc", "bcd"})]
    assert q("ab.cd") is None and q("(abc|x)") is None
    assert q("(abc|xyz)d?") == [frozenset({"abc"}), frozenset({"xyz"})]
    assert q("(?i:ABC)[0-9]+def") == [frozenset({"abc", "def"})]
    assert q("a{3}") is not None and q("[0-9a-f]{24,}") is None


def test_index_has_every_posting(spark):
    rows = [(1, "my TOKEN here"), (2, "nothing"), (None, "token"), (3, None)]
    index = secret_scan.build_index(frame(spark, rows))
    got = {(r.gram, r.doc_id) for r in index.where(F.col("gram").isin("tok", "oke", "ken")).collect()}
    assert got == {(g, i) for g in ("tok", "oke", "ken") for i in (1, None)}
