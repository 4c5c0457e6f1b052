"""Secret scans through a trigram inverted index, in DataFrame operations only.

Each rule's regex is turned into a Boolean query over lower-cased trigrams: an OR of alternatives, each an AND
of the trigrams that every match of the alternative must contain. ``build_index`` makes the posting list of each
trigram the rules mention, ``candidates`` intersects the lists and ``scan`` verifies the candidates with the
regexes. A rule that has no mandatory trigram scans every text.

Edge cases: null text counts as empty; a null doc_id is kept (joined null-safe); rows that repeat a doc_id are
scanned each by itself; an empty table gives no rows; a text without candidates gives zero counts, an empty
span list and the hash of the empty string; other columns are ignored. Offsets count code points, end exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

try:
    from re import _constants as sre, _parser as sre_parser
except ImportError:  # older interpreters
    import sre_constants as sre
    import sre_parse as sre_parser

from casebook.llm.frames import text_column


@dataclass(frozen=True)
class Rule:
    """``pattern`` holds for Java, RE2 and Python alike; ``group`` must have ``least`` characters or the match is dropped."""

    name: str
    pattern: str
    group: int = 0
    least: int = 0
    base: bool = True


# The base kinds, in their order. A run of 24 hex digits or an access id of 20 signs is matched
# as such: a shorter run can't contain one, so this equals matching any run and dropping the short ones.
BASE = (
    Rule("assign", r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
EXTRA = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", base=False),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+", base=False),
    Rule("ghp", r"ghp_[A-Za-z0-9]{36}", base=False),
)
RULES = BASE + EXTRA
MOST_ALTERNATIVES = 64
GAP = "\0"  # stands for text that the regex leaves open


def alternatives(pattern: str) -> set[str] | None:
    """Literal texts with gaps, one for each alternative of the regex; None: too many."""

    def walk(items) -> set[str]:
        out = {""}
        for op, arg in items:
            if op is sre.LITERAL:
                more = {chr(arg).lower()}
            elif op is sre.SUBPATTERN:
                more = walk(arg[-1])
            elif op is sre.BRANCH:
                more = set().union(*(walk(x) for x in arg[1]))
            elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
                low, high, inner = arg
                one = walk(inner)
                if high == 1 and GAP not in "".join(one):
                    more = one | ({""} if low == 0 else set())
                else:  # at least `low` copies stand side by side, then anything
                    more = {x * min(low, 3) + GAP for x in one} if low else {GAP}
            elif op is sre.AT:
                more = {""}
            else:
                more = {GAP}
            out = {a + b for a in out for b in more}
            if len(out) > MOST_ALTERNATIVES:
                raise OverflowError
        return out

    try:
        return walk(sre_parser.parse(pattern))
    except OverflowError:
        return None


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """OR of ANDs of trigrams; None if some alternative has no mandatory trigram."""
    found = alternatives(pattern)
    if found is None:
        return None
    query = {frozenset(p[i : i + 3] for p in x.split(GAP) for i in range(len(p) - 2)) for x in found}
    return None if frozenset() in query else sorted((q for q in query if not any(o < q for o in query)), key=sorted)


def build_index(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Posting lists: one row (gram, doc_id) for each trigram of the rules' queries that a text contains."""
    grams = sorted({g for r in rules for q in trigram_query(r.pattern) or () for g in q})
    low = docs.select("doc_id", F.lower(text_column()).alias("low"))
    present = F.array_compact(F.array(*[F.when(F.col("low").contains(g), F.lit(g)) for g in grams]))
    return low.select("doc_id", F.explode(present).alias("gram"))


def candidates(index: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, rules): the names of the indexed rules whose trigram query the document's postings satisfy."""
    by_doc = index.groupBy("doc_id").agg(F.collect_set("gram").alias("grams"))
    names = []
    for r in rules:
        if query := trigram_query(r.pattern):
            hit = F.lit(False)
            for grams in query:
                hit = hit | (F.size(F.array_intersect("grams", F.array(*map(F.lit, sorted(grams))))) == len(grams))
            names.append(F.when(hit, F.lit(r.name)))
    none = F.array().cast("array<string>")
    return by_doc.select("doc_id", (F.array_compact(F.array(*names)) if names else none).alias("rules")).where(F.size("rules") > 0)


def _literal(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _spans(rule: Rule, order: int, text: str = "text") -> Column:
    """Array of (start, order, span) of a rule's accepted matches: texts between matches give the offsets."""
    p = _literal(rule.pattern)
    return F.expr(
        f"""aggregate(
            zip_with(split({text}, {p}, -1), zip_with(regexp_extract_all({text}, {p}, 0), regexp_extract_all({text}, {p}, {rule.group}),
                (h, q) -> named_struct('hit', h, 'part', q)), (g, y) -> named_struct('gap', g, 'hit', y.hit, 'part', y.part)),
            named_struct('at', 0, 'out', cast(array() as array<struct<start:int,kind:int,span:string>>)),
            (acc, x) -> named_struct(
                'at', acc.at + char_length(x.gap) + coalesce(char_length(x.hit), 0),
                'out', if(x.hit is null or char_length(x.part) < {rule.least}, acc.out, concat(acc.out, array(named_struct(
                    'start', acc.at + char_length(x.gap), 'kind', {order},
                    'span', concat('{rule.name}:', acc.at + char_length(x.gap), ':', acc.at + char_length(x.gap) + char_length(x.hit))))))),
            acc -> acc.out)"""
    )


def scan(docs: DataFrame, found: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, spans by rule): each text is searched for the rules it is a candidate of and for those without a query."""
    texts = docs.select(F.col("doc_id"), text_column().alias("text"))
    got = found.select(F.col("doc_id").alias("_id"), F.col("rules").alias("_rules"))
    joined = texts.join(got, F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    none = F.expr("cast(array() as array<struct<start:int,kind:int,span:string>>)")
    out = []
    for k, r in enumerate(rules):
        look = F.coalesce(F.array_contains("_rules", r.name), F.lit(False)) if trigram_query(r.pattern) else F.col("text").rlike(r.pattern)
        out.append(F.when(look, _spans(r, k)).otherwise(none).alias(f"s_{r.name}"))
    return joined.select("doc_id", *out)


def secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: doc_id, n_<kind> of the base kinds, base_sha256 and all spans as ``kind:start:end``."""
    hits = scan(docs, candidates(build_index(docs, rules), rules), rules)

    def joined(some: list[Rule]) -> Column:
        return F.array_join(F.transform(F.array_sort(F.concat(*[F.col(f"s_{r.name}") for r in some])), lambda x: x["span"]), ",")

    base = [r for r in rules if r.base]
    return hits.select(
        "doc_id", *[F.size(f"s_{r.name}").cast("long").alias(f"n_{r.name}") for r in base], F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(list(rules)).alias("spans")
    )
