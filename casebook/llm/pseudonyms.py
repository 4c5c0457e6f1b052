"""Format-preserving pseudonyms for personal data, in DataFrame operations only.

Numbers and dates that pass their kind's validation are replaced by a keyed permutation of the same format:
a Feistel network over the value's own domain, split as ``a * b`` values; rounds add a keyed hash of one part
to the other part modulo its size, so the result always lies in the domain again and the map is one to one.
Equal values get equal pseudonyms in every document, whatever their separators, and ``reverse=True`` undoes it.

* card: 12 to 18 payload digits are permuted, the Luhn digit is computed anew; separators stay
* ip: the 32 bits of a dotted IPv4 address
* phone: the digits after the country code; signs and grouping stay
* ssn: valid area (001-899 without 666), group and serial numbers
* date: the days from 1900-01-01 to 2099-12-31, written as found (Y-M-D, D/M/Y or D.M.Y)
* email: letters and digits of the local part, each within its own class; the domain stays

Edge cases: null text counts as empty; a value that fails validation stays as it is; rows are treated each by
itself, repeated ones alike; a null doc_id is kept; an empty table gives no rows; other columns are ignored.
The key is a literal of the plan: keep event logs and plans as secret as the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.llm.frames import text_column

ROUNDS = 8
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
KINDS = {  # in the order in which they are tried at a place
    # A run of local characters is tried once, from its start or from the end of the match before; a domain has at most
    # 127 labels (DNS allows no more), which bounds the depth of the matcher's recursion.
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++){0,125}\.[A-Za-z]{2,}",
    "ip": rf"(?<![0-9.]){OCTET}(?:\.{OCTET}){{3}}(?![0-9]|\.[0-9])",
    "date": r"(?<![0-9/.-])(?:(?:19|20)[0-9]{2}-[01][0-9]-[0-3][0-9]|[0-3][0-9]([/.])[01][0-9]\1(?:19|20)[0-9]{2})(?![0-9]|[/.-][0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])",
    "phone": r"(?<![0-9+])\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])",
    "card": r"(?<![0-9+])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])",
}
ANY = "|".join(f"(?:{p})" for p in KINDS.values())


def _quote(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


class _Sql:
    """SQL texts of the permutations under one key."""

    def __init__(self, key: str, reverse: bool):
        self.key, self.sign = _quote(key), "-" if reverse else "+"
        self.rounds = f"sequence({ROUNDS}, 1, -1)" if reverse else f"sequence(1, {ROUNDS})"

    def noise(self, kind: str, *parts: str) -> str:
        return f"cast(conv(substr(sha2(concat_ws('|', {self.key}, '{kind}', {', '.join(parts)}), 256), 1, 15), 16, 10) as bigint)"

    def feistel(self, kind: str, left: str, a: str, right: str, b: str, done: str) -> str:
        """``done`` turns the final ``acc.l`` and ``acc.r`` into the result."""
        return (
            f"aggregate({self.rounds}, named_struct('l', cast({left} as bigint), 'r', cast({right} as bigint), 'a', cast({a} as bigint), 'b', cast({b} as bigint)), "
            f"(acc, i) -> if(i % 2 = 1, "
            f"named_struct('l', pmod(acc.l {self.sign} {self.noise(kind, 'i', 'acc.a', 'acc.r')} % acc.a, acc.a), 'r', acc.r, 'a', acc.a, 'b', acc.b), "
            f"named_struct('l', acc.l, 'r', pmod(acc.r {self.sign} {self.noise(kind, 'i', 'acc.b', 'acc.l')} % acc.b, acc.b), 'a', acc.a, 'b', acc.b)), acc -> {done})"
        )

    def digits(self, kind: str, d: str) -> str:
        """A permutation of digit strings of one length (2 to 36)."""
        n, h = f"char_length({d})", f"(char_length({d}) div 2)"
        return self.feistel(
            kind, f"substr({d}, 1, {h})", f"power(10, {h})", f"substr({d}, {h} + 1)", f"power(10, {n} - {h})", f"concat(lpad(acc.l, {h}, '0'), lpad(acc.r, {n} - {h}, '0'))"
        )

    def email(self, x: str) -> str:
        local = f"substring_index({x}, '@', 1)"
        h = f"(char_length({local}) div 2)"

        def shifted(part: str, other: str) -> str:
            def turn(low: int, size: int) -> str:
                return f"chr({low} + pmod(ascii(c) - {low} {self.sign} {self.noise('email', 'i', 'j', 'o')} % {size}, {size}))"

            # the other half is digested once, not anew for each letter
            letters = (
                f"array_join(transform(split({part}, ''), (c, j) -> case when c between 'a' and 'z' then {turn(97, 26)} "
                f"when c between 'A' and 'Z' then {turn(65, 26)} when c between '0' and '9' then {turn(48, 10)} else c end), '')"
            )
            return f"transform(array(sha2({other}, 256)), o -> {letters})[0]"

        return (
            f"concat(aggregate({self.rounds}, named_struct('l', substr({local}, 1, {h}), 'r', substr({local}, {h} + 1)), "
            f"(acc, i) -> if(i % 2 = 1, named_struct('l', {shifted('acc.l', 'acc.r')}, 'r', acc.r), named_struct('l', acc.l, 'r', {shifted('acc.r', 'acc.l')})), "
            f"acc -> concat(acc.l, acc.r)), '@', substring_index({x}, '@', -1))"
        )

    def ip(self, x: str) -> str:
        part = [f"cast(split_part({x}, '.', {k}) as bigint)" for k in range(1, 5)]
        return self.feistel(
            "ip", f"{part[0]} * 256 + {part[1]}", "65536", f"{part[2]} * 256 + {part[3]}", "65536", "concat_ws('.', acc.l div 256, acc.l % 256, acc.r div 256, acc.r % 256)"
        )

    def date(self, x: str) -> str:
        """73,049 days are 229 * 319 values."""
        form = f"if({x} like '%-%', 'yyyy-MM-dd', if({x} like '%/%', 'dd/MM/yyyy', 'dd.MM.yyyy'))"
        day = f"datediff({self.day(x)}, date'1900-01-01')"
        return f"date_format(date_add(date'1900-01-01', cast({self.feistel('date', f'{day} div 319', '229', f'{day} % 319', '319', 'acc.l * 319 + acc.r')} as int)), {form})"

    @staticmethod
    def day(x: str) -> str:
        iso = f"if({x} like '%-%', {x}, concat_ws('-', substr({x}, 7, 4), substr({x}, 4, 2), substr({x}, 1, 2)))"
        return f"try_cast({iso} as date)"

    def ssn(self, x: str) -> str:
        area = f"cast(substr({x}, 1, 3) as bigint)"
        rest = f"(cast(substr({x}, 5, 2) as bigint) - 1) * 9999 + cast(substr({x}, 8, 4) as bigint) - 1"
        done = "concat_ws('-', lpad(acc.l + if(acc.l < 665, 1, 2), 3, '0'), lpad(acc.r div 9999 + 1, 2, '0'), lpad(acc.r % 9999 + 1, 4, '0'))"
        return self.feistel("ssn", f"{area} - if({area} < 666, 1, 2)", "898", rest, "989901", done)

    @staticmethod
    def luhn(payload: str) -> str:
        """The check digit of a payload."""
        total = (
            f"aggregate(transform(split(reverse({payload}), ''), (c, j) -> if(j % 2 = 0, "
            f"if(cast(c as int) > 4, cast(c as int) * 2 - 9, cast(c as int) * 2), cast(c as int))), 0, (s, v) -> s + v)"
        )
        return f"((10 - {total} % 10) % 10)"

    @staticmethod
    def refilled(x: str, skip: str, fresh: str) -> str:
        """``x`` whose digits after the first ``skip`` characters are, in order, those of ``fresh``."""
        return (
            f"aggregate(split(substr({x}, {skip} + 1), ''), named_struct('out', substr({x}, 1, {skip}), 'd', {fresh}), "
            f"(acc, c) -> if(c between '0' and '9', named_struct('out', concat(acc.out, substr(acc.d, 1, 1)), 'd', substr(acc.d, 2)), "
            f"named_struct('out', concat(acc.out, c), 'd', acc.d)), acc -> acc.out)"
        )

    def card(self, x: str) -> str:
        # one-element transforms name a value once, so that it is not computed for each use
        payload = f"regexp_replace({x}, '[^0-9]', '')"
        payload = f"substr({payload}, 1, char_length({payload}) - 1)"
        fresh = f"transform(transform(array({payload}), p -> {self.digits('card', 'p')}), q -> concat(q, {self.luhn('q')}))[0]"
        return self.refilled(x, "0", fresh)

    def phone(self, x: str) -> str:
        code = f"char_length(regexp_extract({x}, '^[+](1(?=[^0-9])|[0-9]{{1,3}}(?=[^0-9])|[0-9]{{2}})', 0))"
        return f"transform(array({code}), k -> {self.refilled(x, 'k', self.digits('phone', f'''regexp_replace(substr({x}, k + 1), '[^0-9]', '')'''))})[0]"

    def kind(self, x: str) -> str:
        """The kind of a match that passes validation, else null."""
        d = f"regexp_replace({x}, '[^0-9]', '')"
        return (
            f"case when {x} like '%@%' then 'email' when {x} rlike '^[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+$' then 'ip' "
            f"when char_length({x}) = 10 and {x} rlike '^([0-9]{{4}}-|[0-9]{{2}}[/.])' then if({self.day(x)} is not null, 'date', null) "
            f"when char_length({x}) = 11 and {x} rlike '^[0-9]{{3}}-[0-9]{{2}}-' then if({x} rlike '^(?!000|666|9)[0-9]{{3}}-(?!00)[0-9]{{2}}-(?!0000)', 'ssn', null) "
            f"when {x} like '+%' then 'phone' "
            f"when cast(substr({d}, -1) as int) = {self.luhn(f'substr({d}, 1, char_length({d}) - 1)')} then 'card' end"
        )

    def replaced(self, x: str, kind: str) -> str:
        whens = " ".join(f"when '{k}' then {getattr(self, k)(x)}" for k in KINDS)
        return f"case {kind} {whens} else {x} end"


def found(text: str = "text") -> Column:
    """Array of the places where a kind's form occurs: (gap before it, value), and the tail with a null value."""
    p = _quote(ANY)
    return F.expr(f"if({text} rlike '[0-9@]', zip_with(split({text}, {p}, -1), regexp_extract_all({text}, {p}, 0), (g, h) -> named_struct('gap', g, 'hit', h)), array(named_struct('gap', {text}, 'hit', cast(null as string))))")


def pseudonymise(docs: DataFrame, key: str, *, reverse: bool = False) -> DataFrame:
    """One row per document: doc_id, text with pseudonyms, n_<kind> and spans (``kind:start:end`` in the input's code points)."""
    sql = _Sql(key, reverse)
    parts = docs.select("doc_id", text_column().alias("text")).select("doc_id", found().alias("_parts"))
    kinds = parts.withColumn(
        "_parts",
        F.expr(f"transform(_parts, x -> named_struct('gap', x.gap, 'hit', x.hit, 'kind', if(x.hit is null, null, {sql.kind('x.hit')})))"),
    )
    spans = F.expr(
        "aggregate(_parts, named_struct('at', 0, 'out', cast(array() as array<string>)), (acc, x) -> named_struct("
        "'at', acc.at + char_length(x.gap) + coalesce(char_length(x.hit), 0), "
        "'out', if(x.kind is null, acc.out, concat(acc.out, array(concat(x.kind, ':', acc.at + char_length(x.gap), ':', acc.at + char_length(x.gap) + char_length(x.hit)))))), "
        "acc -> array_join(acc.out, ','))"
    )
    fresh = F.expr(f"array_join(transform(_parts, x -> concat(x.gap, if(x.kind is null, coalesce(x.hit, ''), {sql.replaced('x.hit', 'x.kind')}))), '')")
    return kinds.select(
        "doc_id", fresh.alias("text"), *[F.expr(f"cast(size(filter(_parts, x -> x.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in KINDS], spans.alias("spans")
    )
