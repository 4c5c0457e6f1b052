"""Column expressions (all built-in Spark functions, so they stay in codegen).

Every function takes and returns ``pyspark.sql.Column`` and carries no state;
operators compose them inside ``select``/``withColumn``.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from casebook.config import LABEL_JOINER, NONE_TEXT

__all__ = [
    "blank_to_null", "status_label", "plan_category", "assignee", "as_day", "week_start", "age_days",
    "sender", "escalation_flag", "nonblank_text", "nonempty_text", "label_a", "label_b", "usable",
    "put_field", "drop_blank_values", "numeric_text", "link_timestamp", "deep_link", "hash_bucket",
    "preview", "strict_date", "date_part",
]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def blank_to_null(x) -> Column:
    """'' -> NULL, everything else unchanged."""
    return F.nullif(_c(x), F.lit(""))


def status_label(status, remap: Iterable[tuple[str, str]]) -> Column:
    """Map internal states to reported labels; other values (and NULL) pass through."""
    s = _c(status)
    out = None
    for src, dst in remap:
        out = (F.when(s == src, F.lit(dst)) if out is None else out.when(s == src, F.lit(dst)))
    return s if out is None else out.otherwise(s)


def plan_category(tags, default: str) -> Column:
    """Name of the first customer tag, ``default`` when there is none.

    ``get`` returns NULL past the end of the array (``tags[0]`` would raise
    under ANSI mode for an empty array)."""
    return F.coalesce(F.get(_c(tags), 0).getField("name"), F.lit(default))


def assignee(name, label: str) -> Column:
    return F.coalesce(blank_to_null(name), F.lit(label))


def as_day(text) -> Column:
    """ISO timestamp text -> DATE (NULL when unparsable)."""
    return _c(text).try_cast("date")


def week_start(day) -> Column:
    """Monday of the week of ``day``."""
    return F.trunc(_c(day), "week")


def age_days(status, closed_day, created_day, as_of: _dt.date) -> Column:
    """Closed tickets: closed - created; all others: as_of - created (days)."""
    end = F.when(_c(status) == "closed", _c(closed_day)).otherwise(F.lit(as_of))
    return F.datediff(end, _c(created_day))


def sender(user_email, sent_by_email) -> Column:
    """User email, or the sent-by email when the former is blank or missing."""
    return F.coalesce(blank_to_null(user_email), _c(sent_by_email))


def escalation_flag(text, sender_col, chat_host: str, staff_domain: str, excluded: Iterable[str]) -> Column:
    """Three-valued internal-escalation flag of one message.

    True when the text mentions the staff chat host (case-sensitive), or the
    lower-cased sender is in the staff domain and not an excluded account.
    NULL inputs propagate the SQL way (NULL OR TRUE is TRUE)."""
    s = F.lower(_c(sender_col))
    excluded = list(excluded)
    staff = s.like(f"%@{staff_domain}")
    if excluded:
        staff = staff & ~s.isin(excluded)
    return (F.instr(_c(text), chat_host) > 0) | staff


def nonblank_text(text) -> Column:
    """Text that is not NULL, not only spaces and not the two-quote literal."""
    t = _c(text)
    return t.isNotNull() & (F.trim(t) != "") & (t != '""')


def nonempty_text(text) -> Column:
    """Text that is neither NULL nor empty (the raw-message filter)."""
    t = _c(text)
    return t.isNotNull() & (t != "")


def label_a(category, sub) -> Column:
    """Migration label, variant A: 'c - s'; only one present -> that one; none -> ''."""
    return F.concat_ws(LABEL_JOINER, blank_to_null(category), blank_to_null(sub))


def usable(x) -> Column:
    """Value is present, not blank and not the text 'None'."""
    return ~F.coalesce(_c(x), F.lit("")).isin("", NONE_TEXT)


def label_b(category, sub) -> Column:
    """Migration label, variant B: no usable category -> '' (even with a sub);
    no usable sub -> category; else 'c - s'."""
    c, s = _c(category), _c(sub)
    return (F.when(~usable(c), F.lit(""))
            .when(~usable(s), c)
            .otherwise(F.concat(c, F.lit(LABEL_JOINER), s)))


def put_field(fields, key: str, value) -> Column:
    """Copy of the map with ``key`` set to ``value`` (overwrites; a NULL map counts as empty)."""
    m = F.coalesce(_c(fields), F.create_map().cast("map<string,string>"))
    rest = F.map_filter(m, lambda k, v: k != F.lit(key))
    return F.map_concat(rest, F.create_map(F.lit(key), _c(value)))


def drop_blank_values(m) -> Column:
    """Keep only entries whose value is neither NULL nor ''."""
    return F.map_filter(_c(m), lambda k, v: F.coalesce(v, F.lit("")) != "")


# A float literal as a Python float() call accepts it (no '_' separators, no
# inf/nan words); Spark's cast would otherwise also accept suffixes like '12d'.
_NUMERIC = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def numeric_text(x) -> Column:
    return _c(x).rlike(_NUMERIC)


def link_timestamp(ts) -> Column:
    """Timestamp text formatted with 6 decimals, trailing zeros and dot removed;
    text that is not a number is used as it is."""
    t = _c(ts)
    fixed = F.format_string("%.6f", F.trim(t).try_cast("double"))
    stripped = F.regexp_replace(F.regexp_replace(fixed, "0+$", ""), r"\.$", "")
    return F.when(numeric_text(t), stripped).otherwise(F.coalesce(t, F.lit(NONE_TEXT)))


def deep_link(channel, ts, base: str) -> Column:
    return F.concat(F.lit(f"{base}?channel="), F.coalesce(_c(channel), F.lit(NONE_TEXT)),
                    F.lit("&message_ts="), link_timestamp(ts))


def hash_bucket(text, modulus: int = 10) -> Column:
    """``int(md5(text) as 128-bit hex) % modulus`` with 64-bit arithmetic only.

    The digest is split in four 32-bit words a,b,c,d (big end first); the value
    is a*2^96 + b*2^64 + c*2^32 + d, so its residue is the weighted sum of the
    word residues with weights 2^(32i) mod modulus."""
    h = F.md5(_c(text))
    words = [F.conv(F.substring(h, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]
    weights = [pow(2, 32 * (3 - i), modulus) for i in range(4)]
    total = None
    for w, wt in zip(words, weights):
        term = F.pmod(w * F.lit(wt), F.lit(modulus))
        total = term if total is None else total + term
    return F.pmod(total, F.lit(modulus))


def preview(text, n: int) -> Column:
    """First ``n`` characters plus '...' when longer; NULL stays NULL."""
    t = _c(text)
    return F.when(F.length(t) > n, F.concat(F.substring(t, 1, n), F.lit("..."))).otherwise(t)


def strict_date(text) -> Column:
    """'2024-3-1' / '2024-03-01' -> DATE; anything else -> NULL."""
    t = _c(text)
    return F.when(t.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"), F.try_to_timestamp(t, F.lit("yyyy-M-d")).cast("date"))


def date_part(iso_text) -> Column:
    """Date part of an ISO timestamp text ('2024-03-01T10:00:00Z' -> '2024-03-01')."""
    return F.split(_c(iso_text), "T").getItem(0)


def literal_map(d: Mapping[str, str]) -> Column:
    items = []
    for k, v in d.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)
