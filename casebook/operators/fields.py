"""Custom-field work: labels, map merge, payloads, id lookups, paging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.config import Settings
from casebook.functions import columns as C


def field(fields_col: str | Column, field_id: str) -> Column:
    """Value of one custom field (NULL when the map or the key is missing)."""
    m = F.col(fields_col) if isinstance(fields_col, str) else fields_col
    return F.try_element_at(m, F.lit(field_id))


def with_categories(tickets: DataFrame, cfg: Settings, fields_col: str = "ticketTypeFields") -> DataFrame:
    return tickets.withColumn("category", field(fields_col, cfg.category_field_id)) \
                  .withColumn("sub_category", field(fields_col, cfg.sub_category_field_id))


def migrated_fields(tickets: DataFrame, cfg: Settings, variant: str = "a",
                    fields_col: str = "ticketTypeFields") -> DataFrame:
    """Tickets with the migration label and the merged field map (others kept)."""
    t = with_categories(tickets, cfg, fields_col)
    lab = C.label_a("category", "sub_category") if variant == "a" else C.label_b("category", "sub_category")
    t = t.withColumn("migration_label", lab)
    return t.withColumn("new_fields", C.put_field(fields_col, cfg.migration_field_id, F.col("migration_label")))


def field_map(cfg: Settings, values: dict[str, Column]) -> Column:
    """Field name -> value columns as a map keyed by the configured field ids."""
    ids = cfg.field_ids()
    items: list[Column] = []
    for name, v in values.items():
        items += [F.lit(ids[name]), v.cast("string")]
    return F.create_map(*items)


def payload(fields: Column, wrap: bool = True, drop_blank: bool = False) -> Column:
    """JSON request body. ``wrap`` nests the fields under ``ticketTypeFields``
    (NULL values kept); otherwise they are top level. ``drop_blank`` keeps
    only non-empty values (an empty result means nothing is sent)."""
    m = C.drop_blank_values(fields) if drop_blank else fields
    return F.to_json(F.struct(m.alias("ticketTypeFields"))) if wrap else F.to_json(m)


def explode_fields(df: DataFrame, key: str, fields: str) -> DataFrame:
    """``(key, field_key, field_value)``; a row with NULL key/value for an empty map."""
    return df.select(key, F.explode_outer(fields).alias("field_key", "field_value"))


def page(df: DataFrame, order_by: list[Column], page_no: int, page_size: int) -> DataFrame:
    """One page in a total order (``TakeOrderedAndProject`` with offset)."""
    return df.orderBy(*order_by).offset(page_no * page_size).limit(page_size)


def rows_by_ids(df: DataFrame, ids: DataFrame, key: str, id_col: str = "id") -> DataFrame:
    """Rows whose key is in ``ids`` (semi join; AQE broadcasts the id set
    when it is small, and shuffles both sides when it is not)."""
    return df.join(ids.select(F.col(id_col).alias("_id")), df[key] == F.col("_id"), "left_semi")


def missing_ids(ids: DataFrame, df: DataFrame, key: str, id_col: str = "id") -> DataFrame:
    """Requested ids with no row in ``df`` (anti join)."""
    return ids.select(id_col).distinct().join(df.select(F.col(key).alias("_k")), F.col(id_col) == F.col("_k"),
                                              "left_anti")


def modified_between(tickets: DataFrame, lo: str | None = None, hi: str | None = None,
                     ticket_id: str | None = None, updated_col: str = "updatedAt") -> DataFrame:
    """Tickets by id (takes precedence) or by the date part of ``updated_col``
    within ``[lo, hi]`` (either bound optional, both inclusive). Bounds are
    'YYYY-M-D' texts; an invalid bound raises."""
    if ticket_id is not None:
        return tickets.where(F.col("id") == ticket_id)
    day = C.as_day(updated_col)
    cond = F.lit(True)
    for bound, op in ((lo, "ge"), (hi, "le")):
        if bound is None:
            continue
        d = _parse_bound(bound)
        cond = cond & (day >= F.lit(d) if op == "ge" else day <= F.lit(d))
    return tickets.where(cond)


def _parse_bound(text: str):
    import datetime as _dt
    import re

    m = re.fullmatch(r"(\d{4})-(\d{1,2})-(\d{1,2})", text.strip())
    if not m:
        raise ValueError(f"invalid date {text!r}; expected YYYY-MM-DD")
    return _dt.date(int(m.group(1)), int(m.group(2)), int(m.group(3)))


def append_pages(pages: list[DataFrame]) -> DataFrame:
    """Bag union of pages by column name (column order may differ)."""
    out = pages[0]
    for p in pages[1:]:
        out = out.unionByName(p)
    return out
