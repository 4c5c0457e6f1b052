"""A deterministic in-memory feed for the paged data source tests."""

from __future__ import annotations

import datetime as _dt

RECORDS = [{"id": f"t{i:03d}", "updatedAt": (_dt.date(2024, 3, 1) + _dt.timedelta(days=i % 20)).isoformat()
            + "T10:00:00Z", "title": f"ticket {i}"} for i in range(57)]
_FAILED: set = set()


def fetch(entity, filters, cursor, limit):
    """Serve pages of ``limit`` records; the first request of every page fails once."""
    key = (entity, tuple(sorted(filters.items())), cursor)
    if key not in _FAILED:
        _FAILED.add(key)
        raise ConnectionError("transient")
    rows = RECORDS
    if "id" in filters:
        rows = [r for r in rows if r["id"] == filters["id"]]
    lo, hi = filters.get("modifiedAfter"), filters.get("modifiedBefore")
    if lo:
        rows = [r for r in rows if r["updatedAt"][:10] >= lo]
    if hi:
        rows = [r for r in rows if r["updatedAt"][:10] <= hi]
    start = int(cursor or 0)
    page = rows[start:start + limit]
    nxt = start + limit
    return {"data": page, "cursors": {"next": str(nxt) if nxt < len(rows) else None, "hasNext": nxt < len(rows)}}


def fetch_logged(entity, filters, cursor, limit):
    """One page of one record; every request leaves a file in the folder that the entity names."""
    import os
    import uuid

    with open(os.path.join(entity, uuid.uuid4().hex), "w") as f:
        f.write(f"page:{cursor}")
    return {"data": [{"id": "u1", "updatedAt": None}], "cursors": {}}


def fetch_threads(entity, filters, cursor, limit):
    """Ten conversations and a listed record without id; c9 has no detail, the messages of c8 fail."""
    if entity == "conversations":
        rows = [{"id": f"c{k}", "updatedAt": "2024-03-01T10:00:00Z"} for k in range(10)] + [{"updatedAt": "2024-03-01"}]
        return {"data": rows, "cursors": {}}
    if entity == "conversation":
        return None if filters["id"] == "c9" else {"id": filters["id"], "detail": True}
    key = filters["conversationId"]
    if key == "c8":
        raise ConnectionError("down")
    m = int(cursor or 0)
    return {"data": [{"id": f"{key}-m{m}", "updatedAt": "2024-03-02"}], "cursors": {"next": str(m + 1) if m < 1 else None, "hasNext": m < 1}}
