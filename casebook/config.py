"""Run-time settings for the operators.

Everything the operators treat as a parameter (field ids, staff domain,
chat host, exclusion list, separators, defaults) lives here, so the same
operator runs against production documents and the test fixtures.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field, replace


# --- fixed values ---------------------------------------------------------
# These must equal the values the original tool uses for its results to match.
# Status remap: internal state -> reported label.
STATUS_REMAP = {"in_progress": "pending_customer", "on_hold": "pending_engineering"}
# Plan category when a customer has no first tag.
DEFAULT_PLAN_CATEGORY = "PAYG"
# Assignee label when no agent is assigned (missing or blank name).
UNASSIGNED_LABEL = "unassigned"
# Separator between messages in the SQL thread text (literal backslash-n,
# as the SQL dialect of the original keeps it).
SQL_THREAD_SEPARATOR = r"\n<Next_Message>:\n"
# Separator between messages of an embedded thread (real newlines).
EMBEDDED_THREAD_SEPARATOR = "\n<Next_Message>\n"
# Label joiner for the migration field.
LABEL_JOINER = " - "
# Text that marks an absent value in the migration log and warehouse.
NONE_TEXT = "None"
# Log line marker of a migration that produced an empty label, and id capture.
EMPTY_MIGRATION_MARKER = "'None' + 'None' -> ''"
MIGRATED_ID_PATTERN = r"Migrated ([a-f0-9-]+):"
# Classification error marker (stored for a failed model reply).
ERROR_LABEL = "Error"
# Batch prompt text around the numbered cases.
PROMPT_HEADER = "Please classify each of the following support cases:\n\n"
PROMPT_CASE = "Case {idx}:\n<Conversation>{text}</Conversation>\n\n"
PROMPT_FOOTER = "Please respond with a JSON array containing the classification for each case in order."
SINGLE_PROMPT = "Please classify this support case:\n\n<Conversation>{text}</Conversation>"
# Preview length for message text / titles in reports.
PREVIEW_CHARS = 100
TITLE_PREVIEW_CHARS = 50
# Resolution tags the resolution classifier must answer with.
RESOLUTION_TAGS = ["Referred with public resource", "Referred with internal knowledge",
                   "No public resource available", "Bug fix", "Feature Request", "No Action"]
# --- end of fixed values --------------------------------------------------


@dataclass(frozen=True, kw_only=True)
class Settings:
    """Operator parameters. ``replace(settings, x=...)`` derives variants. The ids of the ticket system's custom fields
    have no default: they belong to one installation."""

    category_field_id: str
    sub_category_field_id: str
    migration_field_id: str
    resolution_field_id: str
    cluster_field_id: str
    staff_domain: str = "example.dev"
    chat_host: str = "example.slack.com"
    excluded_senders: tuple[str, ...] = ()
    chat_source_type: str = "slack"
    link_base: str = "https://example.slack.com/app_redirect"
    ticket_emoji: str = "ticket"
    thread_separator: str = SQL_THREAD_SEPARATOR
    embedded_separator: str = EMBEDDED_THREAD_SEPARATOR
    default_plan_category: str = DEFAULT_PLAN_CATEGORY
    unassigned_label: str = UNASSIGNED_LABEL
    status_remap: tuple[tuple[str, str], ...] = tuple(STATUS_REMAP.items())
    as_of: _dt.date = field(default_factory=_dt.date.today)

    def field_ids(self) -> dict[str, str]:
        return {
            "category": self.category_field_id,
            "sub_category": self.sub_category_field_id,
            "migration": self.migration_field_id,
            "resolution": self.resolution_field_id,
            "cluster": self.cluster_field_id,
        }

    def with_(self, **kw) -> "Settings":
        return replace(self, **kw)


# Settings matching the fixture documents derived from the driver tables
# (FIXTURES.md section 3): staff domain, chat host, two excluded accounts,
# short field ids, and a fixed as-of date so results are reproducible.
FIXTURE_SETTINGS = Settings(
    staff_domain="staff.example",
    chat_host="chat.staff.example",
    excluded_senders=("agent0@staff.example", "agent1@staff.example"),
    chat_source_type="chat",
    link_base="https://chat.staff.example/app_redirect",
    category_field_id="cat",
    sub_category_field_id="sub",
    migration_field_id="mig",
    resolution_field_id="res",
    cluster_field_id="clu",
    as_of=_dt.date(2025, 1, 1),
)
