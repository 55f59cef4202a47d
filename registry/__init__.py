"""Registered queries over the given tables, each with its SQL counterpart where one exists."""

from registry import flow, layers, profiles, quality, reporting
from registry.entry import Entry

ENTRIES: dict[str, Entry] = {
    **layers.ENTRIES,
    **quality.ENTRIES,
    **profiles.ENTRIES,
    **flow.ENTRIES,
    **reporting.ENTRIES,
}
