"""Where purchase tables come from and where results go."""

from shopworth.sources.pinned import pin, pinned, release, scratch_folder
from shopworth.sources.tables import (
    load_customers,
    load_lines,
    load_orders,
    load_purchase_events,
    read_table,
    save,
)

__all__ = [
    "load_customers",
    "load_lines",
    "load_orders",
    "load_purchase_events",
    "pin",
    "pinned",
    "read_table",
    "release",
    "save",
    "scratch_folder",
]
