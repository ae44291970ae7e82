from ontime.sources.footers import footer_columns, lacking
from ontime.sources.landing import (
    landing_inventory,
    missing_columns,
    read_cleaned,
    read_files,
    read_landing,
    refuse,
)
from ontime.sources.ledger import due_files, last_notes, next_run, note, read_notes
from ontime.sources.zones import (
    drop_partitions,
    read_chart,
    read_zone,
    save_model,
    write_chart,
    write_zone,
)

__all__ = [
    "drop_partitions",
    "due_files",
    "footer_columns",
    "lacking",
    "landing_inventory",
    "last_notes",
    "missing_columns",
    "next_run",
    "note",
    "read_files",
    "read_notes",
    "refuse",
    "read_chart",
    "read_cleaned",
    "read_landing",
    "read_zone",
    "save_model",
    "write_chart",
    "write_zone",
]
