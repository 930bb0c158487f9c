from barlake.sources.adapters import bars_to_payloads, events_to_bars
from barlake.sources.catalog import (
    create_silver_tables,
    create_tables,
    drop_silver_tables,
    drop_tables,
    drop_unused,
    insert_table,
    swap_days,
    sync_partitions,
)
from barlake.sources.lease import WriterBusy, writer
from barlake.sources.payloads import payload_stream, read_payloads
from barlake.sources.tables import (
    filter_bars,
    read_bars,
    read_table,
    replace_days,
    write_csv,
    write_table,
)

__all__ = [
    "WriterBusy",
    "bars_to_payloads",
    "create_silver_tables",
    "create_tables",
    "drop_silver_tables",
    "drop_tables",
    "drop_unused",
    "events_to_bars",
    "filter_bars",
    "insert_table",
    "payload_stream",
    "read_bars",
    "read_payloads",
    "read_table",
    "replace_days",
    "swap_days",
    "sync_partitions",
    "write_csv",
    "write_table",
    "writer",
]
