from windrow.sinks.names import resolve_date_dirs, windowed_filename
from windrow.sinks.tables import append_table, write_avro_file
from windrow.sinks.text import write_single_text
from windrow.sinks.windowed import (
    write_one_file_per_window,
    write_windowed_partitions,
    write_windowed_text,
)

__all__ = [
    "append_table",
    "resolve_date_dirs",
    "windowed_filename",
    "write_avro_file",
    "write_one_file_per_window",
    "write_single_text",
    "write_windowed_partitions",
    "write_windowed_text",
]
