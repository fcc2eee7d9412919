from windrow.sources.dead_letters import (
    dead_letter_files,
    dead_letter_messages,
    read_dead_letters,
    route_dead_letters,
)
from windrow.sources.messages import (
    decode_messages,
    load_avro_schema,
    read_messages,
    read_typed_messages,
)
from windrow.sources.text import read_lines

__all__ = [
    "dead_letter_files",
    "dead_letter_messages",
    "decode_messages",
    "load_avro_schema",
    "read_dead_letters",
    "read_lines",
    "read_messages",
    "read_typed_messages",
    "route_dead_letters",
]
