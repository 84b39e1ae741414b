from tidemark.functions.casts import lenient_cast, parse_event_time, to_ntz
from tidemark.functions.envelope import (
    decode_envelope,
    encode_envelope,
    envelope_schema,
    envelope_view,
    minimal_order_event,
    split_keyed_line,
)

__all__ = [
    "decode_envelope", "encode_envelope", "envelope_schema", "envelope_view",
    "lenient_cast", "minimal_order_event", "parse_event_time", "split_keyed_line", "to_ntz",
]
