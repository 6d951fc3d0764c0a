"""cellsmith: PySpark operators that turn wide and nested contact, call and
document records into uniquely keyed, sorted key-value cells.

Every operator is a lazy DataFrame -> DataFrame (or Column -> Column)
transformation made of built-in Spark functions.  Only the sinks run actions.
"""

from cellsmith.functions.columns import (  # noqa: F401
    call_key, call_key_extended, compact_datetime, compact_datetime_short, contact_key, default_text,
    dial_code, epoch_seconds, fee_text, format_message, is_numeric, java_string_hash, message_key,
    min_length, normalize_phone, peer_tail, prefixed_message, product_type, recency_key, reverse_text,
    sample_number, sample_text, text_or_empty,
)
from cellsmith.operators.cells import sort_cells, sorted_cells, to_cells, with_order  # noqa: F401
from cellsmith.operators.keys import (  # noqa: F401
    dedup_keep_first, latest_per_key, sequence_key, sequence_number, unique_sequence_key,
)
from cellsmith.operators.nested import flatten_calls, json_encode, parse_calls  # noqa: F401
from cellsmith.operators.open_docs import (  # noqa: F401
    field_profile, flatten_open_calls, map_cells, open_cells, open_fields, open_schema, parse_open, row_maps,
)
from cellsmith.plans.accounts import write_calls, write_contacts, write_raw  # noqa: F401
from cellsmith.plans.jobs import (  # noqa: F401
    call_items, calls_to_cells, contact_rejects, contact_rows, contact_wide, contacts_latest,
    contacts_to_cells, contacts_to_cells_plain, raw_docs_to_cells, raw_rows,
)
from cellsmith.sinks.files import (  # noqa: F401
    check_staging, merge_cells, merge_rows, publish, publish_existing, read_cells, read_rows,
    staging_path, stream_upsert, upsert, write_sorted_cells,
)
from cellsmith.operators.ranges import number_ranges, ordered_keys, range_of, split_points  # noqa: F401
from cellsmith.sources.tables import (  # noqa: F401
    generate_numbers, generate_text, preview, preview_count, scan_documents, scan_parquet, scan_table,
)
from cellsmith.streaming.messages import (  # noqa: F401
    decode_messages, encode_messages, format_lines, prime_latest, read_messages, run_available,
    start_stream, write_messages,
)

__version__ = "0.1.0"
