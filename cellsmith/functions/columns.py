"""Scalar column functions: Column -> Column, built-in Spark functions only.

No Python UDF is used anywhere, so every expression stays inside whole-stage
codegen (the higher-order ``aggregate`` in ``java_string_hash`` is the one
interpreted expression, and it only runs in the optional extended call key).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the reference's for identical keys and cells.
# ---------------------------------------------------------------------------
# Removed from phone numbers, in this order: space, no-break space,
# full-width hyphen, hyphen, full-width plus + 86, plus + 86.
PHONE_STRIP = (" ", "\u00a0", "\uff0d", "-", "\uff0b86", "+86")
# Text used for a missing tel in contact keys (and some contact cells).
NO_TEL = "noTel"
# Upper time bound of the recency key: 2050-01-01 00:00:00 at +08:00.
MAX_EPOCH = 2524579200
# Zone the reference's time text is read in (UTC+8, see MAX_EPOCH).
DEFAULT_ZONE = "Asia/Shanghai"
# Call direction codes.
DIAL_CODE = {"DIAL": "0", "DIALED": "1"}
DIAL_OTHER = "2"
# Product by id length: 12 -> "1", 14 -> "2", other -> "0".
PRODUCT_BY_LENGTH = {12: "1", 14: "2"}
PRODUCT_OTHER = "0"
# Width of the peer tail and its pad character.
PEER_TAIL_WIDTH = 4
PEER_TAIL_PAD = "0"
# Long-time input format and length.
LONG_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"
LONG_TIME_LENGTH = 23
# Message line layouts.
MESSAGE_LINE = "offset = %d, key = %s, value = %s"
# Prefix of the older consumer's message line.
CONSUMER_LINE_PREFIX = "this is kafka consumer : "
# Sample messages.
SAMPLE_NUMBER_PREFIX = "1860123458"
SAMPLE_TEXT = "hello kafka.javaapi.producer message %d"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_or_empty(c, dtype: T.DataType | None = None) -> Column:
    """Value as text, null as ``""``.

    Nested values (struct, array, map) are rendered as JSON text.
    """
    c = _col(c)
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        text = F.to_json(c)
    else:
        text = c.cast("string")
    return F.coalesce(text, F.lit(""))


def default_text(c, default: str = NO_TEL) -> Column:
    """``c`` or a default when null (P10). Empty text stays empty."""
    return F.coalesce(_col(c).cast("string"), F.lit(default))


def normalize_phone(c) -> Column:
    """Remove blanks, hyphens and +86 anywhere, in the fixed order."""
    out = _col(c)
    for s in PHONE_STRIP:
        out = F.replace(out, F.lit(s), F.lit(""))
    return out


def reverse_text(c) -> Column:
    """Text reversed by code point."""
    return F.reverse(_col(c).cast("string"))


def product_type(c) -> Column:
    """``1`` for 12-character ids, ``2`` for 14, else ``0``; null stays null."""
    c = _col(c)
    n = F.length(c)
    out = None
    for width, code in PRODUCT_BY_LENGTH.items():
        out = F.when(n == width, F.lit(code)) if out is None else out.when(n == width, F.lit(code))
    return F.when(c.isNull(), F.lit(None).cast("string")).otherwise(out.otherwise(F.lit(PRODUCT_OTHER)))


def dial_code(c) -> Column:
    """``DIAL`` -> ``0``, ``DIALED`` -> ``1``, anything else, null too -> ``2``."""
    c = _col(c)
    out = None
    for word, code in DIAL_CODE.items():
        out = F.when(c == word, F.lit(code)) if out is None else out.when(c == word, F.lit(code))
    return out.otherwise(F.lit(DIAL_OTHER))


def peer_tail(c) -> Column:
    """Last four characters, or right-padded with ``0`` to four."""
    c = _col(c)
    return F.when(
        F.length(c) >= PEER_TAIL_WIDTH, F.substring(c, -PEER_TAIL_WIDTH, PEER_TAIL_WIDTH)
    ).otherwise(F.rpad(c, PEER_TAIL_WIDTH, PEER_TAIL_PAD))


def _time_head(head: Column) -> Column:
    """Compact ``yyyyMMddHHmmss`` of a 19-character canonical time, else null."""
    canonical = F.translate(head, "0123456789", "0000000000") == F.lit("0000-00-00 00:00:00")
    return F.when(canonical & head.try_cast("timestamp_ntz").isNotNull(), F.translate(head, "- :", ""))


def compact_datetime(c) -> Column:
    """``yyyy-M-d H:m:s...`` -> ``yyyyMMddHHmmss`` (P5); null when not a valid time.

    The leading date-time is read leniently (one or two digit fields,
    trailing text ignored) and validated as a calendar time; the compact
    text is built with string functions only, so the session zone never
    applies.  Canonical text is checked without any pattern (digits mapped
    to 0 must give ``0000-00-00 00:00:00``); only other text has its
    standalone single digits zero-padded by one pattern replace first.
    """
    c = _col(c)
    fast = _time_head(F.substring(c, 1, 19))
    padded = F.regexp_replace(c, r"(?<![0-9])([0-9])(?![0-9])", "0$1")
    return F.coalesce(fast, _time_head(F.substring(padded, 1, 19)))


def compact_datetime_short(c) -> Column:
    """Compact time without the century: ``yyMMddHHmmss``."""
    return F.substring(compact_datetime(c), 3, 12)


def epoch_seconds(c, zone: str = DEFAULT_ZONE) -> Column:
    """First 23 characters as ``yyyy-MM-dd HH:mm:ss.SSS`` in ``zone`` -> epoch seconds.

    Unparseable text gives 0, text shorter than 23 characters gives null.
    Independent of the session time zone.
    """
    c = _col(c).cast("string")
    head = F.substring(c, 1, LONG_TIME_LENGTH)
    ts = F.try_to_timestamp(F.concat(head, F.lit(" " + zone)), F.lit(LONG_TIME_FORMAT + " VV"))
    seconds = F.coalesce(F.unix_timestamp(ts), F.lit(0).cast("long"))
    return F.when(F.length(c) >= LONG_TIME_LENGTH, seconds).otherwise(F.lit(None).cast("long"))


def fee_text(c) -> Column:
    """Integer text with default ``0`` (P14): missing -> ``0``, ``"12"`` -> ``12``.

    Text that is not a 32-bit integer (``12.5``, ``abc``) gives null, so that
    a job can reject it instead of taking it for a missing fee."""
    c = _col(c).cast("string")
    return F.when(c.isNull(), F.lit("0")).otherwise(c.try_cast("int").cast("string"))


def is_numeric(c) -> Column:
    """Whole text is one or more ASCII digits (F3). Null -> false."""
    return F.coalesce(_col(c).rlike(r"^[0-9]+\z"), F.lit(False))


def min_length(c, n: int) -> Column:
    """Text (null as ``""``) has at least ``n`` characters (F2)."""
    return F.length(text_or_empty(c)) >= n


def java_string_hash(c) -> Column:
    """``String.hashCode`` of the text as a signed 32-bit value (code units of the BMP)."""
    c = _col(c)
    codes = F.transform(F.split(c, ""), lambda ch: F.ascii(ch).cast("long"))
    h = F.aggregate(
        F.when(c == "", F.array().cast("array<bigint>")).otherwise(codes),
        F.lit(0).cast("long"),
        lambda acc, x: (acc * 31 + x) % F.lit(4294967296),
    )
    return F.when(h >= 2147483648, h - 4294967296).otherwise(h)


# ---------------------------------------------------------------------------
# Key builders
# ---------------------------------------------------------------------------

def contact_key(phone, tel) -> Column:
    """``reverse(phone) + "_" + (normalized tel or noTel)``."""
    return F.concat(reverse_text(phone), F.lit("_"), F.coalesce(normalize_phone(tel), F.lit(NO_TEL)))


def recency_key(mobile, created, zone: str = DEFAULT_ZONE, pad: int | None = None) -> Column:
    """``reverse(mobile) + "_" + (2524579200 - epoch seconds)``.

    The suffix is unpadded text like the reference's; ``pad=10`` left-pads it
    so that text order is newest first across the 10 to 9 digit change.
    """
    suffix = (F.lit(MAX_EPOCH) - epoch_seconds(created, zone)).cast("string")
    if pad:
        suffix = F.lpad(suffix, pad, "0")
    return F.concat(reverse_text(text_or_empty(mobile)), F.lit("_"), suffix)


def call_key(mobile, time, dial) -> Column:
    """``reverse(mobile)_yyyyMMddHHmmss_dial_`` (P13); null when the time is invalid."""
    return F.concat(
        reverse_text(mobile), F.lit("_"), compact_datetime(time), F.lit("_"), dial_code(dial), F.lit("_")
    )


def call_key_extended(mobile, time, dial, peer, details_id, item_id) -> Column:
    """Call key with peer tail, hash tail of the details id and product."""
    return F.concat(
        reverse_text(mobile), F.lit("_"), compact_datetime(time), F.lit("_"), dial_code(dial),
        F.lit("_"), peer_tail(peer), peer_tail(java_string_hash(details_id).cast("string")),
        F.lit("_"), product_type(item_id), F.lit("_"),
    )


# ---------------------------------------------------------------------------
# Message helpers
# ---------------------------------------------------------------------------

def format_message(offset, key, value) -> Column:
    """``offset = %d, key = %s, value = %s``."""
    return F.format_string(MESSAGE_LINE, _col(offset), _col(key), _col(value))


def prefixed_message(value, prefix: str = CONSUMER_LINE_PREFIX) -> Column:
    """Fixed prefix plus value."""
    return F.concat(F.lit(prefix), _col(value))


def message_key(ts=None) -> Column:
    """Epoch milliseconds as text (P18): of ``ts`` per row, else of the batch start."""
    src = F.current_timestamp() if ts is None else _col(ts)
    return F.unix_millis(src.cast("timestamp")).cast("string")


def sample_number(i) -> Column:
    """Sample phone number ``1860123458`` + i."""
    return F.concat(F.lit(SAMPLE_NUMBER_PREFIX), _col(i).cast("string"))


def sample_text(i) -> Column:
    """Sample text message ``hello ... message %d``."""
    return F.format_string(SAMPLE_TEXT, _col(i))
