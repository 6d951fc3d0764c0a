"""DuckDB SQL oracles: the same results computed independently, straight
from the driver tables (views ``orders``, ``lineitem``, ``events`` ...).

Fixtures are CTE snippets mirroring ``cellsmith.sources.fixtures``; the call
oracle works on ``lineitem`` directly, without JSON.
"""

from __future__ import annotations


def normalize_phone_sql(x: str) -> str:
    """DuckDB form of the fixed-order phone clean-up."""
    out = x
    for s in ("' '", "chr(160)", "chr(65293)", "'-'", "chr(65291) || '86'", "'+86'"):
        out = f"replace({out}, {s}, '')"
    return out


def dial_code_sql(x: str) -> str:
    return f"CASE WHEN {x} = 'DIAL' THEN '0' WHEN {x} = 'DIALED' THEN '1' ELSE '2' END"


CALL_ITEMS_RAW = """
call_raw AS (
  SELECT lpad(cast(l_suppkey AS varchar), CASE WHEN l_suppkey % 2 = 0 THEN 12 ELSE 14 END, '0') AS id,
         '139' || lpad(cast(l_suppkey // 2 AS varchar), 8, '0') AS mobile,
         l_orderkey, l_linenumber, l_shipdate,
         cast(l_orderkey AS varchar) || '-' || cast(l_linenumber AS varchar) AS details_id,
         CASE l_returnflag WHEN 'R' THEN 'DIAL' WHEN 'A' THEN 'DIALED' ELSE 'MISS' END AS dial_type,
         cast(cast(l_quantity AS bigint) AS varchar) AS duration,
         cast(l_linenumber AS varchar) AS fee,
         CAST(NULL AS varchar) AS location, CAST(NULL AS varchar) AS location_type,
         '+86 1380' || cast(l_partkey % 3 AS varchar) AS raw_peer,
         strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS time
  FROM lineitem)"""

# Item order inside a call: the line number, then the item's fields in
# document order, as the sorted collect of the Spark fixture does.
ITEM_ORDER = "l_linenumber, details_id, dial_type, duration, l_linenumber, raw_peer, time"

FLAT = CALL_ITEMS_RAW + f""",
call_flat AS (
  SELECT *, cast(dense_rank() OVER (PARTITION BY id ORDER BY l_orderkey) - 1 AS bigint) AS call_pos,
         cast(row_number() OVER (PARTITION BY id, l_orderkey ORDER BY {ITEM_ORDER}) - 1 AS bigint) AS item_pos
  FROM call_raw)"""

CALL_ITEMS = FLAT + f""",
call_items AS (
  SELECT reverse(mobile) || '_' || strftime(l_shipdate, '%Y%m%d%H%M%S') || '_' || {dial_code_sql('dial_type')} || '_' AS base,
         id, call_pos, item_pos, details_id, dial_type, duration, fee, location, location_type, mobile,
         {normalize_phone_sql('raw_peer')} AS peer_number, time
  FROM call_flat),
call_unique AS (
  SELECT * FROM call_items
  QUALIFY row_number() OVER (PARTITION BY base, peer_number, time ORDER BY id, call_pos, item_pos) = 1),
call_keyed AS (
  SELECT base || cast(row_number() OVER (PARTITION BY base ORDER BY id, call_pos, item_pos) - 1 AS varchar) AS rowkey,
         *
  FROM call_unique)"""

CALL_FIELDS = ("dial_type", "duration", "fee", "id", "location", "location_type", "mobile", "peer_number", "time")


CONTACTS = """
contacts AS (
  SELECT o_orderkey AS ord,
         '186' || lpad(cast(o_custkey AS varchar), 8, '0') AS phoneNo,
         CASE o_orderkey % 5 WHEN 0 THEN NULL
              WHEN 1 THEN '+86 138-' || n
              WHEN 2 THEN chr(65291) || '86138' || chr(65293) || n
              WHEN 3 THEN '138' || chr(160) || n
              ELSE '' END AS tel,
         o_orderpriority AS name
  FROM (SELECT *, lpad(cast(o_custkey % 97 AS varchar), 8, '0') AS n FROM orders) o),
contact_base AS (
  SELECT reverse(phoneNo) || '_' || coalesce(""" + normalize_phone_sql("tel") + """, 'noTel') AS base, *
  FROM contacts),
contact_rows AS (
  SELECT base AS rowkey, ord, phoneNo, coalesce(""" + normalize_phone_sql("tel") + """, '') AS tel, name
  FROM contact_base),
contact_seq AS (
  SELECT base || '_' || cast(row_number() OVER (PARTITION BY base ORDER BY ord) - 1 AS varchar) AS rowkey,
         ord, phoneNo, coalesce(""" + normalize_phone_sql("tel") + """, 'noTel') AS tel, name
  FROM contact_base)"""

FAULTY = """
faulty AS (
  SELECT o_orderkey % 13 AS r,
         lpad(cast(o_orderkey AS varchar), CASE WHEN o_orderkey % 13 = 11 THEN 13 ELSE 14 END, '0') AS id,
         CASE WHEN o_orderkey % 13 <> 6 THEN '139' || lpad(cast(o_custkey AS varchar), 8, '0') END AS mobile
  FROM orders),
faulty_item AS (
  SELECT *, CASE r WHEN 10 THEN '0' ELSE '12' END AS fee, CASE r WHEN 11 THEN '1' ELSE '1380001' END AS peer_number,
         CASE r WHEN 11 THEN '1000' ELSE '0001' END AS tail, CASE r WHEN 11 THEN '0' ELSE '2' END AS product,
         CASE r WHEN 11 THEN 'x' END AS location,
         reverse(mobile) || '_20171220164210_' || CASE r WHEN 11 THEN '1' ELSE '2' END || '_' AS base
  FROM faulty WHERE r IN (10, 11))"""

EPOCH = ("coalesce(cast(floor(epoch(try_cast(substring(create_time, 1, 23) AS timestamp))) AS bigint)"
         " - 28800, 0)")

RAW_DOCS = """
raw_t AS (
  SELECT *, strftime(ts - to_days(cast((event_id % 4) * 1000 AS int)), '%Y-%m-%d %H:%M:%S.%g') AS m
  FROM events),
raw_docs AS (
  SELECT lpad(cast(event_id AS varchar), CASE WHEN event_id % 2 = 0 THEN 12 ELSE 14 END, '0') AS _id,
         CASE WHEN event_id % 7 = 0 THEN substring(m, 1, 19)
              WHEN event_id % 11 = 0 THEN 'not a time ' || m
              ELSE m END AS create_time,
         CASE WHEN event_id % 13 = 0 THEN NULL
              ELSE '137' || lpad(cast(user_id AS varchar), 8, '0') END AS mobile,
         props AS moxie_carrier_originalInfo, event_type AS successFlag,
         cast(event_id AS varchar) AS task_id, CAST(NULL AS varchar) AS update_time
  FROM raw_t),
raw_kept AS (SELECT * FROM raw_docs WHERE length(coalesce(create_time, '')) >= 23),
raw_rows AS (
  SELECT reverse(coalesce(mobile, '')) || '_' || cast(2524579200 - """ + EPOCH + """ AS varchar) AS rowkey,
         coalesce(_id, '') AS _id, coalesce(create_time, '') AS create_time, coalesce(mobile, '') AS mobile,
         coalesce(moxie_carrier_originalInfo, '') AS moxie_carrier_originalInfo,
         coalesce(successFlag, '') AS successFlag, coalesce(task_id, '') AS task_id,
         coalesce(update_time, '') AS update_time
  FROM raw_kept)"""

RAW_FIELDS = ("_id", "create_time", "mobile", "moxie_carrier_originalInfo", "successFlag", "task_id", "update_time")

MESSAGES = """
messages AS (
  SELECT cast(event_id AS varchar) AS key,
         json_object('user_id', user_id, 'event_type', event_type)::varchar AS value,
         event_type AS topic, 0 AS "partition", event_id AS "offset", ts
  FROM events)"""

DOCS = """
docs AS (
  SELECT lpad(cast(l_suppkey AS varchar), CASE WHEN l_suppkey % 2 = 0 THEN 12 ELSE 14 END, '0') AS _id,
         '139' || lpad(cast(l_suppkey // 2 AS varchar), 8, '0') AS mobile,
         cast(count(DISTINCT l_orderkey) AS bigint) AS n_calls, cast(count(*) AS bigint) AS n_items
  FROM lineitem GROUP BY l_suppkey)"""


OPEN = """
open_raw AS (
  SELECT lpad(cast(event_id AS varchar), 12, '0') AS _id, event_id, event_type, cast(user_id % 50 AS varchar) AS u,
         props ->> '$.k' AS k,
         event_id % 29 = 0 OR event_id % 31 = 0 OR event_id % 37 = 0 OR event_id % 41 = 0 OR event_id % 43 = 0 AS bad
  FROM events),
open_text AS (
  SELECT *, '{"event_id":' || event_id || ',"' || event_type || '_k":' || k || ',"u' || u || '":"' || event_type || '"' AS head,
         head || CASE WHEN event_id % 3 = 0 THEN ',"nested":{"k":' || k || '}' ELSE '' END
         || CASE WHEN event_id % 5 = 0 THEN ',"tags":["a","' || event_type || '"]' ELSE '' END
         || CASE WHEN event_id % 7 = 0 THEN ',"note":null' ELSE '' END
         || CASE WHEN event_id % 11 = 0 THEN ',"flag":true' ELSE '' END || '}' AS whole
  FROM open_raw),
open_good AS (SELECT *, reverse(_id) AS rowkey FROM open_raw WHERE NOT bad),
open_fields AS (
  SELECT rowkey, 'event_id' AS qualifier, cast(event_id AS varchar) AS value, 'BIGINT' AS kind FROM open_good
  UNION ALL SELECT rowkey, event_type || '_k', k, 'BIGINT' FROM open_good
  UNION ALL SELECT rowkey, 'u' || u, event_type, 'STRING' FROM open_good
  UNION ALL SELECT rowkey, 'nested', '{"k":' || k || '}', 'OBJECT' FROM open_good WHERE event_id % 3 = 0
  UNION ALL SELECT rowkey, 'tags', '["a","' || event_type || '"]', 'ARRAY' FROM open_good WHERE event_id % 5 = 0
  UNION ALL SELECT rowkey, 'note', '', 'VOID' FROM open_good WHERE event_id % 7 = 0
  UNION ALL SELECT rowkey, 'flag', 'true', 'BOOLEAN' FROM open_good WHERE event_id % 11 = 0)"""


def peer_tail_sql(x: str) -> str:
    return f"CASE WHEN length({x}) >= 4 THEN right({x}, 4) ELSE rpad({x}, 4, '0') END"


def java_hash_sql(x: str) -> str:
    h = (f"list_reduce(list_transform(string_split({x}, ''), lambda ch: ascii(ch)::BIGINT), "
         f"lambda acc, v: (acc * 31 + v) % 4294967296, 0::BIGINT)")
    return f"(CASE WHEN {h} >= 2147483648 THEN {h} - 4294967296 ELSE {h} END)"


def product_sql(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN NULL WHEN length({x}) = 12 THEN '1' WHEN length({x}) = 14 THEN '2' ELSE '0' END"


def cells_sql(source: str, fields, key: str = "rowkey", family: str = "cf") -> str:
    """UNPIVOT of ``fields`` (null -> '') into cells; ``fields`` may include the key."""
    sel = ", ".join(f"coalesce(cast({f} AS varchar), '') AS {f}" for f in fields)
    on = ", ".join(fields)
    return (f"SELECT _k AS rowkey, '{family}' AS family, qualifier, value FROM "
            f"(UNPIVOT (SELECT {key} AS _k, {sel} FROM {source}) ON {on} INTO NAME qualifier VALUE value)")


def with_ctes(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body}"


def oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    norm_peer = normalize_phone_sql("raw_peer")
    cf = CONTACTS
    raw = RAW_DOCS
    msg = MESSAGES
    w3_cells = cells_sql("contact_seq", ("name", "phoneNo", "tel"))
    # sources
    q["scan_parquet"] = "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders"
    q["scan_table"] = "SELECT c_custkey, c_name, c_mktsegment FROM customer"
    q["scan_documents"] = with_ctes(DOCS, "SELECT _id, mobile, n_calls, n_items FROM docs")
    q["preview_count"] = ("SELECT cast(count(*) AS bigint) AS rows, "
                          "cast(least(count(*), 1000) AS bigint) AS preview_rows FROM orders")
    q["generate_numbers"] = ("SELECT cast(o_orderkey AS bigint) AS i, "
                             "'1860123458' || cast(o_orderkey AS varchar) AS value FROM orders")
    q["generate_text"] = ("SELECT cast(o_orderkey AS bigint) AS i, "
                          "printf('hello kafka.javaapi.producer message %d', o_orderkey) AS value FROM orders")
    # filters
    q["filter_not_null"] = with_ctes(raw, "SELECT _id, mobile FROM raw_docs WHERE mobile IS NOT NULL")
    q["filter_payload"] = with_ctes(raw, "SELECT _id, mobile, moxie_carrier_originalInfo FROM raw_docs "
                                    "WHERE successFlag <> 'signup' AND moxie_carrier_originalInfo IS NOT NULL")
    q["scan_bucketed"] = ("SELECT o_custkey, count(*) AS orders, min(o_orderkey) AS first_order, "
                          "max(o_orderkey) AS last_order FROM orders GROUP BY o_custkey")
    lines = ("SELECT *, CASE WHEN event_id % 17 = 0 THEN w[:-4] WHEN event_id % 19 = 0 THEN 'no document ' || event_id "
             "WHEN event_id % 23 = 0 THEN '{\"event_id\":\"x' || event_id || '\",\"event_type\":\"a\",\"user_id\":1}' ELSE w END AS line, "
             "event_id % 17 = 0 OR event_id % 19 = 0 OR event_id % 23 = 0 AS bad FROM (SELECT *, "
             "'{\"event_id\":' || event_id || ',\"event_type\":\"' || event_type || '\",\"user_id\":' || user_id || '}' AS w FROM events)")
    q["document_rejects"] = f"SELECT line, 'malformed' AS reason FROM ({lines}) WHERE bad"
    q["documents_checked"] = f"SELECT event_id, event_type, user_id FROM ({lines}) WHERE NOT bad"
    q["filter_min_length"] = with_ctes(raw, "SELECT _id, create_time FROM raw_kept")
    q["filter_numeric"] = with_ctes(cf, "SELECT ord, phoneNo, tel FROM contacts WHERE regexp_full_match("
                                    + normalize_phone_sql("tel") + ", '[0-9]+')")
    q["cells_drop_named"] = with_ctes(cf, cells_sql("contact_rows", ("name", "phoneNo", "rowkey", "tel")))
    q["cells_skip_key"] = with_ctes(raw, cells_sql("raw_rows", RAW_FIELDS))
    q["cells_with_key"] = with_ctes(raw, cells_sql("raw_rows", RAW_FIELDS + ("rowkey",)))
    # projections
    q["normalize_phone"] = with_ctes(cf, f"SELECT ord, {normalize_phone_sql('tel')} AS tel_norm FROM contacts")
    q["text_or_empty"] = with_ctes(raw, "SELECT _id, coalesce(mobile, '') AS mobile_text, "
                                   "coalesce(update_time, '') AS update_text FROM raw_docs")
    q["default_text"] = with_ctes(cf, "SELECT ord, coalesce(tel, 'noTel') AS tel_text FROM contacts")
    q["reverse_text"] = with_ctes(cf, "SELECT ord, reverse(phoneNo) AS phone_rev FROM contacts")
    q["contact_key"] = with_ctes(cf, "SELECT ord, base AS rowkey FROM contact_base")
    q["product_type"] = with_ctes(raw, f"SELECT _id, {product_sql('_id')} AS product FROM raw_docs")
    q["epoch_seconds"] = with_ctes(raw, f"SELECT _id, {EPOCH} AS epoch FROM raw_kept")
    q["recency_key"] = with_ctes(raw, "SELECT _id, rowkey FROM raw_rows")
    q["project_fields"] = with_ctes(raw, "SELECT * FROM raw_rows")
    compact = "strftime(l_shipdate, '%Y%m%d%H%M%S')"
    q["compact_datetime"] = with_ctes(FLAT, f"SELECT details_id, {compact} AS compact FROM call_flat")
    q["compact_datetime_short"] = with_ctes(
        FLAT, f"SELECT details_id, substring({compact}, 3, 12) AS compact FROM call_flat")
    q["dial_code"] = with_ctes(FLAT, f"SELECT details_id, {dial_code_sql('dial_type')} AS dial FROM call_flat")
    q["peer_tail"] = with_ctes(FLAT, f"SELECT details_id, {peer_tail_sql(norm_peer)} AS tail FROM call_flat")
    q["fee_text"] = with_ctes(FLAT, "SELECT details_id, fee FROM call_flat")
    base = f"reverse(mobile) || '_' || {compact} || '_' || {dial_code_sql('dial_type')} || '_'"
    q["call_key"] = with_ctes(FLAT, f"SELECT details_id, {base} AS base FROM call_flat")
    ext = (f"{base} || {peer_tail_sql(norm_peer)} || {peer_tail_sql(f'cast({java_hash_sql('details_id')} AS varchar)')}"
           f" || '_' || {product_sql('id')} || '_'")
    q["call_key_extended"] = with_ctes(FLAT, f"SELECT details_id, {ext} AS base FROM call_flat")
    q["format_message"] = with_ctes(
        msg, "SELECT printf('offset = %d, key = %s, value = %s', \"offset\", key, value) AS line, "
        "'this is kafka consumer : ' || value AS prefixed FROM messages")
    # JSON
    q["parse_calls"] = with_ctes(DOCS, "SELECT _id, mobile, true AS valid, n_calls FROM docs")
    q["flatten_calls"] = with_ctes(FLAT, "SELECT id, details_id, call_pos, item_pos, dial_type, duration, fee, "
                                   "raw_peer AS peer_number, time FROM call_flat")
    q["json_encode"] = ("SELECT event_id, json_object('user_id', user_id, 'event_type', event_type)::varchar "
                        "AS json FROM events")
    # documents without a declared schema
    q["open_rejects"] = with_ctes(OPEN, """SELECT _id, CASE WHEN event_id % 29 = 0 THEN head WHEN event_id % 31 = 0 THEN whole || ' {}'
        WHEN event_id % 37 = 0 THEN '{"a":1,"a":2}' WHEN event_id % 41 = 0 THEN '[1]' END AS payload FROM open_text WHERE bad""")
    q["open_calls"] = with_ctes(FLAT, "SELECT id, details_id, call_pos, item_pos, dial_type, duration, fee, "
                                "raw_peer AS peer_number, time FROM call_flat")
    q["open_profile"] = with_ctes(OPEN, "SELECT qualifier AS field, kind, count(*) AS documents FROM open_fields GROUP BY ALL")
    open_cells = "SELECT rowkey, 'cf' AS family, qualifier, value FROM open_fields"
    q["open_cells"] = with_ctes(OPEN, open_cells)
    q["map_cells"] = with_ctes(OPEN, open_cells)
    q["open_rows"] = with_ctes(OPEN, """SELECT rowkey, '{' || string_agg('"' || qualifier || '":"' || replace(value, '"', '\\"') || '"', ','
        ORDER BY qualifier) || '}' AS fields FROM open_fields GROUP BY rowkey""")
    # keys
    q["dedup_keep_first"] = with_ctes(CALL_ITEMS, "SELECT base, peer_number, time, id, details_id FROM call_unique")
    q["call_sequence"] = with_ctes(CALL_ITEMS, "SELECT rowkey, details_id FROM call_keyed")
    q["contact_sequence"] = with_ctes(cf, "SELECT ord, rowkey FROM contact_seq")
    latest = ("SELECT rowkey, cast(ord AS bigint) AS ord, phoneNo, tel, name FROM contact_rows "
              "QUALIFY row_number() OVER (PARTITION BY rowkey ORDER BY ord DESC) = 1")
    q["latest_per_key"] = with_ctes(cf, latest)
    # sort and reshape
    q["sort_cells"] = with_ctes(cf + ",\nw3 AS (" + w3_cells + ")",
                                "SELECT *, cast(row_number() OVER (ORDER BY rowkey, family, qualifier, value) "
                                "AS bigint) AS pos FROM w3")
    q["contact_cells_plain"] = with_ctes(cf, cells_sql("contact_rows", ("name", "phoneNo", "tel")))
    q["contact_cells"] = with_ctes(cf, w3_cells)
    q["contact_wide"] = with_ctes(cf, "SELECT rowkey, phoneNo, tel, name FROM contact_rows")
    # rows that cannot be keyed, and unusual ones that can
    q["call_rejects"] = with_ctes(FAULTY, """SELECT id, mobile, CASE WHEN r >= 7 AND r <= 9 THEN cast(0 AS bigint) END AS call_pos,
        CASE WHEN r >= 7 AND r <= 9 THEN cast(0 AS bigint) END AS item_pos,
        CASE WHEN r IN (1, 2, 3, 4, 12) THEN 'payload' WHEN r = 6 THEN 'id_or_mobile' WHEN r = 7 THEN 'peer_number'
             WHEN r = 8 THEN 'time' ELSE 'fee' END AS reason
        FROM faulty WHERE r IN (1, 2, 3, 4, 6, 7, 8, 9, 12)""")
    q["call_edges"] = with_ctes(FAULTY, "SELECT id, base, fee, peer_number, tail, product, location FROM faulty_item")
    q["contact_rejects"] = with_ctes(cf, "SELECT ord, tel, name, 'phone' AS reason FROM contacts WHERE ord % 17 = 0")
    # sinks
    q["raw_published"] = with_ctes(raw + """,
raw_latest AS (SELECT * FROM raw_rows QUALIFY row_number() OVER (
  PARTITION BY rowkey ORDER BY update_time DESC, create_time DESC, _id DESC) = 1)""", cells_sql("raw_latest", RAW_FIELDS))
    q["publish_order"] = with_ctes(cf + ",\nw3 AS (" + w3_cells + ")",
                                   "SELECT true AS sorted, cast(0 AS bigint) AS overlaps, cast(count(*) AS bigint) AS cells FROM w3")
    q["write_sorted_cells"] = with_ctes(cf, w3_cells)
    q["publish_cells"] = with_ctes(cf, w3_cells)
    points = " + ".join(f"(rowkey >= '{d}')::INT" for d in "123456789")
    q["write_split_cells"] = with_ctes(cf, f"SELECT *, {points} AS region FROM ({w3_cells})")
    q["stream_upsert"] = with_ctes(msg, "SELECT user_id, event_type, topic, \"offset\", true AS batches_kept FROM (SELECT topic, \"offset\", "
                                   "cast(value ->> '$.user_id' AS bigint) AS user_id, value ->> '$.event_type' AS event_type FROM messages) "
                                   "WHERE user_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY \"offset\" DESC) = 1")
    q["publish_existing"] = with_ctes(cf, w3_cells)
    q["upsert_wide"] = with_ctes(raw, "SELECT rowkey, _id, create_time, mobile, moxie_carrier_originalInfo, "
                                 "successFlag, cast(task_id AS bigint) AS task_id, update_time FROM raw_rows "
                                 "QUALIFY row_number() OVER (PARTITION BY rowkey ORDER BY cast(task_id AS bigint) DESC) = 1")
    # streams
    cols = 'SELECT key, value, topic, "offset" FROM messages'
    q["stream_read"] = with_ctes(msg, cols)
    q["stream_read_latest"] = with_ctes(msg, cols + " WHERE ts >= TIMESTAMP '2024-01-16 00:00:00'")
    q["stream_paced"] = with_ctes(msg, cols.replace(" FROM", ", true AS paced FROM"))
    q["stream_paced_bytes"] = with_ctes(msg, cols.replace(" FROM", ", true AS within_bytes FROM"))
    q["stream_resume"] = with_ctes(msg, cols)
    q["stream_topics"] = with_ctes(msg, cols + " WHERE topic IN ('click', 'purchase')")
    line = "printf('offset = %d, key = %s, value = %s', \"offset\", key, value) AS line"
    q["stream_format"] = with_ctes(msg, f"SELECT {line} FROM messages")
    q["stream_json_decode"] = "SELECT cast(event_id AS varchar) AS key, user_id, event_type FROM events"
    q["stream_write"] = with_ctes(msg, "SELECT value FROM messages")
    q["message_key"] = with_ctes(msg, "SELECT \"offset\", cast(epoch_us(ts) // 1000 AS varchar) AS row_key, true AS batch_key_ok FROM messages")
    q["stream_write_json"] = with_ctes(msg, "SELECT value, true AS key_ok FROM messages")
    q["message_roundtrip"] = with_ctes(
        msg, "SELECT printf('offset = %d, key = %s, value = %s', \"offset\", "
        "cast(epoch_us(ts) // 1000 AS varchar), value) AS line FROM messages")
    q["message_listen"] = with_ctes(msg, f"SELECT {line} FROM messages WHERE topic IN ('click', 'purchase')")
    # whole jobs
    q["calls_to_cells"] = with_ctes(CALL_ITEMS, cells_sql("call_keyed", CALL_FIELDS))
    q["raw_docs_to_cells"] = with_ctes(raw, cells_sql("raw_rows", RAW_FIELDS))
    q["contacts_to_cells"] = with_ctes(cf, w3_cells)
    q["contacts_to_cells_plain"] = with_ctes(cf, cells_sql("contact_rows", ("name", "phoneNo", "tel")))
    q["contacts_wide"] = with_ctes(cf, latest)
    q["job_accounts"] = with_ctes(",".join(x.strip() for x in (CALL_ITEMS, DOCS, FAULTY, raw, cf)) + """,
rejected AS (
  SELECT CASE WHEN r IN (1, 2, 3, 4, 12) THEN 'payload' WHEN r = 6 THEN 'id_or_mobile' WHEN r = 7 THEN 'peer_number'
              WHEN r = 8 THEN 'time' ELSE 'fee' END AS reason
  FROM faulty WHERE r IN (1, 2, 3, 4, 6, 7, 8, 9, 12)),
items AS (SELECT base, peer_number, time FROM call_items
  UNION ALL SELECT base, peer_number, CASE r WHEN 11 THEN '2017-12-20 16:42:10.5' ELSE '2017-12-20 16:42:10' END FROM faulty_item),
n AS (
  SELECT (SELECT count(*) FROM items) AS items, (SELECT count(*) FROM (SELECT DISTINCT * FROM items)) AS kept,
         (SELECT count(*) FROM rejected) AS bad, (SELECT count(*) FROM raw_docs) AS raws, (SELECT count(*) FROM raw_rows) AS rows,
         (SELECT count(DISTINCT rowkey) FROM raw_rows) AS keys, (SELECT count(*) FROM contacts) AS contacts,
         (SELECT count(*) FROM contacts WHERE ord % 17 = 0) AS gaps)
""", """SELECT * FROM (
  SELECT 'calls' AS job, unnest(['read', 'rejected', 'repeated', 'written', 'cells', 'documents', 'without_payload']) AS measure,
         unnest([items + bad, bad, items - kept, kept, 9 * kept, (SELECT count(*) FROM faulty) + (SELECT count(*) FROM docs),
                 (SELECT count(*) FROM faulty WHERE r = 0)]) AS n FROM n
  UNION ALL SELECT 'calls', 'rejected: ' || reason, count(*) FROM rejected GROUP BY reason
  UNION ALL SELECT 'raw', unnest(['read', 'rejected', 'repeated', 'written', 'cells']),
                   unnest([raws, raws - rows, rows - keys, keys, 7 * keys]) FROM n
  UNION ALL SELECT 'contacts', unnest(['read', 'rejected', 'repeated', 'written', 'cells']),
                   unnest([contacts, gaps, 0, contacts - gaps, 3 * (contacts - gaps)]) FROM n)""")
    return q
