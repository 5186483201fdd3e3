"""The catalogue's queries once more, as SQL over the same tables."""

from __future__ import annotations

from postlane.plans.catalogue import (
    DEAD,
    GAP_MS,
    GRAVE_VALUE,
    LIMIT_MS,
    LIMIT_SIZE,
    MAIN,
)
from postlane.plans.fixtures import STATE_ID

UNSUPPORTED = "Unsupported JMS message type"
UNREADABLE = "Converting byte[] to Kafka Connect data failed due to serialization error: "
ID = "'ID:' || lpad(lower(to_hex({0})), 48, '0')"
BATCH = 250

MESSAGES = f"""
raw_messages AS (
  SELECT *, {ID.format('event_id')} AS message_id,
    CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN '{{' || props ELSE props END AS body
  FROM events),
messages AS (
  SELECT 'QM1/Q' || (event_id % 4) AS source, event_id AS arrival_seq, message_id,
    CASE WHEN event_id % 20 = 0 THEN NULL WHEN event_id % 2 = 0 THEN message_id
         ELSE 'corr-' || user_id END AS correlation_id,
    'queue:///Q' || (event_id % 4) AS destination,
    CASE WHEN event_type <> 'view' THEN 'GROUP-' || user_id END AS group_id,
    epoch_us(ts) // 1000 AS ms,
    CASE event_id % 10 WHEN 7 THEN 'bytes' WHEN 8 THEN 'map' WHEN 9 THEN 'none'
         ELSE 'text' END AS body_kind,
    CASE WHEN event_id % 10 < 8 THEN body END AS body,
    event_type, user_id, value
  FROM raw_messages),
parsed AS (
  SELECT *, body_kind IN ('text', 'bytes') AND json_valid(body) AS good,
    CASE WHEN body_kind IN ('text', 'bytes') THEN body
      ELSE '{{"body_kind":"' || body_kind || '","message_id":"' || message_id
        || '","destination":"' || destination || '"}}' END AS dead_payload
  FROM messages)"""

BATCHED = f"""{MESSAGES},
batched AS (
  SELECT *, (row_number() OVER (PARTITION BY source ORDER BY arrival_seq) - 1) // {BATCH} + 1
    AS batch_no FROM messages),
sequenced AS (
  SELECT *, batch_no + CASE WHEN source = 'QM1/Q0' THEN 0 ELSE {STATE_ID} END AS sequence_id
  FROM batched),
units AS (
  SELECT source, sequence_id, count(*) AS n_ids,
    string_agg(message_id, ',' ORDER BY arrival_seq) AS ids,
    '["' || string_agg(message_id, '","' ORDER BY arrival_seq) || '"]' AS ids_json
  FROM sequenced GROUP BY ALL),
state AS (
  SELECT DISTINCT source, CAST({STATE_ID} AS BIGINT) AS state_id,
    CAST(CASE WHEN source = 'QM1/Q1' THEN {STATE_ID} ELSE {STATE_ID - 1} END AS BIGINT)
      AS offset_id,
    CASE WHEN source = 'QM1/Q3' THEN 'DELIVERED' ELSE 'IN_FLIGHT' END AS last_known_state,
    CASE WHEN source = 'QM1/Q2' THEN 'REDELIVER_UNSENT_BATCH'
         ELSE 'REMOVE_DELIVERED_MESSAGES_FROM_SOURCE_QUEUE' END AS action
  FROM messages WHERE source <> 'QM1/Q0')"""

DOCUMENTS = """
bodies AS (
  SELECT 'QM1/' || source AS source, doc_id AS arrival_seq, text, lang,
    lang = 'en' AS is_bytes FROM documents)"""

HEADERS = """
props AS (
  SELECT event_id, 0 AS position, 'event_type' AS key, 'STRING' AS type, event_type AS text,
    NULL AS bytes_hex, event_id % 2 = 0 AS flag FROM events
  UNION ALL SELECT event_id, 1, 'user_id', 'INT64', CAST(user_id AS VARCHAR), NULL, NULL FROM events
  UNION ALL SELECT event_id, 2, 'value', 'FLOAT64', CAST(value AS VARCHAR), NULL, NULL FROM events
  UNION ALL SELECT event_id, 3, 'flag', 'BOOLEAN',
    CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END, NULL, NULL FROM events
  UNION ALL SELECT event_id, 4, 'small', 'INT16', CAST(event_id % 1000 AS VARCHAR), NULL, NULL
    FROM events
  UNION ALL SELECT event_id, 5, 'JMS_IBM_MQMD_MsgId', 'STRING',
    'ID:' || lpad(lower(to_hex(event_id)), 48, '0'), NULL, NULL FROM events
  UNION ALL SELECT event_id, 6, 'event_type', 'STRING', 'dup', NULL, NULL FROM events
    WHERE event_id % 5 = 0)"""


def _key(key_type: str, text: str = "NULL", raw: str = "NULL", missing: str = "false") -> str:
    return f"""WITH {MESSAGES}
    SELECT source, arrival_seq, CAST({key_type} AS VARCHAR) AS key_type,
      CAST({text} AS VARCHAR) AS key_text, CAST({raw} AS VARCHAR) AS key_hex,
      CASE WHEN {missing} THEN 'MissingKeyField' END AS error FROM messages"""


def _headers(payload: str) -> str:
    return f"WITH {HEADERS} SELECT event_id AS arrival_seq, position, {payload} AS encoded FROM props"


JSON_PAYLOAD = """CASE WHEN type = 'STRING' THEN '"' || text || '"' ELSE text END"""
WIRE = """CASE type WHEN 'STRING' THEN 'string' WHEN 'INT64' THEN 'int64' WHEN 'INT16' THEN 'int16'
  WHEN 'FLOAT64' THEN 'double' ELSE 'boolean' END"""

JSON_ERROR = """CASE WHEN body_kind NOT IN ('text', 'bytes') THEN 'UnsupportedBody'
  WHEN NOT good THEN 'MalformedBody' END"""

TOPIC_SUMMARY = f"""WITH {MESSAGES}
    SELECT CASE WHEN good THEN '{MAIN}' ELSE '{DEAD}' END AS topic, count(*) AS records,
      count(*) FILTER (good) AS keyed,
      CAST(sum(CASE WHEN good THEN CAST(json_extract(body, '$.k') AS BIGINT) END) AS BIGINT)
        AS sum_k,
      CAST(sum(CASE WHEN NOT good THEN strlen(dead_payload) END) AS BIGINT) AS dead_bytes
    FROM parsed GROUP BY 1"""


def all_oracles() -> dict[str, str]:
    oracles = _oracles()
    # However a stream is split, its batches are those of the whole table.
    return {**oracles, "stream_batches": oracles["batch_by_limits"]}


def _oracles() -> dict[str, str]:
    return {
        "flagship_route_counts": TOPIC_SUMMARY,
        "topic_tables": TOPIC_SUMMARY,
        "key_none": _key("NULL"),
        "key_message_id": _key("'STRING'", "substr(message_id, 4)"),
        "key_correlation_id": _key(
            "'STRING'", "regexp_replace(correlation_id, '^ID:', '')", missing="correlation_id IS NULL"
        ),
        "key_correlation_id_bytes": _key("'BYTES'", raw="lower(hex(encode(correlation_id)))"),
        "key_destination": _key("'STRING'", "destination"),
        "key_group_id": _key("'STRING'", "group_id"),
        "key_group_turns": """SELECT conv_id * 1000 + turn AS arrival_seq,
            'conv-' || conv_id AS key_text, md5(text) AS body_md5 FROM conversations""",
        "partitions_by_key": """SELECT 'conv-' || conv_id AS key_text, CAST(1 AS BIGINT) AS partitions,
            count(*) AS records FROM conversations GROUP BY conv_id""",
        "partition_order": f"""WITH {MESSAGES}, keyed AS (SELECT source, arrival_seq,
              CASE WHEN arrival_seq % 3 = 0 THEN 'GROUP-hot' ELSE group_id END AS key_text FROM messages)
            SELECT *, row_number() OVER (PARTITION BY key_text ORDER BY arrival_seq) AS key_place
            FROM keyed WHERE key_text IS NOT NULL""",
        "value_raw": f"""WITH {MESSAGES} SELECT source, arrival_seq, 'BYTES' AS value_type,
            CAST(NULL AS VARCHAR) AS text_md5, md5(body) AS bytes_md5, strlen(body) AS n_bytes,
            CAST(NULL AS VARCHAR) AS error FROM messages""",
        "value_typed": f"""WITH {MESSAGES} SELECT source, arrival_seq,
            CASE body_kind WHEN 'bytes' THEN 'BYTES' WHEN 'text' THEN 'STRING' END AS value_type,
            CASE WHEN body_kind = 'text' THEN md5(body) END AS text_md5,
            CASE WHEN body_kind = 'bytes' THEN md5(body) END AS bytes_md5,
            CASE WHEN body_kind = 'bytes' THEN strlen(body) END AS n_bytes,
            CASE WHEN body_kind = 'map' THEN '{UNSUPPORTED}' END AS error FROM messages""",
        "value_raw_documents": f"""WITH {DOCUMENTS} SELECT source, arrival_seq,
            'BYTES' AS value_type, CAST(NULL AS VARCHAR) AS text_md5, md5(text) AS bytes_md5,
            strlen(text) AS n_bytes, CAST(NULL AS VARCHAR) AS error FROM bodies""",
        "value_typed_documents": f"""WITH {DOCUMENTS} SELECT source, arrival_seq,
            CASE WHEN is_bytes THEN 'BYTES' ELSE 'STRING' END AS value_type,
            CASE WHEN NOT is_bytes THEN md5(text) END AS text_md5,
            CASE WHEN is_bytes THEN md5(text) END AS bytes_md5,
            CASE WHEN is_bytes THEN strlen(text) END AS n_bytes,
            CAST(NULL AS VARCHAR) AS error FROM bodies""",
        "value_json": f"""WITH {MESSAGES} SELECT source, arrival_seq,
            CASE WHEN good THEN 'JSON' END AS value_type,
            CASE WHEN good THEN CAST(json_extract(body, '$.k') AS BIGINT) END AS k,
            {JSON_ERROR} AS error FROM parsed""",
        "value_json_schema": """WITH judged AS (SELECT *,
              o_orderkey % 50 <> 0 AND o_orderkey % 70 <> 1 AS good FROM orders)
            SELECT o_orderkey AS arrival_seq, CASE WHEN good THEN 'STRUCT' END AS value_type,
              CASE WHEN good THEN CAST(o_orderkey AS INTEGER) END AS order_key,
              CASE WHEN good THEN o_orderstatus END AS status,
              CASE WHEN good THEN o_orderkey % 2 = 0 END AS even,
              CASE WHEN good THEN o_orderstatus || '|' || o_orderpriority END AS marks,
              CASE WHEN good THEN o_orderpriority END AS priority,
              CASE WHEN good THEN o_custkey END AS customer,
              CASE WHEN NOT good THEN 'SchemaMismatch' END AS error FROM judged""",
        "value_json_embedded": """WITH kinds AS (SELECT *, o_orderpriority = '1-URGENT' AS urgent
              FROM orders),
            judged AS (SELECT *, o_orderkey % 30 <> 7
              AND (urgent OR o_orderstatus = 'P' OR o_orderkey % 40 <> 3) AS good FROM kinds)
            SELECT o_orderkey AS arrival_seq, CASE WHEN good THEN 'STRUCT' END AS value_type,
              CASE WHEN good THEN o_orderkey END AS order_key,
              CASE WHEN good AND NOT urgent THEN CAST(o_custkey AS INTEGER) END AS customer,
              CASE WHEN good AND NOT urgent AND o_orderstatus <> 'P' THEN o_orderstatus END
                AS status,
              CASE WHEN good AND urgent THEN o_orderpriority END AS priority,
              CASE WHEN NOT good THEN 'SchemaMismatch' END AS error FROM judged""",
        "value_json_many_schemas": """WITH judged AS (SELECT *, o_orderkey % 25 <> 4 AS good FROM orders)
            SELECT o_orderkey AS arrival_seq, CASE WHEN good THEN 'STRUCT' END AS value_type,
              CASE WHEN good THEN o_orderkey END AS order_key,
              CASE WHEN good THEN CAST(o_orderkey % 8 AS DOUBLE) + 0.5 END AS total,
              CASE WHEN good THEN CAST(o_custkey % 150 AS INTEGER) END AS version,
              CASE WHEN NOT good THEN 'SchemaMismatch' END AS error FROM judged""",
        "value_xml": """WITH judged AS (SELECT *, o_orderkey % 60 = 0 AS cut,
              o_orderkey % 45 = 4 AS other_root FROM orders)
            SELECT o_orderkey AS arrival_seq,
              CASE WHEN NOT cut AND NOT other_root THEN o_orderkey END AS order_key,
              CASE WHEN NOT cut AND NOT other_root THEN o_orderstatus END AS status,
              CASE WHEN NOT cut AND NOT other_root THEN o_orderpriority END AS priority,
              CASE WHEN cut THEN 'MalformedBody' WHEN other_root THEN 'SchemaMismatch' END AS error
            FROM judged""",
        "value_custom": """SELECT 'talk' AS topic, 'QM1/TALK' AS source,
            conv_id * 1000 + turn AS arrival_seq, 'STRING' AS value_type,
            md5(role || '> ' || text) AS text_md5 FROM conversations""",
        "headers_typed": f"""WITH {HEADERS} SELECT event_id AS arrival_seq, position, key, type,
            text, CAST(bytes_hex AS VARCHAR) AS bytes_hex FROM props""",
        "headers_last": """SELECT event_id AS arrival_seq,
            CASE WHEN event_id % 5 = 0 THEN 'dup' ELSE event_type END AS event_type, user_id,
            event_id % 2 = 0 AS flag, CAST(event_id % 1000 AS INTEGER) AS small,
            CAST(NULL AS VARCHAR) AS descriptor,
            CASE WHEN event_id % 5 = 0 THEN 6 ELSE 5 END AS n_headers FROM events""",
        "headers_encoded_simple": _headers("text"),
        "headers_encoded_json": _headers(JSON_PAYLOAD),
        "headers_encoded_json_schema": _headers(
            f"""'{{"schema":{{"type":"' || {WIRE} || '","optional":false}},"payload":'
                || {JSON_PAYLOAD} || '}}'"""
        ),
        "records_typed": f"""WITH {MESSAGES} SELECT 'typed.topic' AS topic, source, arrival_seq,
            CAST(NULL AS BIGINT) AS sequence_id, ms AS ts_ms,
            CASE body_kind WHEN 'bytes' THEN 'BYTES' WHEN 'text' THEN 'STRING' END AS value_type,
            CASE WHEN arrival_seq % 5 = 0 THEN 6 ELSE 5 END AS n_headers,
            CASE WHEN body_kind = 'map' THEN 'UnsupportedBody' END AS error FROM messages""",
        "tolerate_none": """SELECT 'talk' AS topic,
            CASE WHEN lang = 'en' THEN 'BYTES' ELSE 'STRING' END AS value_type,
            count(*) AS records FROM documents GROUP BY 2""",
        "dlq_skip": f"""WITH {MESSAGES} SELECT source, arrival_seq, '{MAIN}' AS topic,
            CAST(json_extract(body, '$.k') AS BIGINT) AS k FROM parsed WHERE good""",
        "dlq_payload": f"""WITH {MESSAGES} SELECT source, arrival_seq, '{DEAD}' AS topic,
            'BYTES' AS value_type, CAST(NULL AS VARCHAR) AS key_text, ms AS ts_ms,
            md5(dead_payload) AS payload_md5, strlen(dead_payload) AS n_bytes
            FROM parsed WHERE NOT good""",
        "dlq_context_headers": f"""WITH {MESSAGES}, {HEADERS},
            dead AS (SELECT *, CASE WHEN body_kind IN ('text', 'bytes') THEN 'MalformedBody'
                ELSE 'UnsupportedBody' END AS class,
              CASE WHEN body_kind IN ('text', 'bytes') THEN '{UNREADABLE}'
                ELSE '{UNSUPPORTED}' END AS message,
              body_kind IN ('text', 'bytes') AS caused,
              CASE WHEN arrival_seq % 5 = 0 THEN 6 ELSE 5 END AS own
              FROM parsed WHERE NOT good),
            context AS (
              SELECT arrival_seq, own AS position, 'topic' AS key, 'STRING' AS type,
                '{MAIN}' AS text FROM dead
              UNION ALL SELECT arrival_seq, own + 1, 'exception.class.name', 'STRING', class FROM dead
              UNION ALL SELECT arrival_seq, own + 2, 'exception.message', 'STRING', message FROM dead
              UNION ALL SELECT arrival_seq, own + 3, 'jms.message.id', 'STRING', message_id FROM dead
              UNION ALL SELECT arrival_seq, own + 4, 'jms.timestamp', 'INT64',
                CAST(ms AS VARCHAR) FROM dead
              UNION ALL SELECT arrival_seq, own + 5, 'mq.queue', 'STRING', 'Q' FROM dead
              UNION ALL SELECT arrival_seq, own + 6, 'timestamp', 'INT64', '0' FROM dead
              UNION ALL SELECT arrival_seq, own + 7, 'cause.class', 'STRING', 'ParseError'
                FROM dead WHERE caused
              UNION ALL SELECT arrival_seq, own + 8, 'cause.message', 'STRING',
                'the body is not valid JSON' FROM dead WHERE caused
              UNION ALL SELECT arrival_seq, own + CASE WHEN caused THEN 9 ELSE 7 END,
                'exception.stacktrace', 'STRING', class || ': ' || message || CASE WHEN caused
                  THEN chr(10) || 'Caused by: ParseError: the body is not valid JSON' ELSE '' END
                FROM dead)
            SELECT arrival_seq, position, '__connect.errors.' || key AS key, type, text FROM context
            UNION ALL SELECT event_id, position - CASE WHEN position > 5 THEN 1 ELSE 0 END,
              key, type, text FROM props JOIN dead ON event_id = arrival_seq WHERE position <> 5""",
        "error_report": f"""WITH {MESSAGES}, failed AS (
              SELECT *, CASE WHEN body_kind IN ('text', 'bytes') THEN 'MalformedBody'
                  ELSE 'UnsupportedBody' END AS class,
                CASE WHEN body_kind IN ('text', 'bytes') THEN rtrim('{UNREADABLE}', ': ')
                  ELSE '{UNSUPPORTED}' END AS reason FROM parsed WHERE NOT good)
            SELECT '{MAIN}' AS topic, class, reason, count(*) AS errors, min(ms) AS first_ms,
              max(ms) AS last_ms, md5(arg_min(dead_payload, (source, arrival_seq))) AS sample
            FROM failed GROUP BY ALL""",
        "error_reasons_only": f"""WITH {MESSAGES}, failed AS (
              SELECT *, CASE WHEN body_kind IN ('text', 'bytes') THEN rtrim('{UNREADABLE}', ': ')
                  ELSE '{UNSUPPORTED}' END AS reason FROM parsed WHERE NOT good)
            SELECT '{MAIN}' AS topic, reason, count(*) AS errors, min(ms) AS first_ms,
              max(ms) AS last_ms FROM failed GROUP BY reason""",
        "error_templates": f"""WITH {MESSAGES}, failed AS (
              SELECT ms, CASE body_kind WHEN 'text' THEN 'no handler for ' || message_id || ' at ' || destination
                WHEN 'bytes' THEN 'message ' || message_id || ' of ' || ms || ' is late'
                WHEN 'map' THEN 'no reader for ' || message_id || ' at hand'
                ELSE 'nothing to read' END AS reason FROM messages),
            reasons AS (
              SELECT reason, count(*) AS errors, min(ms) AS first_ms, max(ms) AS last_ms,
                string_split(reason, ' ') AS split, len(string_split(reason, ' ')) AS words
              FROM failed GROUP BY reason),
            each_word AS (
              SELECT reason, errors, words, unnest(split) AS word, generate_subscripts(split, 1) AS place FROM reasons),
            totals AS (SELECT words, sum(errors) AS total FROM reasons GROUP BY words),
            often AS (
              SELECT words, place, word FROM each_word JOIN totals USING (words) GROUP BY words, place, word, total
              HAVING sum(errors) >= 20 AND sum(errors) * 100 >= total),
            shaped AS (
              SELECT e.reason, string_agg(CASE WHEN total < 20 OR o.word IS NOT NULL THEN e.word ELSE '*' END, ' '
                ORDER BY e.place) AS template
              FROM each_word e JOIN totals t ON t.words = e.words
              LEFT JOIN often o ON o.words = e.words AND o.place = e.place AND o.word = e.word GROUP BY e.reason)
            SELECT '{MAIN}' AS topic, 'Refused' AS class, template, CAST(sum(errors) AS BIGINT) AS errors,
              count(*) AS reasons, min(first_ms) AS first_ms, max(last_ms) AS last_ms, min(reason) AS example
            FROM shaped JOIN reasons USING (reason) GROUP BY template""",
        "error_reason": r"""SELECT conv_id, turn, md5(CASE
              WHEN role <> 'user' OR role IS NULL THEN 'Unknown error'
              ELSE regexp_replace(text || CASE WHEN turn % 2 = 0 THEN ' : ' || chr(10) ELSE '' END,
                '[:\s]+$', '') END) AS reason_md5 FROM conversations""",
        "error_trace": """WITH traces AS (SELECT doc_id, CASE WHEN length(text) > 500
              THEN left(text, 500) || '... [truncated]' ELSE text END AS trace FROM documents)
            SELECT doc_id, length(trace) AS length, md5(trace) AS trace_md5 FROM traces""",
        "triage": """WITH coded AS (SELECT event_id,
              coalesce(list_extract([2003, 2009, 2016, 2035, 2059, 2161, 2162, 2195, 2537, 2538, 1,
                NULL], event_id % 12 + 1), 2003) AS reason FROM events)
            SELECT event_id, reason, reason <> 1 AS retriable, reason <> 2016 AS closable
            FROM coded""",
        "batch_by_count": f"""WITH {BATCHED} SELECT source, arrival_seq, batch_no FROM batched""",
        "stream_in_order": f"""WITH {MESSAGES}, placed AS (SELECT source,
              row_number() OVER (PARTITION BY source ORDER BY arrival_seq) AS place,
              count(*) OVER (PARTITION BY source) AS held FROM messages)
            SELECT source, place AS arrival_seq, place FROM placed WHERE place < held * 9 // 10""",
        "stream_holes": f"""WITH {MESSAGES}, placed AS (SELECT source,
              row_number() OVER (PARTITION BY source ORDER BY arrival_seq) AS seq FROM messages),
            came AS (SELECT source, seq, lag(seq, 1, 0) OVER (PARTITION BY source ORDER BY seq) AS before
              FROM placed WHERE seq % 100 NOT IN (0, 1, 50)),
            sizes AS (SELECT source, count(*) AS came, max(seq) AS last_came FROM came GROUP BY source)
            SELECT source, sizes.came, last_came, before + 1 AS first_seq, seq - 1 AS last_seq
            FROM came JOIN sizes USING (source) WHERE seq > before + 1""",
        "batch_without_holes": """SELECT 'QM1/TALK-' || conv_id AS source, turn AS arrival_seq,
            (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1) // 3 + 1 AS batch_no,
            md5(text) AS body_md5 FROM conversations""",
        "batch_by_limits": f"""WITH RECURSIVE {MESSAGES},
            numbered AS (SELECT source, arrival_seq, ms,
              row_number() OVER (PARTITION BY source ORDER BY arrival_seq) AS place,
              lag(ms) OVER (PARTITION BY source ORDER BY arrival_seq) AS previous FROM messages),
            walk AS (
              SELECT source, arrival_seq, place, ms, ms AS start_ms, 1 AS held, CAST(1 AS BIGINT) AS batch_no
              FROM numbered WHERE place = 1
              UNION ALL
              SELECT source, arrival_seq, place, ms, CASE WHEN fresh THEN ms ELSE start_ms END,
                CASE WHEN fresh THEN 1 ELSE held + 1 END,
                CASE WHEN fresh THEN batch_no + 1 ELSE batch_no END
              FROM (SELECT n.source, n.arrival_seq, n.place, n.ms, w.start_ms, w.held, w.batch_no,
                  w.held >= {LIMIT_SIZE} OR n.previous >= w.start_ms + {LIMIT_MS}
                    OR n.ms - n.previous > {GAP_MS} AS fresh
                FROM walk w JOIN numbered n ON n.source = w.source AND n.place = w.place + 1))
            SELECT source, arrival_seq, batch_no FROM walk""",
        "sequence_ids": f"""WITH {BATCHED}
            SELECT source, arrival_seq, batch_no, sequence_id FROM sequenced""",
        "state_snapshot": f"""WITH {BATCHED} SELECT source, sequence_id, n_ids,
            md5(ids) AS ids_md5, 'IN_FLIGHT' AS last_known_state FROM units""",
        "state_json": f"""WITH {BATCHED} SELECT source, md5('{{"sequenceId":' || sequence_id
            || ',"messageIds":' || ids_json || ',"lastKnownState":"IN_FLIGHT"}}') AS json_md5
            FROM units""",
        "state_round_trip": f"""WITH {BATCHED} SELECT source, sequence_id, n_ids,
            'IN_FLIGHT' AS last_known_state FROM units""",
        "state_conflicts": f"""WITH {BATCHED}
            SELECT source FROM units GROUP BY source HAVING count(*) > 1""",
        "latest_offsets": f"""WITH {BATCHED}
            SELECT source, max(sequence_id) AS sequence_id FROM sequenced GROUP BY source""",
        "recovery_plan": f"""WITH {BATCHED} SELECT source, state_id, offset_id, last_known_state,
            action, state_id AS base_sequence_id FROM state""",
        "promote_state": f"""WITH {BATCHED} SELECT source, state_id AS sequence_id,
            CASE WHEN source = 'QM1/Q2' THEN 'IN_FLIGHT' ELSE 'DELIVERED' END AS last_known_state
            FROM state""",
        "recovery_ready": f"""WITH {BATCHED} SELECT source, action,
            arg_min(message_id, arrival_seq) AS head_id, 'ready' AS decision
            FROM state JOIN messages USING (source) GROUP BY source, action""",
        "recovered_table": f"""WITH {BATCHED}, kept AS (
              SELECT b.source, b.arrival_seq, NOT p.good AS dead, CASE
                  WHEN b.source = 'QM1/Q0' THEN batch_no
                  WHEN b.source = 'QM1/Q2' AND batch_no = 1 THEN {STATE_ID}
                  ELSE {STATE_ID - 1} + batch_no END AS sequence_id
              FROM batched b JOIN parsed p USING (message_id)
              WHERE NOT (b.source IN ('QM1/Q1', 'QM1/Q3') AND batch_no = 1))
            SELECT source, sequence_id, count(*) AS records,
              CAST(count(*) FILTER (dead) AS BIGINT) AS dead, min(arrival_seq) AS first_seq,
              max(arrival_seq) AS last_seq FROM kept GROUP BY 1, 2""",
        "published_twice": f"""WITH {MESSAGES}, halves AS (
              SELECT *, arrival_seq > (SELECT max(arrival_seq) // 2 FROM messages) AS later FROM messages),
            placed AS (SELECT *, (row_number() OVER (PARTITION BY source, later ORDER BY arrival_seq) - 1) // {BATCH} + 1
              AS batch_no FROM halves),
            firsts AS (SELECT source, max(batch_no) AS n FROM placed WHERE NOT later GROUP BY source)
            SELECT CASE WHEN later THEN CAST(2 AS BIGINT) ELSE 1 END AS unit, source,
              batch_no + CASE WHEN later THEN coalesce(n, 0) ELSE 0 END AS sequence_id, count(*) AS records,
              count(DISTINCT message_id) AS ids, min(arrival_seq) AS first_seq, max(arrival_seq) AS last_seq
            FROM placed LEFT JOIN firsts USING (source) GROUP BY 1, 2, 3""",
        "strict_prefix": f"""WITH {BATCHED}, judged AS (
              SELECT *, body_kind = 'map' AND value > {GRAVE_VALUE} AS grave FROM batched),
            failed AS (SELECT source, min(batch_no) AS bad FROM judged WHERE grave GROUP BY source)
            SELECT CASE WHEN bad IS NULL OR batch_no < bad THEN 1
                WHEN EXISTS (SELECT 1 FROM failed f JOIN batched x ON true WHERE x.source NOT IN (SELECT source FROM failed)
                  OR (x.source = f.source AND x.batch_no < f.bad)) THEN 2 ELSE CAST(1 AS BIGINT) END AS unit,
              source, batch_no AS sequence_id, count(*) AS records, count(DISTINCT message_id) AS ids,
              min(arrival_seq) AS first_seq, max(arrival_seq) AS last_seq
            FROM judged LEFT JOIN failed USING (source) WHERE NOT grave GROUP BY 1, 2, 3""",
        "redeliver": f"""WITH {BATCHED} SELECT source, arrival_seq, message_id,
            CAST({STATE_ID} AS BIGINT) AS sequence_id FROM batched WHERE source = 'QM1/Q2' AND batch_no = 1""",
        "drop_delivered": f"""WITH {BATCHED} SELECT source, arrival_seq, message_id FROM batched
            WHERE NOT (source IN ('QM1/Q1', 'QM1/Q3') AND batch_no = 1)""",
        "committed_prefix": f"""WITH {BATCHED}, failed AS (
              SELECT source, min(batch_no) AS bad FROM batched
              WHERE body_kind = 'map' AND value > {GRAVE_VALUE} GROUP BY source)
            SELECT b.source, arrival_seq, batch_no, bad IS NULL OR batch_no < bad AS committed
            FROM batched b LEFT JOIN failed f ON b.source = f.source""",
        "delivery_audit": f"""WITH {BATCHED}, judged AS (SELECT source, sequence_id,
              NOT (group_id IS NULL AND source = 'QM1/Q1') AS acked FROM sequenced)
            SELECT source, sequence_id, count(*) AS expected, count(*) FILTER (acked) AS acked,
              count(*) FILTER (acked) = count(*) AS complete FROM judged GROUP BY 1, 2""",
        "dedupe": f"""WITH {MESSAGES} SELECT source, arrival_seq, message_id, body_kind
            FROM messages""",
        "peek": f"""WITH {MESSAGES}, heads AS (
              SELECT source, min(arrival_seq) AS arrival_seq FROM messages GROUP BY source)
            SELECT source, arrival_seq, message_id, body_kind,
              CASE WHEN body_kind = 'text' THEN body END AS body_text
            FROM messages JOIN heads USING (source, arrival_seq)""",
        "more_than_one": f"""WITH {MESSAGES}
            SELECT group_id, count(*) > 1 AS more_than_one FROM messages GROUP BY group_id""",
        "one_source": f"""WITH {MESSAGES} SELECT source, arrival_seq, destination,
            ms AS jms_timestamp, body_kind FROM messages WHERE source = 'QM1/Q2'""",
        "topic_rows_bytes": """SELECT 'raw' AS topic, 'queue:///' || lang AS key,
            md5(text) AS value_md5, CAST(NULL AS VARCHAR) AS header_keys FROM documents""",
        "topic_rows_string": f"""SELECT 'text' AS topic,
            substr({ID.format('(conv_id * 1000 + turn)')}, 4) AS key, md5(text) AS value_md5,
            CAST(NULL AS VARCHAR) AS header_keys FROM conversations""",
        "topic_rows_json": f"""WITH {MESSAGES} SELECT '{MAIN}' AS topic,
            substr(message_id, 4) AS key,
            md5('{{"k":' || CAST(json_extract(body, '$.k') AS BIGINT) || '}}') AS value_md5,
            'event_type,user_id,value,flag,small'
              || CASE WHEN arrival_seq % 5 = 0 THEN ',event_type' ELSE '' END AS header_keys
            FROM parsed WHERE good""",
        "message_table": f"""WITH {MESSAGES} SELECT source, body_kind, count(*) AS messages,
            min(arrival_seq) AS first_seq, max(ms) AS last_ms FROM messages GROUP BY 1, 2""",
        "stream_effectively_once": f"""WITH {MESSAGES}
            SELECT CASE WHEN good THEN '{MAIN}' ELSE '{DEAD}' END AS topic, count(*) AS records,
              count(DISTINCT message_id) AS ids,
              CAST(sum(CASE WHEN good THEN CAST(json_extract(body, '$.k') AS BIGINT) END)
                AS BIGINT) AS sum_k,
              count(*) AS numbered FROM parsed GROUP BY 1""",
        "stream_units": f"""WITH {MESSAGES} SELECT source, count(*) AS records,
            true AS units_fit, true AS no_number_missing FROM messages GROUP BY source""",
        "stream_dedupe": f"""WITH {MESSAGES}
            SELECT source, arrival_seq, message_id FROM messages""",
    }
