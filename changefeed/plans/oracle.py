"""The SQL each registered query must agree with, for DuckDB on the same tables."""

from __future__ import annotations

# Views every statement may use.
_DAY = "date_diff('day', DATE '2024-01-01', CAST(ts AS DATE))"
_DOCUMENT = """
  '{"awsRegion":"local","change":{"ApproximateCreationDateTime":'
  || CAST(epoch_us(ts) // 1000000 AS VARCHAR)
  || ',"Keys":{"id":{"N":"' || event_id || '"}},"NewImage":{"id":{"N":"' || event_id
  || '"},"n":{"S":"' || event_type || '"},"value":{"N":"' || CAST(value AS VARCHAR)
  || '"},"k":{"N":"' || regexp_extract(props, '[0-9]+')
  || '"}},"SequenceNumber":"' || lpad(CAST(event_id + 1 AS VARCHAR), 21, '0')
  || '","SizeBytes":' || length(props)
  || ',"StreamViewType":"NEW_AND_OLD_IMAGES"},"eventID":"' || event_id
  || '","eventName":"INSERT","eventSource":"events","eventVersion":"1.0"}'
"""
_FEED = f"""
feed AS (
  SELECT event_id, ts, event_type, value, props, {_DAY} AS day, user_id % 8 AS bucket,
         CAST(user_id AS VARCHAR) AS "partitionKey",
         lpad(CAST(event_id + 1 AS VARCHAR), 21, '0') AS seq,
         'shardId-' || lpad(CAST({_DAY} AS VARCHAR), 5, '0')
           || '-' || lpad(CAST(user_id % 8 AS VARCHAR), 2, '0') AS "shardId"
  FROM events)
"""
_MIXED = f"""
{_FEED},
mixed AS (
  SELECT * EXCLUDE (seq), CASE WHEN (event_id + 1) % 3 = 0 THEN '000' ELSE '' END || digits AS seq
  FROM (SELECT *, CAST(event_id + 1 AS VARCHAR)
                  || repeat('0', CAST((event_id + 1) % 5 * 11 AS INTEGER)) AS digits FROM feed))
"""
_CATALOGUE = f"""
{_FEED},
ranges AS (
  SELECT "shardId", day, bucket, min(seq) AS "startSeq", max(seq) AS "headSeq",
         count(*) AS records
  FROM feed GROUP BY ALL),
cat AS (
  SELECT "shardId", day, bucket, "startSeq",
         CASE WHEN day < (SELECT max(day) FROM ranges) THEN "headSeq" END AS "endSeq",
         CASE WHEN day > 0 THEN 'shardId-' || lpad(CAST(day - 1 AS VARCHAR), 5, '0')
           || '-' || lpad(CAST(bucket AS VARCHAR), 2, '0') END AS "parentShardId",
         CASE WHEN day > 0 AND day % 10 = 0 AND bucket % 2 = 0
           THEN 'shardId-' || lpad(CAST(day - 1 AS VARCHAR), 5, '0')
             || '-' || lpad(CAST(bucket + 1 AS VARCHAR), 2, '0') END AS "adjacentParentShardId"
  FROM ranges)
"""
_PARENTS = f"""
{_CATALOGUE},
parents AS (
  SELECT u."shardId", u.p AS "parentId"
  FROM (SELECT "shardId", "parentShardId" AS p FROM cat WHERE "parentShardId" IS NOT NULL
        UNION
        SELECT "shardId", "adjacentParentShardId" FROM cat
        WHERE "adjacentParentShardId" IS NOT NULL) u
  JOIN cat k ON k."shardId" = u.p)
"""
_ANCESTORS = f"""
{_PARENTS},
anc AS (
  SELECT "shardId", "parentId" AS a FROM parents
  UNION
  SELECT anc."shardId", parents."parentId"
  FROM anc JOIN parents ON parents."shardId" = anc.a)
"""
_POSITIONS = f"""
{_CATALOGUE},
pos AS (
  SELECT "shardId",
    CASE (day * 8 + bucket) % 6 WHEN 0 THEN 'TRIM_HORIZON' WHEN 1 THEN 'LATEST'
      WHEN 2 THEN 'AT_TIMESTAMP' WHEN 3 THEN 'AFTER_SEQUENCE_NUMBER'
      WHEN 4 THEN 'AT_SEQUENCE_NUMBER' ELSE 'SHARD_END' END AS "iteratorType",
    CASE (day * 8 + bucket) % 6
      WHEN 2 THEN CAST(1704067200000 + day * 86400000 + 43200000 AS VARCHAR)
      WHEN 3 THEN "startSeq" WHEN 4 THEN "startSeq" ELSE '' END AS "iteratorPosition"
  FROM cat)
"""
_APPLIED = f"""
{_POSITIONS},
applied AS (
  SELECT f.* FROM feed f JOIN pos p ON p."shardId" = f."shardId"
  WHERE CASE p."iteratorType"
    WHEN 'TRIM_HORIZON' THEN true
    WHEN 'AT_TIMESTAMP'
      THEN f.ts >= make_timestamp(try_cast(p."iteratorPosition" AS BIGINT) * 1000)
    WHEN 'AFTER_SEQUENCE_NUMBER' THEN f.seq > p."iteratorPosition"
    WHEN 'AT_SEQUENCE_NUMBER' THEN f.seq >= p."iteratorPosition"
    ELSE false END)
"""
_SLICE = f"""
{_APPLIED},
slice AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY "shardId" ORDER BY seq) AS r FROM applied)
  WHERE r <= 15)
"""
_LOG = f"""
{_CATALOGUE},
log AS (
  SELECT day AS batch_id, "shardId", 'AFTER_SEQUENCE_NUMBER' AS "iteratorType",
         CASE WHEN bucket % 2 = 1 THEN "headSeq" ELSE "startSeq" END AS "iteratorPosition"
  FROM ranges
  UNION ALL
  SELECT day + 1, "shardId", 'SHARD_END', '' FROM ranges)
"""
_STREAMS = f"""
{_CATALOGUE},
streams AS (
  SELECT 'events' AS "streamName", "shardId", "startSeq", "headSeq", records FROM ranges
  UNION ALL
  SELECT 'orders', 'shardId-' || lpad(CAST(year(o_orderdate) - 1990 AS VARCHAR), 5, '0')
           || '-' || lpad(CAST(o_custkey % 8 AS VARCHAR), 2, '0') AS shard,
         min(lpad(CAST(o_orderkey + 1 AS VARCHAR), 21, '0')),
         max(lpad(CAST(o_orderkey + 1 AS VARCHAR), 21, '0')), count(*)
  FROM orders GROUP BY shard)
"""
_KEYS = (
    'SELECT "shardId", seq AS "sequenceNumber", "partitionKey", '
    'ts AS "approximateArrivalTimestamp"'
)
_LOG_COLUMNS = 'batch_id, "shardId", "iteratorType", "iteratorPosition"'


def oracle_sql() -> dict[str, str]:
    envelope = f"""
        WITH {_FEED}
        SELECT {_DOCUMENT} AS data, 'events' AS "streamName", "partitionKey",
               seq AS "sequenceNumber", ts AS "approximateArrivalTimestamp" FROM feed"""
    page_numbers = f"""
        WITH {_FEED}
        SELECT "shardId", seq AS "sequenceNumber",
               (row_number() OVER (PARTITION BY "shardId" ORDER BY seq) - 1) // 5
                 AS "pageNumber" FROM feed"""
    return {
        # Sources
        "envelope_schema": """
            SELECT 'binary' AS data, 'string' AS "streamName", 'string' AS "partitionKey",
                   'string' AS "sequenceNumber", 'timestamp' AS "approximateArrivalTimestamp",
                   count(*) AS records FROM events""",
        "stream_feed_scan": envelope,
        "stream_capped_batches": f"""
            WITH {_FEED}
            SELECT "shardId", seq AS "sequenceNumber",
                   (row_number() OVER (PARTITION BY "shardId" ORDER BY seq) - 1) // 50 AS batch
            FROM feed""",
        "batch_feed_scan": f"""
            WITH {_FEED}
            SELECT lpad(CAST(length(ltrim(seq, '0')) AS VARCHAR), 10, '0') || ltrim(seq, '0') AS "seqKey",
                   "shardId", seq AS "sequenceNumber", "partitionKey", ts AS "approximateArrivalTimestamp",
                   {_DOCUMENT} AS data
            FROM feed WHERE ts >= TIMESTAMP '2024-01-09 06:00:00' AND ts < TIMESTAMP '2024-01-12'""",
        "stream_feed_write": f"""
            WITH {_FEED}
            SELECT "shardId", seq AS "sequenceNumber", "partitionKey",
                   row_number() OVER (PARTITION BY "shardId" ORDER BY seq) AS ordinal, {_DOCUMENT} AS data
            FROM feed""",
        "stream_current_image": f"""
            WITH {_FEED}
            SELECT "partitionKey", max(seq) AS "sequenceNumber", max(event_id) AS id,
                   arg_max(event_type, event_id) AS n, false AS removed
            FROM feed GROUP BY ALL""",
        "stream_window_counts": f"""
            WITH {_FEED}
            SELECT "shardId", time_bucket(INTERVAL 6 HOURS, ts) AS start, count(*) AS records
            FROM feed GROUP BY ALL""",
        "stream_interval_join": f"""
            WITH {_FEED}
            SELECT v."partitionKey", v.seq AS viewed, p.seq AS purchased
            FROM feed v JOIN feed p ON v."partitionKey" = p."partitionKey"
              AND p.ts BETWEEN v.ts AND v.ts + INTERVAL 2 HOURS
            WHERE v.event_type = 'view' AND p.event_type = 'purchase'""",
        "session_activity": f"""
            WITH {_FEED},
            gaps AS (
              SELECT *, CASE WHEN ts <= lag(ts) OVER w + INTERVAL 12 HOURS THEN 0 ELSE 1 END AS fresh
              FROM feed WINDOW w AS (PARTITION BY "partitionKey" ORDER BY ts)),
            runs AS (
              SELECT *, sum(fresh) OVER (PARTITION BY "partitionKey" ORDER BY ts, seq) AS run FROM gaps)
            SELECT "partitionKey", min(ts) AS first, max(ts) AS last, count(*) AS records
            FROM runs GROUP BY "partitionKey", run""",
        "asof_positions": f"""
            WITH {_LOG},
            noons AS (
              SELECT *, TIMESTAMP '2024-01-01 12:00:00' + to_days(CAST(batch_id AS INTEGER)) AS at FROM log)
            SELECT f."shardId", f.seq AS "sequenceNumber", n.batch_id, n."iteratorType", n."iteratorPosition"
            FROM feed f ASOF LEFT JOIN noons n ON f."shardId" = n."shardId" AND f.ts >= n.at""",
        "feed_reconcile": f"""
            WITH {_FEED},
            numbered AS (
              SELECT "shardId", bucket, event_id + 1 AS n,
                lpad(CAST(length(CAST(event_id + 1 AS VARCHAR)) AS VARCHAR), 10, '0')
                  || CAST(event_id + 1 AS VARCHAR) AS "seqKey" FROM feed)
            SELECT "shardId", "seqKey", CASE WHEN bucket = 5 THEN 'added'
                WHEN n % 11 = 0 THEN 'missing' ELSE 'changed' END AS difference
            FROM numbered
            WHERE (bucket = 5 AND n % 13 = 0) OR (bucket = 3 AND (n % 11 = 0 OR n % 17 = 0))""",
        "shard_levels": f"""
            WITH RECURSIVE {_PARENTS},
            ways AS (
              SELECT "shardId", 0 AS level FROM cat WHERE "shardId" NOT IN (SELECT "shardId" FROM parents)
              UNION
              SELECT p."shardId", w.level + 1 FROM ways w JOIN parents p ON p."parentId" = w."shardId")
            SELECT "shardId", max(level) AS level FROM ways GROUP BY "shardId" """,
        "lag_sketches": f"""
            WITH {_FEED},
            waits AS (
              SELECT day, "shardId", CAST(ceil(ln(greatest(
                epoch_ms(date_trunc('day', ts) + INTERVAL 1 DAY) - epoch_ms(ts), 1)) / ln(1.02)) AS INTEGER) AS bin
              FROM feed),
            grouped AS (
              SELECT 'shard' AS level, "shardId" AS name, bin FROM waits
              UNION ALL SELECT 'day', CAST(day AS VARCHAR), bin FROM waits
              UNION ALL SELECT 'stream', 'events', bin FROM waits)
            SELECT level, name, count(*) AS records,
              CAST(round(pow(1.02, quantile_disc(bin, 0.5))) AS BIGINT) AS median_ms,
              CAST(round(pow(1.02, quantile_disc(bin, 0.99))) AS BIGINT) AS most_ms, true AS keys_close
            FROM grouped GROUP BY level, name""",
        "shard_scan_counts": f"""
            WITH {_CATALOGUE} SELECT "shardId", "startSeq", "headSeq", records FROM ranges""",
        "shard_ranges_from_pages": f"""
            WITH {_CATALOGUE} SELECT "shardId", "startSeq", "headSeq", records FROM ranges""",
        "shard_read_from_position": f"""
            WITH {_FEED} {_KEYS} FROM feed WHERE seq > lpad('501', 21, '0')""",
        "shard_catalogue": f"""
            WITH {_CATALOGUE} SELECT "shardId", "parentShardId", "adjacentParentShardId",
                   "startSeq", "endSeq" FROM cat""",
        "many_streams_catalogue": f"WITH {_STREAMS} SELECT * FROM streams",
        # Projections and decoding
        "envelope_projection": envelope,
        "arrival_timestamp": """
            SELECT event_id, epoch_us(ts) // 1000 AS arrival_ms,
                   make_timestamp(epoch_us(ts) // 1000 * 1000) AS arrived FROM events""",
        "payload_text": f"""
            WITH {_FEED} SELECT seq AS "sequenceNumber", {_DOCUMENT} AS payload FROM feed""",
        "decode_event": f"""
            WITH {_FEED}
            SELECT 'local' AS aws_region, CAST(event_id AS VARCHAR) AS event_id,
                   'INSERT' AS event_name, 'events' AS event_source, '1.0' AS event_version,
                   epoch_us(ts) // 1000000 AS created, CAST(event_id AS VARCHAR) AS key_id,
                   seq AS sequence_number, CAST(length(props) AS BIGINT) AS size_bytes,
                   'NEW_AND_OLD_IMAGES' AS view_type FROM feed""",
        "new_image_attribute": f"""
            WITH {_FEED} SELECT seq AS "sequenceNumber", event_type AS n FROM feed""",
        "typed_attribute": """
            SELECT event_id AS id, value, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k,
                   false AS n_is_number FROM events""",
        "arrival_epoch": f"""
            WITH {_FEED} SELECT seq AS "sequenceNumber", epoch_us(ts) // 1000000 AS arrival_epoch
            FROM feed""",
        "unpack_records": f"""
            WITH {_FEED}
            SELECT "shardId", seq AS "sequenceNumber", CAST(part AS INTEGER) AS "subSequence",
                   {_DOCUMENT} AS payload
            FROM feed JOIN (SELECT unnest([0, 1]) AS part) parts
              ON part = 0 OR event_id % 3 = 0""",
        # Positions
        "position_trim_horizon": f"WITH {_FEED} {_KEYS} FROM feed",
        "position_latest": f"""
            WITH {_FEED},
            heads AS (SELECT "shardId" AS h, max(seq) AS head FROM feed
                      WHERE hour(ts) < 12 GROUP BY "shardId")
            {_KEYS} FROM feed JOIN heads ON h = "shardId" WHERE seq > head""",
        "position_at_timestamp": f"""
            WITH {_FEED} {_KEYS} FROM feed WHERE ts >= make_timestamp(1705320000000 * 1000)""",
        "position_after_sequence": f"""
            WITH {_FEED} {_KEYS} FROM feed WHERE seq > lpad('251', 21, '0')""",
        "position_at_sequence": f"""
            WITH {_FEED} {_KEYS} FROM feed WHERE seq >= lpad('251', 21, '0')""",
        "position_shard_end": f"""
            WITH {_POSITIONS} SELECT * FROM pos WHERE "iteratorType" <> 'SHARD_END'""",
        "parse_starting_position": """
            SELECT event_id, CASE WHEN event_type IN ('error', 'purchase') THEN 'TRIM_HORIZON'
                                  ELSE 'LATEST' END AS iterator_type FROM events""",
        "apply_positions": f"WITH {_APPLIED} {_KEYS} FROM applied",
        "apply_positions_stored": f"WITH {_APPLIED} {_KEYS} FROM applied",
        # Limits
        "page_numbers": page_numbers,
        "page_numbers_stored": page_numbers,
        "cap_per_shard": f"""
            WITH {_FEED} {_KEYS} FROM feed
            QUALIFY row_number() OVER (PARTITION BY "shardId" ORDER BY seq) <= 15""",
        "cap_per_shard_default": f"""
            WITH {_FEED} {_KEYS} FROM feed
            QUALIFY row_number() OVER (PARTITION BY "shardId" ORDER BY seq) <= 110000""",
        "cap_per_shard_large": f"""
            WITH {_FEED} SELECT CAST((event_id + 1) % 3 AS VARCHAR) AS "shardId", seq AS "sequenceNumber",
              "partitionKey", ts AS "approximateArrivalTimestamp" FROM feed
            QUALIFY row_number() OVER (PARTITION BY event_id % 3 ORDER BY seq) <= 1100""",
        "cap_unpacked": f"""
            WITH {_FEED}
            SELECT "shardId", seq AS "sequenceNumber", CAST(part AS INTEGER) AS "subSequence"
            FROM feed JOIN (SELECT unnest([0, 1]) AS part) parts ON part = 0 OR event_id % 3 = 0
            QUALIFY row_number() OVER (PARTITION BY "shardId" ORDER BY seq, part) <= 15""",
        "mixed_length_sequences": f"""
            WITH {_MIXED}
            SELECT "shardId", seq AS "sequenceNumber", "partitionKey", ts AS "approximateArrivalTimestamp"
            FROM mixed WHERE (length(digits), digits) > (25, '5' || repeat('0', 24))""",
        "mixed_length_ranges": f"""
            WITH {_MIXED}
            SELECT "shardId", arg_min(seq, (length(digits), digits)) AS "startSeq",
                   arg_max(seq, (length(digits), digits)) AS "headSeq", count(*) AS records
            FROM mixed GROUP BY "shardId" """,
        "batch_slice": f"WITH {_SLICE} {_KEYS} FROM slice",
        "batch_slice_pruned": f"WITH {_SLICE} {_KEYS} FROM slice",
        # Progress
        "next_positions": f"""
            WITH {_SLICE},
            m AS (SELECT "shardId", max(seq) AS s FROM slice GROUP BY "shardId"),
            standing AS (
              SELECT p."shardId", p."iteratorType", p."iteratorPosition", m.s,
                p."iteratorType" = 'SHARD_END'
                OR coalesce(k."endSeq" <= coalesce(m.s,
                     CASE WHEN p."iteratorType" = 'AFTER_SEQUENCE_NUMBER'
                          THEN p."iteratorPosition" END), false) AS done
              FROM pos p LEFT JOIN m ON m."shardId" = p."shardId"
              JOIN cat k ON k."shardId" = p."shardId")
            SELECT "shardId",
              CASE WHEN done THEN 'SHARD_END' WHEN s IS NOT NULL THEN 'AFTER_SEQUENCE_NUMBER'
                   ELSE "iteratorType" END AS "iteratorType",
              CASE WHEN done THEN '' ELSE coalesce(s, "iteratorPosition") END
                AS "iteratorPosition"
            FROM standing""",
        "next_offset": """
            SELECT event_type AS stream_name, max(dayofmonth(ts)) + 1 AS batch_id,
                   true AS is_new FROM events GROUP BY event_type
            UNION ALL
            SELECT o_orderpriority, max(year(o_orderdate)) - 1990, false
            FROM orders GROUP BY o_orderpriority""",
        "offset_encode": f"""
            WITH {_LOG}
            SELECT batch_id, '{{"metadata":{{"batchId":"' || batch_id
              || '","streamName":"events"}},'
              || string_agg('"' || "shardId" || '":{{"iteratorType":"' || "iteratorType"
                   || '","iteratorPosition":"' || "iteratorPosition" || '"}}',
                   ',' ORDER BY "shardId") || '}}' AS "offset"
            FROM log GROUP BY batch_id""",
        "many_streams_offsets": f"""
            WITH {_STREAMS}
            SELECT "streamName", '{{"metadata":{{"batchId":"7","streamName":"' || "streamName"
              || '"}},' || string_agg('"' || "shardId"
                   || '":{{"iteratorType":"AFTER_SEQUENCE_NUMBER","iteratorPosition":"'
                   || "headSeq" || '"}}', ',' ORDER BY "shardId") || '}}' AS "offset"
            FROM streams GROUP BY "streamName" """,
        "stream_offsets": f"""
            WITH {_CATALOGUE}
            SELECT 'events' AS "streamName", 0 AS batch_id, "shardId",
                   'AFTER_SEQUENCE_NUMBER' AS "iteratorType", "headSeq" AS "iteratorPosition" FROM ranges""",
        "offset_decode": f"""
            WITH {_LOG} SELECT 'events' AS "streamName", {_LOG_COLUMNS} FROM log""",
        "previous_positions": f"""
            WITH {_LOG} SELECT "shardId", "iteratorType", "iteratorPosition" FROM log
            WHERE batch_id = 15""",
        "stream_resume": f"""
            WITH {_FEED}
            SELECT seq AS "sequenceNumber", count(*) AS times FROM feed GROUP BY seq""",
        "stream_position_log": f"""
            WITH {_CATALOGUE},
            stage AS (
              SELECT "shardId", seq, CASE WHEN hour(ts) >= 18 AND bucket % 2 = 0 THEN 2
                WHEN hour(ts) >= 12 AND bucket % 2 = 0 THEN 1 ELSE 0 END AS n FROM feed),
            ends AS (
              SELECT batch_id, "shardId", max(seq) AS head FROM stage
              JOIN (SELECT unnest([0, 1, 2]) AS batch_id) ON n <= batch_id GROUP BY ALL)
            SELECT CAST(b.batch_id AS BIGINT) AS batch_id, cat."shardId",
              CASE WHEN head IS NULL THEN 'TRIM_HORIZON' WHEN head >= "endSeq" THEN 'SHARD_END'
                   ELSE 'AFTER_SEQUENCE_NUMBER' END AS "iteratorType",
              CASE WHEN head IS NULL OR head >= "endSeq" THEN '' ELSE head END AS "iteratorPosition"
            FROM cat CROSS JOIN (SELECT unnest([0, 1, 2]) AS batch_id) b
            LEFT JOIN ends ON ends."shardId" = cat."shardId" AND ends.batch_id = b.batch_id""",
        # Lineage
        "open_shards": f"""
            WITH {_CATALOGUE} SELECT "shardId", "startSeq" FROM cat WHERE "endSeq" IS NULL""",
        "closed_shards": f"""
            WITH {_CATALOGUE} SELECT "shardId", "startSeq", "endSeq" FROM cat
            WHERE "endSeq" IS NOT NULL""",
        "shard_parents": f"WITH {_PARENTS} SELECT * FROM parents",
        "shard_children": f"""
            WITH {_PARENTS}
            SELECT "parentId", string_agg("shardId", ',' ORDER BY "shardId") AS children
            FROM parents GROUP BY "parentId" """,
        "open_parent_violations": f"""
            WITH {_PARENTS},
            busy AS (SELECT DISTINCT "shardId" FROM feed WHERE hour(ts) = 23 AND minute(ts) >= 30)
            SELECT "shardId" FROM cat
            WHERE ("endSeq" IS NULL OR "shardId" IN (SELECT "shardId" FROM busy))
              AND "shardId" IN (SELECT "parentId" FROM parents)""",
        "shard_ancestors": f"""
            WITH RECURSIVE {_ANCESTORS}
            SELECT DISTINCT cat."shardId", cat.day < 28 AS seen
            FROM anc JOIN cat ON cat."shardId" = anc.a
            WHERE anc."shardId" IN (SELECT "shardId" FROM cat WHERE "endSeq" IS NULL)
              AND "endSeq" IS NOT NULL""",
        "latest_positions": f"""
            WITH RECURSIVE {_ANCESTORS},
            prev AS (SELECT "shardId", "endSeq" FROM cat WHERE day < 28),
            fresh AS (SELECT "shardId" FROM cat WHERE "endSeq" IS NULL
                      AND "shardId" NOT IN (SELECT "shardId" FROM prev)),
            added AS (SELECT "shardId" FROM fresh
                      UNION SELECT a FROM anc WHERE "shardId" IN (SELECT "shardId" FROM fresh)
                        AND a NOT IN (SELECT "shardId" FROM prev))
            SELECT "shardId", 'AFTER_SEQUENCE_NUMBER' AS "iteratorType",
                   "endSeq" AS "iteratorPosition" FROM prev
            UNION ALL SELECT "shardId", 'TRIM_HORIZON', '' FROM added""",
        # Position log
        "position_log_add": f"WITH {_LOG} SELECT {_LOG_COLUMNS} FROM log",
        "position_log_get": f"WITH {_LOG} SELECT {_LOG_COLUMNS} FROM log WHERE batch_id = 15",
        "position_log_purge": f"WITH {_LOG} SELECT {_LOG_COLUMNS} FROM log WHERE batch_id >= 10",
        "position_log_retention": f"""
            WITH {_LOG} SELECT {_LOG_COLUMNS} FROM log
            WHERE batch_id >= (SELECT max(batch_id) - 12 FROM log)""",
        "position_log_batches": f"""
            WITH {_LOG} SELECT DISTINCT CAST(batch_id AS BIGINT) AS batch_id FROM log""",
    }
