"""The same queries in plain SQL over the given tables, without messages or parsing.

What every event's messages turn into follows from the event alone, so the SQL states the outcome
directly; that makes it an independent check of rendering, parsing and everything after.
"""

from __future__ import annotations

# Messages as they arrive, with the outcome of parsing and validation.
_FEED = """
ev AS (
  SELECT event_id, epoch_us(ts) // 1000 AS ts_ms, upper(event_type) AS base,
         CAST(value AS DECIMAL(18,2)) AS amount, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k
  FROM events),
feeds(feed_no, format, exchange, suffix) AS (
  VALUES (0, 'binance', 1, 'USDT'), (1, 'kraken', 2, '/USD'), (2, 'csv', 3, 'USD')),
copies(lo, hi, copy_no, delay) AS (
  VALUES (0, 99, 0, 0), (10, 19, 1, 5000), (20, 29, 1, 59999), (30, 39, 1, 60000),
         (40, 49, 1, 40000), (40, 49, 2, 80000)),
arrived AS (
  SELECT CAST(exchange AS BIGINT) AS exchange, format, format || '-feed' AS source,
         base || suffix AS symbol, amount, k,
         ts_ms AS exchange_ms, event_id AS source_id, ts_ms + 250 + delay AS ingest_ms,
         (event_id * 3 + feed_no) * 10 + copy_no AS arrival_seq, copy_no,
         CASE WHEN k IN (0, 5) THEN 'malformed_frame'
              WHEN k = 6 AND format <> 'kraken' THEN 'malformed_frame'
              WHEN k = 7 THEN 'bad_price'
              WHEN k = 9 THEN 'bad_time' END AS parse_reason
  FROM ev CROSS JOIN feeds JOIN copies ON ev.k BETWEEN copies.lo AND copies.hi),
judged AS MATERIALIZED (
  SELECT *, CASE WHEN parse_reason IS NOT NULL THEN parse_reason
                 WHEN k = 1 OR amount <= 0 THEN 'price_range'
                 WHEN k = 2 THEN 'bad_symbol'
                 WHEN k IN (3, 4) THEN 'time_skew' END AS reason
  FROM arrived),
valid AS MATERIALIZED (SELECT * FROM judged WHERE reason IS NULL)
"""

_TICK = """exchange, symbol, CAST(CAST(amount AS DECIMAL(38,18)) AS VARCHAR) AS price,
  CAST(CAST(k AS DECIMAL(38,18)) AS VARCHAR) AS volume, exchange_ms, source_id, ingest_ms"""

# After parsing only, these defects still show in the values.
_PARSED_TICK = """exchange, CASE WHEN k = 2 THEN 'A ' || symbol ELSE symbol END AS symbol,
  CAST(CAST(CASE WHEN k = 1 THEN -1 ELSE amount END AS DECIMAL(38,18)) AS VARCHAR) AS price,
  CAST(CAST(k AS DECIMAL(38,18)) AS VARCHAR) AS volume,
  CASE WHEN k = 3 THEN exchange_ms - 691200000 WHEN k = 4 THEN exchange_ms + 3600000
       ELSE exchange_ms END AS exchange_ms, source_id, ingest_ms, arrival_seq"""


def _chain(source: str, keys: str, time: str, order: str, window: str, name: str = "") -> str:
    """Rows of `source` in arrival order per key, and a walk that admits or drops one after another."""
    names = [k.strip() for k in keys.split(",")]
    same = " AND ".join(f"n.{k} = w.{k}" for k in names)
    columns = ", ".join(f"n.{k}" for k in names)
    return f"""
numbered{name} AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {time}, {order}) AS pos FROM {source}),
walk{name} AS (
  SELECT {keys}, pos, true AS admitted, {time} + {window} AS expiry FROM numbered{name} WHERE pos = 1
  UNION ALL
  SELECT {columns}, n.pos, n.{time} >= w.expiry,
         CASE WHEN n.{time} >= w.expiry THEN n.{time} + {window} ELSE w.expiry END
  FROM walk{name} w JOIN numbered{name} n ON {same} AND n.pos = w.pos + 1),
admitted{name} AS MATERIALIZED (
  SELECT numbered{name}.* FROM numbered{name} JOIN walk{name} USING ({keys}, pos) WHERE admitted)
"""


_KEY = "exchange, symbol, exchange_ms, source_id"


def _ticks_chain(window_ms: int, name: str = "") -> str:
    return _chain("valid", _KEY, "ingest_ms", "arrival_seq", str(window_ms), name)


def _feed(select: str, *ctes: str) -> str:
    return "WITH RECURSIVE " + ",".join([_FEED, *ctes]) + select


_FIRST = "first_seen AS (SELECT * FROM valid WHERE copy_no = 0)"


def _fnv(column: str) -> str:
    return f"""list_reduce(
      list_prepend(14695981039346656037::UHUGEINT,
                   list_transform(range(1, length({column}) + 1),
                                  lambda i: ascii(substr({column}, i, 1))::UHUGEINT)),
      lambda h, b: (xor(h, b) * 1099511628211::UHUGEINT) % 18446744073709551616::UHUGEINT)"""


def _parsed(name: str) -> str:
    return _feed(
        f"SELECT {_PARSED_TICK} FROM judged WHERE copy_no = 0 AND parse_reason IS NULL AND format = '{name}'"
    )


_BOUNDARIES = (39_999, 40_000, 40_001, 59_999, 60_000, 60_001)

_COUNTERS = """
marked AS (
  SELECT j.exchange, j.ingest_ms, j.reason IS NOT NULL AS is_dropped, a.arrival_seq IS NOT NULL AS is_written
  FROM judged j LEFT JOIN admitted a USING (arrival_seq))"""

_BATCHES = (
    _feed(
        f"""SELECT arrival_seq, shard, batch_slot,
  CAST((row_number() OVER (PARTITION BY shard, batch_slot ORDER BY ingest_ms, arrival_seq) + 2) // 3
       AS BIGINT) AS batch_no
FROM (SELECT *, CAST({_fnv("symbol")} % 8 AS BIGINT) AS shard, ingest_ms // 10000 AS batch_slot
      FROM admitted)""",
        _ticks_chain(60_000),
    )
)

# `following` is the place of the row that opens the next batch, if this one opens a batch.
_ALIGNED = _feed(
    """SELECT o.arrival_seq, o.shard, b.batch_no
FROM ordered o ASOF JOIN (SELECT shard, place, row_number() OVER (PARTITION BY shard ORDER BY place) AS batch_no FROM opened) b
  ON o.shard = b.shard AND o.place >= b.place""",
    _ticks_chain(60_000),
    f"""
sharded AS (SELECT *, CAST({_fnv("symbol")} % 8 AS BIGINT) AS shard FROM admitted),
ordered AS MATERIALIZED (
  SELECT arrival_seq, shard, row_number() OVER (PARTITION BY shard ORDER BY ingest_ms, arrival_seq) - 1 AS place,
    least(place + 3, count(*) OVER (PARTITION BY shard ORDER BY ingest_ms
      RANGE BETWEEN UNBOUNDED PRECEDING AND 9999 FOLLOWING)) AS following
  FROM sharded),
opened AS (
  SELECT shard, place, following FROM ordered WHERE place = 0
  UNION ALL
  SELECT n.shard, n.place, n.following FROM opened o JOIN ordered n ON n.shard = o.shard AND n.place = o.following)""",
)

_QUIET = _feed(
    """SELECT interval_ms, received_delta, CAST(sum(received_delta) OVER w AS BIGINT) AS received,
  CAST(sum(written_delta) OVER w AS BIGINT) AS written, CAST(sum(dropped_delta) OVER w AS BIGINT) AS dropped
FROM (SELECT slot * 600000 AS interval_ms, count(m.ingest_ms) FILTER (NOT is_dropped) AS received_delta,
        count(*) FILTER (is_written) AS written_delta, count(*) FILTER (is_dropped) AS dropped_delta
      FROM (SELECT unnest(range(min(ingest_ms) // 600000, max(ingest_ms) // 600000 + 1)) AS slot FROM marked)
      LEFT JOIN marked m ON m.ingest_ms // 600000 = slot GROUP BY slot)
WINDOW w AS (ORDER BY interval_ms)""",
    _ticks_chain(60_000),
    _COUNTERS,
)

_STORED = _feed(f"SELECT {_TICK} FROM first_seen", _FIRST)


def all_oracles() -> dict[str, str]:
    boundary = [_ticks_chain(w, f"_{w}") for w in _BOUNDARIES]
    boundary_select = " UNION ALL ".join(
        f"SELECT CAST({w} AS BIGINT) AS window_ms, exchange, count(*) AS admitted "
        f"FROM admitted_{w} GROUP BY exchange"
        for w in _BOUNDARIES
    )
    return {
        "source_registry_join": _feed(
            "SELECT source, format, count(*) AS frames FROM judged WHERE format <> 'kraken' GROUP BY ALL"
        ),
        "normalize_union": _feed(
            f"SELECT {_PARSED_TICK} FROM judged WHERE copy_no = 0 AND parse_reason IS NULL"
        ),
        "frame_size_cap": _feed(
            """SELECT format, count(*) AS frames, count(*) FILTER (bytes > 64) AS too_large,
  count(*) FILTER (bytes <= 64) AS parsed
FROM (SELECT format, length(symbol) + length(CAST(amount AS VARCHAR)) + length(CAST(k AS VARCHAR))
        + length(CAST(source_id AS VARCHAR)) + length(CAST(exchange_ms AS VARCHAR))
        + CASE format WHEN 'binance' THEN 32 WHEN 'kraken' THEN 28 ELSE 4 END AS bytes
      FROM judged) GROUP BY format"""
        ),
        "source_silence_gaps": _feed(
            """SELECT source, before AS from_ms, ingest_ms AS until_ms, ingest_ms - before AS gap_ms
FROM (SELECT source, ingest_ms, lag(ingest_ms) OVER (PARTITION BY source ORDER BY ingest_ms, arrival_seq)
        AS before FROM judged)
WHERE ingest_ms - before > 600000"""
        ),
        "source_silence_open": _feed(
            """SELECT format || '-feed' AS source, last AS from_ms, newest + 900000 - last AS gap_ms
FROM (SELECT format, max(ingest_ms) AS last FROM judged GROUP BY format),
     (SELECT max(ingest_ms) AS newest FROM judged)
UNION ALL SELECT 'Idle-Feed', NULL, NULL"""
        ),
        "parse_bad_bytes": _feed(
            """SELECT format, reason, count(*) AS frames
FROM (SELECT format, CASE
        WHEN format = 'csv' AND source_id % 3 = 0 THEN 'invalid_utf8'
        WHEN format = 'kraken' AND source_id % 3 = 1 AND parse_reason = 'malformed_frame' THEN 'invalid_utf8'
        ELSE parse_reason END AS reason
      FROM judged) GROUP BY ALL"""
        ),
        "conservation_by_source": _feed(
            """SELECT upper(source) AS source, count(*) AS frames,
  count(*) FILTER (format = 'csv') AS unlisted, count(*) FILTER (format = 'kraken') AS disabled,
  count(*) FILTER (format = 'binance' AND NOT is_dropped) AS received,
  count(*) FILTER (format = 'binance' AND is_dropped) AS dropped,
  count(*) FILTER (format = 'binance' AND is_written) AS written
FROM marked GROUP BY 1""",
            _ticks_chain(60_000),
            _COUNTERS.replace("SELECT j.exchange", "SELECT j.source, j.format, j.exchange"),
        ),
        "metrics_quiet_intervals": _QUIET,
        "stream_quiet_intervals": _QUIET,
        "ingest_two_batches": _feed(f"SELECT {_TICK} FROM admitted", _ticks_chain(60_000)),
        "batch_then_stream": _feed(f"SELECT {_TICK} FROM admitted", _ticks_chain(60_000)),
        "stored_arrival_numbers": _feed("SELECT arrival_seq, symbol, source_id FROM admitted", _ticks_chain(60_000)),
        "offset_instants": "SELECT event_id AS source_id, epoch_us(ts) // 1000 AS exchange_ms, "
        "epoch_us(ts) // 86400000000 AS day FROM events",
        "parse_binance": _parsed("binance"),
        "parse_kraken": _parsed("kraken"),
        "parse_csv": _parsed("csv"),
        "parse_rejects_by_reason": _feed(
            """SELECT format, parse_reason AS reason, count(*) AS frames FROM judged
WHERE parse_reason IS NOT NULL GROUP BY ALL"""
        ),
        "validate_accept": _feed(f"SELECT {_TICK}, arrival_seq FROM valid"),
        "validate_reasons": _feed(
            "SELECT format, reason, count(*) AS frames FROM judged WHERE reason IS NOT NULL GROUP BY ALL"
        ),
        "quarantine_rows": _feed(
            "SELECT source, format, reason, ingest_ms, arrival_seq FROM judged WHERE reason IS NOT NULL"
        ),
        "symbol_fnv1a64": f"""
WITH names AS (
  SELECT c_name AS name FROM customer UNION SELECT p_name FROM part
  UNION SELECT upper(event_type) || suffix FROM events CROSS JOIN (VALUES ('USDT'), ('/USD'), ('USD')) s(suffix))
SELECT name, CAST({_fnv("name")} AS VARCHAR) AS hash FROM names""",
        "symbol_shard": f"SELECT c_custkey, CAST({_fnv('c_name')} % 8 AS BIGINT) AS shard FROM customer",
        "shard_tick_counts": _feed(
            f"""SELECT shard, CAST(sum(n) AS BIGINT) AS received, count(*) AS symbols
FROM (SELECT symbol, count(*) AS n, CAST({_fnv("symbol")} % 8 AS BIGINT) AS shard FROM valid GROUP BY symbol)
GROUP BY shard"""
        ),
        "ticks_with_shard": _feed(
            f"""SELECT arrival_seq, symbol, shard FROM valid
JOIN (SELECT DISTINCT symbol, CAST({_fnv("symbol")} % 8 AS BIGINT) AS shard FROM valid) USING (symbol)"""
        ),
        "dedup_sliding_window": _feed(f"SELECT {_TICK}, arrival_seq FROM admitted", _ticks_chain(60_000)),
        "dedup_counts": _feed(
            """SELECT exchange, count(*) AS received, count(*) FILTER (admitted) AS admitted,
  count(*) FILTER (NOT admitted) AS deduplicated FROM walk GROUP BY exchange""",
            _ticks_chain(60_000),
        ),
        "dedup_window_boundary": _feed(boundary_select, *boundary),
        "dedup_exact_key": _feed(
            """SELECT symbol, count(DISTINCT (exchange, exchange_ms, source_id)) AS admitted,
  count(DISTINCT exchange_ms) AS instants FROM valid GROUP BY symbol"""
        ),
        "dedup_lineitem": "WITH RECURSIVE items AS (SELECT *, epoch_us(l_shipdate) AS t FROM lineitem),"
        + _chain(
            "items",
            "l_orderkey, l_linenumber",
            "t",
            "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus",
            "2592000000000",
        )
        + """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey,
  l_extendedprice, t // 1000 AS ship_ms FROM admitted""",
        "dedup_hot_keys": "WITH RECURSIVE rows_in AS (SELECT event_type, event_id, user_id, epoch_us(ts) AS t FROM events),"
        + _chain("rows_in", "event_type", "t", "event_id", "3600000000")
        + "SELECT event_type, t AS ts_us, event_id, user_id FROM admitted",
        "dedup_user_events": "WITH RECURSIVE rows_in AS (SELECT event_type, event_id, user_id, epoch_us(ts) AS t FROM events),"
        + _chain("rows_in", "user_id, event_type", "t", "event_id", "86400000000")
        + "SELECT user_id, event_type, t AS ts_us, event_id FROM admitted",
        "write_batch_numbers": _BATCHES,
        "write_batch_numbers_split": _BATCHES,
        "write_batches_aligned": _ALIGNED,
        "metrics_totals": _feed(
            """SELECT exchange, count(*) FILTER (NOT is_dropped) AS received,
  count(*) FILTER (NOT is_dropped AND NOT is_written) AS deduplicated,
  count(*) FILTER (is_written) AS written, count(*) FILTER (is_dropped) AS dropped,
  count(*) FILTER (NOT is_dropped) - count(*) FILTER (is_written) AS gap
FROM marked GROUP BY exchange""",
            _ticks_chain(60_000),
            _COUNTERS,
        ),
        "metrics_per_interval": _feed(
            """SELECT interval_ms, received_delta, deduplicated_delta, written_delta, dropped_delta,
  CAST(sum(received_delta) OVER w AS BIGINT) AS received,
  CAST(sum(deduplicated_delta) OVER w AS BIGINT) AS deduplicated,
  CAST(sum(written_delta) OVER w AS BIGINT) AS written,
  CAST(sum(dropped_delta) OVER w AS BIGINT) AS dropped
FROM (SELECT ingest_ms // 3600000 * 3600000 AS interval_ms,
        count(*) FILTER (NOT is_dropped) AS received_delta,
        count(*) FILTER (NOT is_dropped AND NOT is_written) AS deduplicated_delta,
        count(*) FILTER (is_written) AS written_delta, count(*) FILTER (is_dropped) AS dropped_delta
      FROM marked GROUP BY 1)
WINDOW w AS (ORDER BY interval_ms)""",
            _ticks_chain(60_000),
            _COUNTERS,
        ),
        "ingest_end_to_end": _STORED,
        "ingest_counters": _feed(
            """SELECT CAST(0 AS BIGINT) AS batch_id, count(*) FILTER (reason IS NULL) AS received,
  count(*) FILTER (reason IS NULL AND copy_no > 0) AS deduplicated,
  count(*) FILTER (reason IS NULL AND copy_no = 0) AS written,
  count(*) FILTER (reason IS NOT NULL) AS dropped FROM judged"""
        ),
        "insert_ignore": _STORED,
        "stream_ingest": _feed(f"SELECT {_TICK} FROM admitted", _ticks_chain(60_000)),
        "ticks_count": _feed(
            "SELECT count(*) AS ticks, count(DISTINCT (exchange, symbol, exchange_ms, source_id)) AS keys FROM admitted",
            _ticks_chain(60_000),
        ),
        "ticks_distinct_exchange": _feed("SELECT DISTINCT exchange FROM first_seen", _FIRST),
        "ticks_by_exchange_name": _feed(
            """SELECT CASE exchange WHEN 1 THEN 'Binance' WHEN 2 THEN 'Kraken' ELSE 'Coinbase' END
  AS exchange_name, count(*) AS ticks FROM first_seen GROUP BY 1""",
            _FIRST,
        ),
        "ticks_point_read": _feed(
            f"SELECT symbol, price, volume, source_id FROM (SELECT {_TICK} FROM first_seen) WHERE symbol = 'CLICK/USD'",
            _FIRST,
        ),
        "ticks_time_range": _feed(
            """SELECT exchange, symbol, exchange_ms, source_id FROM first_seen
WHERE exchange_ms BETWEEN epoch_us(TIMESTAMP '2024-01-05 00:00:00') // 1000
  AND epoch_us(TIMESTAMP '2024-01-09 12:00:00') // 1000""",
            _FIRST,
        ),
        "duplicate_tick_keys": _feed(
            f"SELECT {_KEY}, count(*) AS copies FROM valid GROUP BY ALL HAVING count(*) > 1"
        ),
    }
