"""ANSI SQL (run by DuckDB on the same parquet tables) that each named
query must agree with. Column names match the Spark queries exactly.

The derived feed and capture are restated here from their definitions
(``feeds.py``, ``capture.py``) so the oracle does not share code with the
queries it checks.
"""

from __future__ import annotations

# Shared pieces ----------------------------------------------------------------

CH = """ch AS (
  SELECT event_id AS seq,
         CASE WHEN event_id % 5 = 0 THEN user_id + 1000000000 ELSE user_id END AS id,
         CASE WHEN event_id % 97 = 0 THEN 'D'
              WHEN event_type = 'signup' THEN 'I' ELSE 'U' END AS op,
         event_type AS name, value AS salary
  FROM events)"""

BASE = """base AS (
  SELECT c_custkey AS id, c_name AS name, c_acctbal AS salary FROM customer)"""

LATEST = """latest AS (
  SELECT seq, op, id, name, salary FROM (
    SELECT ch.*, ROW_NUMBER() OVER (PARTITION BY id ORDER BY seq DESC) AS rn
    FROM ch) x WHERE rn = 1)"""

# The decoded capture: positions 4 * event_id + 2; key moves on updates
# with event_id % 13 = 0; 'view' updates leave name unchanged, except beside a
# full old row (event_id % 11 = 0), which has it. ``moved`` is the old key.
DEC = """dec AS (
  SELECT 4 * seq + 2 AS _seq, 0 AS _sub, 94489280512 + (4 * seq + 2) * 24 AS _lsn,
         'D' AS _op, id, CAST(NULL AS VARCHAR) AS name,
         CAST(NULL AS DOUBLE) AS salary, '' AS unchanged, NULL AS moved
  FROM ch WHERE op = 'D'
  UNION ALL
  SELECT 4 * seq + 2, 0, 94489280512 + (4 * seq + 2) * 24, 'D', id, NULL, NULL, '', NULL
  FROM ch WHERE op = 'U' AND seq % 13 = 0
  UNION ALL
  SELECT 4 * seq + 2, 1, 94489280512 + (4 * seq + 2) * 24, 'I', id + 1000000,
         CASE WHEN name = 'view' THEN NULL ELSE name END, salary,
         CASE WHEN name = 'view' THEN 'name' ELSE '' END, id
  FROM ch WHERE op = 'U' AND seq % 13 = 0
  UNION ALL
  SELECT 4 * seq + 2, 0, 94489280512 + (4 * seq + 2) * 24, op, id,
         CASE WHEN op = 'U' AND name = 'view' AND seq % 11 <> 0 THEN NULL ELSE name END, salary,
         CASE WHEN op = 'U' AND name = 'view' AND seq % 11 <> 0 THEN 'name' ELSE '' END, NULL
  FROM ch WHERE op = 'I' OR (op = 'U' AND seq % 13 <> 0))"""

APPLY_IN_ORDER = f"""WITH {CH}, {BASE}, {LATEST}
SELECT id, name, salary FROM latest WHERE op <> 'D'
UNION ALL
SELECT id, name, salary FROM base b
WHERE NOT EXISTS (SELECT 1 FROM latest l WHERE l.id = b.id)"""

ALL_CHANGES = f"""WITH {CH}
SELECT seq AS _seq, op AS _op, id, name, salary FROM ch"""

LABELLED = """lab AS (
  SELECT doc_id, CASE WHEN quality IS NOT NULL OR n_chars > 1000 THEN lang END AS lang,
         quality, toxic FROM documents LEFT JOIN labels USING (doc_id))"""

# COPY text escaping of one value, as SQL (backslash first, then controls,
# then the delimiter; NULL as \\N).
def _copy(col: str) -> str:
    s = f"replace(CAST({col} AS VARCHAR), '\\', '\\\\')"
    for code, esc in ((8, "b"), (12, "f"), (10, "n"), (13, "r"), (9, "t"),
                      (11, "v")):
        s = f"replace({s}, chr({code}), '\\{esc}')"
    s = f"replace({s}, ',', '\\,')"
    return f"COALESCE({s}, '\\N')"


DOC_LINE = " || ',' || ".join(_copy(c) for c in
                              ("doc_id", "text", "lang", "source", "n_chars"))

SEG = f"""r AS (
  SELECT doc_id AS _seq, CAST(strlen({DOC_LINE}) + 1 AS BIGINT) AS _bytes
  FROM documents),
s AS (
  SELECT _seq, _bytes,
         CAST(SUM(_bytes) OVER (ORDER BY _seq ROWS BETWEEN UNBOUNDED PRECEDING
                                AND CURRENT ROW) AS BIGINT) AS _running
  FROM r),
g AS (
  SELECT _seq, _bytes, _running,
         CAST(FLOOR((_running - _bytes) / 1048576) AS BIGINT) AS segment_id
  FROM s)"""


# A moved row without its name takes the one its old key had just before (no
# row is moved twice here, so one step back is enough): the newest earlier
# change of the old key that sent it or deleted the row, else the base row's.
FILLED = """hist AS (
  SELECT id, _seq, _op, name FROM dec WHERE _op = 'D' OR unchanged = ''),
named AS (
  SELECT m._seq, CASE WHEN h.id IS NULL THEN b.name WHEN h._op = 'D' THEN NULL
                      ELSE h.name END AS name
  FROM dec m ASOF LEFT JOIN hist h ON h.id = m.moved AND h._seq < m._seq
  LEFT JOIN base b ON b.id = m.moved
  WHERE m.moved IS NOT NULL AND m.unchanged = 'name'),
full_ AS (
  SELECT d._seq, d._sub, d._op, d.id, d.salary,
         CASE WHEN n._seq IS NULL THEN d.name ELSE n.name END AS name,
         CASE WHEN n._seq IS NULL THEN d.unchanged ELSE '' END AS unchanged
  FROM dec d LEFT JOIN named n ON n._seq = d._seq AND d._sub = 1)"""


def _unchanged_fill() -> str:
    def last_set(col: str, alias: str) -> str:
        return f"""{alias} AS (
  SELECT id, _op AS {alias}_op, {col} AS {alias}_v FROM (
    SELECT id, _op, {col}, ROW_NUMBER() OVER (
      PARTITION BY id ORDER BY _seq DESC, _sub DESC) AS rn
    FROM full_
    WHERE _op = 'D' OR NOT list_contains(string_split(unchanged, ','), '{col}')
  ) x WHERE rn = 1)"""
    return f"""WITH {CH}, {BASE}, {DEC}, {FILLED},
lastop AS (
  SELECT id, _op FROM (
    SELECT id, _op, ROW_NUMBER() OVER (
      PARTITION BY id ORDER BY _seq DESC, _sub DESC) AS rn FROM dec) x
  WHERE rn = 1),
{last_set('name', 'nm')},
{last_set('salary', 'sl')},
touched AS (
  SELECT l.id,
    CASE WHEN nm.id IS NULL THEN b.name
         WHEN nm.nm_op = 'D' THEN NULL ELSE nm.nm_v END AS name,
    CASE WHEN sl.id IS NULL THEN b.salary
         WHEN sl.sl_op = 'D' THEN NULL ELSE sl.sl_v END AS salary
  FROM lastop l
  LEFT JOIN nm ON nm.id = l.id
  LEFT JOIN sl ON sl.id = l.id
  LEFT JOIN base b ON b.id = l.id
  WHERE l._op <> 'D')
SELECT id, name, salary FROM base b
WHERE NOT EXISTS (SELECT 1 FROM dec d WHERE d.id = b.id)
UNION ALL
SELECT id, name, salary FROM touched"""


# Sequential fill of 64 KiB segments with a header of 4096 bytes: from the
# start of a segment, the next one starts at the first row that does not fit.
FILL = f"""{SEG.replace("r AS (", "RECURSIVE r AS (", 1)},
st AS (
  SELECT 0 AS n, CAST(0 AS BIGINT) AS beg
  UNION ALL
  SELECT n + 1, x FROM (
    SELECT n, (SELECT MIN(_running - _bytes) FROM s
               WHERE _running > beg + 61440 AND _running - _bytes > beg) AS x FROM st) y
  WHERE x IS NOT NULL),
f AS (
  SELECT _seq, _bytes, _running,
         CAST((SELECT MAX(n) FROM st WHERE beg <= _running - _bytes) AS BIGINT) AS segment_id
  FROM s)"""

APPLY_WIDE_KEYS = """WITH n AS (SELECT COUNT(*) AS n FROM orders),
oc AS (
  SELECT event_id AS seq,
         CASE WHEN event_id % 97 = 0 THEN 'D'
              WHEN event_type = 'signup' THEN 'I' ELSE 'U' END AS op,
         (event_id * 7919) % (n.n + n.n // 4) AS o_orderkey, user_id AS o_custkey,
         substr(event_type, 1, 1) AS o_orderstatus, value AS o_totalprice,
         ts AS o_orderdate, event_type AS o_orderpriority
  FROM events, n),
latest AS (
  SELECT * FROM (SELECT oc.*, ROW_NUMBER() OVER (
    PARTITION BY o_orderkey ORDER BY seq DESC) AS rn FROM oc) x WHERE rn = 1)
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       o_orderpriority FROM latest WHERE op <> 'D'
UNION ALL
SELECT * FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM latest l WHERE l.o_orderkey = o.o_orderkey)"""

RELATION_AS_OF = """WITH d AS (
  SELECT event_id, datediff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS day
  FROM events),
f AS (SELECT day, MIN(event_id) AS first_id FROM d GROUP BY day)
SELECT 4 * d.event_id + 2 AS _seq, 4 * f.first_id + 1 AS rel_seq,
       'employee' AS "table",
       CASE WHEN d.day % 2 = 0 THEN 'id,name,salary' ELSE 'salary,id,name' END
         AS cols
FROM d JOIN f ON d.day = f.day"""


ORACLES: dict[str, str] = {
    "snapshot_scan": "SELECT * FROM orders",

    "feed_scan": ALL_CHANGES,
    "feed_stream": ALL_CHANGES,

    "route_by_op": f"""WITH {CH}
SELECT CASE WHEN op = 'D' THEN 'delete' ELSE 'append' END AS side,
       seq AS _seq, op AS _op, id, name, salary
FROM ch WHERE op IN ('I', 'U', 'D')""",

    "clock_parse": """SELECT event_id,
  CAST(epoch_us(ts) - 946684800000000 AS BIGINT) AS clock, ts FROM events""",

    "positional_names": "SELECT * FROM customer",

    "file_sink_deletes": f"""WITH {CH}
SELECT seq AS _seq, op AS _op, id, CASE WHEN op <> 'D' THEN name END AS name,
       CASE WHEN op <> 'D' THEN salary END AS salary FROM ch""",

    "file_sink_text": "SELECT doc_id, text, lang, source, n_chars FROM documents",

    "stream_new_checkpoint": APPLY_IN_ORDER,

    "snapshot_once": f"""WITH {BASE} SELECT id, name, salary, FALSE AS seeded_again FROM base""",

    "read_from_position": f"""WITH {CH}
SELECT seq AS _seq, op AS _op, id, name, salary FROM ch
WHERE seq > (SELECT CAST(FLOOR(MAX(event_id) / 2) AS BIGINT) FROM events)""",

    "copy_text_decode": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "snapshot_copy_dump": "SELECT doc_id, text, lang, source, n_chars FROM documents",

    "pgoutput_decode": f"""WITH {CH}, {DEC}
SELECT * EXCLUDE (moved) FROM dec""",

    "relation_as_of": RELATION_AS_OF,
    "relation_as_of_carry": RELATION_AS_OF,

    "lsn_parse": """SELECT event_id,
  printf('%X/%X', (94489280512 + event_id * 24) >> 32,
         (94489280512 + event_id * 24) & 4294967295) AS lsn_text,
  94489280512 + event_id * 24 AS lsn
FROM events""",

    "typed_parse": "SELECT * FROM customer",

    "cast_to_target": "SELECT * FROM customer",

    "route_by_table": f"""WITH {CH}
SELECT 'employee' AS _table, seq AS _seq, op AS _op FROM ch""",

    "required_any": f"""WITH {LABELLED}
SELECT * FROM lab WHERE lang IS NOT NULL OR quality IS NOT NULL""",

    "required_all": f"""WITH {LABELLED}
SELECT * FROM lab WHERE lang IS NOT NULL AND quality IS NOT NULL""",

    "required_default_keys": f"""WITH {LABELLED}
SELECT * FROM lab WHERE doc_id IS NOT NULL AND quality IS NOT NULL""",

    "latest_change_per_key": f"""WITH {CH}, {LATEST}
SELECT seq AS _seq, op AS _op, id, name, salary FROM latest""",

    "apply_in_order": APPLY_IN_ORDER,

    "apply_append_then_delete": f"""WITH {CH}, {BASE},
ups AS (
  SELECT id, name, salary FROM (
    SELECT ch.*, ROW_NUMBER() OVER (PARTITION BY id ORDER BY seq DESC) AS rn
    FROM ch WHERE op <> 'D') x WHERE rn = 1),
merged AS (
  SELECT id, name, salary FROM ups
  UNION ALL
  SELECT id, name, salary FROM base b
  WHERE NOT EXISTS (SELECT 1 FROM ups u WHERE u.id = b.id))
SELECT * FROM merged m
WHERE NOT EXISTS (SELECT 1 FROM ch WHERE ch.op = 'D' AND ch.id = m.id)""",

    "apply_wide_keys": APPLY_WIDE_KEYS,
    "apply_bucketed": APPLY_WIDE_KEYS,

    "upsert_by_key": f"""WITH {CH}, {BASE},
ups AS (
  SELECT id, name, salary FROM (
    SELECT ch.*, ROW_NUMBER() OVER (PARTITION BY id ORDER BY seq DESC) AS rn
    FROM ch WHERE op <> 'D') x WHERE rn = 1)
SELECT id, name, salary FROM base b
WHERE NOT EXISTS (SELECT 1 FROM ups u WHERE u.id = b.id)
UNION ALL
SELECT id, name, salary FROM ups""",

    "insert_if_absent": f"""WITH {CH}, {BASE},
src AS (
  SELECT id, CASE WHEN op = 'D' THEN NULL ELSE name END AS name,
         CASE WHEN op = 'D' THEN NULL ELSE salary END AS salary FROM ch
  UNION ALL
  SELECT id, name, salary FROM base),
new AS (
  SELECT DISTINCT id, name, salary FROM src s
  WHERE NOT EXISTS (
    SELECT 1 FROM base b
    WHERE b.id IS NOT DISTINCT FROM s.id AND b.name IS NOT DISTINCT FROM s.name
      AND b.salary IS NOT DISTINCT FROM s.salary))
SELECT id, name, salary FROM base
UNION ALL
SELECT id, name, salary FROM new""",

    "delete_by_key": f"""WITH {CH}, {BASE}
SELECT * FROM base b
WHERE NOT EXISTS (SELECT 1 FROM ch WHERE ch.op = 'D' AND ch.id = b.id)""",

    "delete_by_composite_key": """WITH n AS (SELECT COUNT(*) AS n FROM orders),
dels AS (
  SELECT (event_id * 7919) % n.n AS l_orderkey,
         CAST(event_id % 7 + 1 AS INTEGER) AS l_linenumber
  FROM events, n)
SELECT * FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM dels d WHERE d.l_orderkey = l.l_orderkey
                  AND d.l_linenumber = l.l_linenumber)""",

    "bootstrap_overlap": APPLY_IN_ORDER,
    "bootstrap_chunked": APPLY_IN_ORDER,

    "duplicate_keys": f"""WITH {CH}
SELECT id, COUNT(*) AS n FROM ch GROUP BY id HAVING COUNT(*) > 1""",

    "segment_plan": f"""WITH {SEG}
SELECT segment_id, COUNT(*) AS n_rows, CAST(SUM(_bytes) AS BIGINT) AS n_bytes,
       MIN(_seq) AS first_seq, MAX(_seq) AS last_seq
FROM g GROUP BY segment_id""",

    "segment_rows": f"""WITH {SEG}
SELECT _seq, _bytes, _running, segment_id FROM g""",

    "segment_fill": f"""WITH {FILL}
SELECT segment_id, COUNT(*) AS n_rows, CAST(SUM(_bytes) AS BIGINT) AS n_bytes,
       MIN(_seq) AS first_seq, MAX(_seq) AS last_seq
FROM f GROUP BY segment_id""",

    "segment_fill_rows": f"""WITH {FILL}
SELECT _seq, _bytes, _running, segment_id FROM f""",

    "key_lineage": """WITH moved AS (
  SELECT user_id, MAX(event_id) AS last,
         MAX(CASE WHEN event_id % 7 = 0 THEN event_id END) AS sent,
         ARG_MAX(value, event_id) AS salary
  FROM events GROUP BY user_id)
SELECT 1000000000 + last AS id,
       CASE WHEN sent IS NULL THEN c_name ELSE event_type END AS name, salary
FROM moved LEFT JOIN customer ON c_custkey = user_id
LEFT JOIN events e ON e.event_id = sent
UNION ALL
SELECT c_custkey, c_name, c_acctbal FROM customer
WHERE c_custkey NOT IN (SELECT user_id FROM events)""",

    "value_as_of": """SELECT p.event_id, p.user_id, s.event_id AS signup, s.value AS signup_value
FROM (SELECT event_id, user_id, MAX(CASE WHEN event_type = 'signup' THEN event_id END) OVER (
        ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS last FROM events) p
LEFT JOIN events s ON s.event_id = p.last""",

    "tombstone_rows": f"""WITH {CH}
SELECT seq AS _seq, op AS _op, id, CAST(NULL AS VARCHAR) AS name,
       CAST(NULL AS DOUBLE) AS salary
FROM ch WHERE op = 'D'""",

    "key_change_update": f"""WITH {CH}, {DEC}
SELECT _seq, _sub, _op, id, name, salary FROM (
  SELECT dec.*, ROW_NUMBER() OVER (
    PARTITION BY id ORDER BY _seq DESC, _sub DESC) AS rn FROM dec) x
WHERE rn = 1""",

    "unchanged_fill": _unchanged_fill(),
    "stream_decode_apply": _unchanged_fill(),

    "file_sink_rows": f"""WITH {CH}
SELECT seq AS _seq, op AS _op, id, name FROM ch""",

    "stream_csv_sink": f"""WITH {CH}
SELECT seq AS _seq, op AS _op, id, name FROM ch""",

    "staged_log": f"""WITH {CH},
m AS (SELECT MAX(event_id) AS top FROM events),
p AS (SELECT ch.*, CAST(FLOOR(seq * 10 / (m.top + 1)) AS INTEGER) AS part
      FROM ch, m)
SELECT seq AS _seq, op AS _op, id, name, salary FROM (
  SELECT p.*, ROW_NUMBER() OVER (PARTITION BY part, id ORDER BY seq DESC) AS rn
  FROM p) x WHERE rn = 1""",

    "stream_direct_batches": f"""WITH {CH},
m AS (SELECT MAX(event_id) AS top FROM events),
p AS (SELECT id, CAST(FLOOR(seq * 10 / (m.top + 1)) AS INTEGER) AS part, MAX(seq) AS seq
      FROM ch, m GROUP BY ALL)
SELECT COUNT(*) AS n_rows, MIN(seq) AS first_seq, MAX(seq) AS last_seq FROM p GROUP BY part""",

    "stream_reused_checkpoint": APPLY_IN_ORDER,
    "file_sink_replay": f"""WITH {CH}
SELECT seq AS _seq, op AS _op, id, name FROM ch""",

    "catalog_apply": APPLY_IN_ORDER,
    "catalog_apply_stream": APPLY_IN_ORDER,
    "catalog_key_scan": f"""SELECT * FROM ({APPLY_IN_ORDER}) t WHERE id = 2""",
    "catalog_unchanged_moves": _unchanged_fill(),
    "source_identity": """SELECT DISTINCT '7412345678901234567' AS system_id FROM events""",
    "source_identity_feeds": f"""WITH {CH}, {BASE},
h AS (SELECT CAST(FLOOR(MAX(event_id) / 2) AS BIGINT) AS half FROM events),
one AS (SELECT ch.* FROM ch, h WHERE seq <= half),
last AS (SELECT id, ARG_MAX(op, seq) AS op FROM one GROUP BY id),
n AS (SELECT (SELECT COUNT(*) FROM last WHERE op <> 'D')
           + (SELECT COUNT(*) FROM base WHERE id NOT IN (SELECT id FROM last)) AS n_rows)
SELECT CASE WHEN seq <= half THEN 'first' ELSE 'second' END AS feed, COUNT(*) AS n_changes,
       BOOL_AND(seq <= half) AS taken, ANY_VALUE(n_rows) AS n_rows
FROM ch, h, n GROUP BY 1""",

    "stream_apply": APPLY_IN_ORDER,
    "stream_apply_direct": APPLY_IN_ORDER,
    "stream_apply_buffered": APPLY_IN_ORDER,
    "stream_compact_vacuum": APPLY_IN_ORDER,
    "stream_resume": APPLY_IN_ORDER,

    "target_filter_scan": f"""SELECT * FROM ({APPLY_IN_ORDER}) t
WHERE name = 'purchase'""",

    "select_where_limit": """SELECT * FROM orders WHERE o_orderstatus = 'O'
ORDER BY o_totalprice DESC, o_orderkey LIMIT 100""",

    "insert_from_range": """SELECT l_orderkey AS id,
  unnest(generate_series(1::BIGINT, max(l_linenumber)::BIGINT)) AS k
FROM lineitem GROUP BY l_orderkey""",

    "render_rows": """SELECT CAST(c_custkey AS VARCHAR) || '|' || c_name || '|'
       || c_mktsegment AS line FROM customer""",
}
