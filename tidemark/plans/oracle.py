"""Reference SQL (DuckDB dialect) for every registered query.

Each string recomputes its query's result from the raw parquet views with plain window and
aggregate SQL -- the sequential semantics written out directly -- so it checks the Spark
operators rather than repeating them. ``L`` is the fixture change log (``sources.fixture``).
"""

from __future__ import annotations

from ..sources import fixture as fx
from ..spec import ORDER_STATUSES

_STATUS_LIST = ", ".join(f"'{s}'" for s in ORDER_STATUSES)
_ALL_V = ", ".join(str(v) for v in range(fx.UPDATES_PER_KEY + 2))
_KEPT_V = ", ".join(str(v) for v in range(fx.UPDATES_PER_KEY + 1))
_DEL_V = fx.UPDATES_PER_KEY + 1

LOG_CTES = f"""
o AS (
  SELECT CAST(o_orderkey AS BIGINT) AS order_id, CAST(o_custkey AS BIGINT) AS cust,
         CAST(o_totalprice AS DECIMAL(18,2)) AS base
  FROM orders),
ov AS (
  SELECT order_id, cust, base,
         unnest(CASE WHEN order_id % {fx.DELETE_EVERY} = 0 THEN [{_ALL_V}] ELSE [{_KEPT_V}] END) AS v
  FROM o),
oe AS (SELECT *, order_id * {fx.EVENTS_PER_KEY} + v AS pos FROM ov),
L AS (
  SELECT order_id,
    CASE WHEN v = {_DEL_V} THEN NULL ELSE cust END AS customer_id,
    CASE WHEN v = {_DEL_V} THEN NULL ELSE [{_STATUS_LIST}][((order_id + v) % {len(ORDER_STATUSES)}) + 1] END AS status,
    CASE WHEN v = {_DEL_V} THEN NULL ELSE CAST(base + CAST(v AS DECIMAL(18,2)) AS DECIMAL(18,2)) END AS amount,
    CASE WHEN v = {_DEL_V} THEN NULL ELSE {fx.TS_BASE_MS} + (pos + 1) * {fx.TS_STEP_MS} END AS updated_ms,
    CASE WHEN v = 0 THEN 'c' WHEN v = {_DEL_V} THEN 'd' ELSE 'u' END AS op,
    pos + 1 AS _lsn,
    {fx.TS_BASE_MS} + (pos + 1) * {fx.TS_STEP_MS} AS ts_ms,
    pos + ((pos * {fx.DELAY_MULT} + {fx.DELAY_ADD}) % {fx.DELAY_MOD}) % {fx.DISORDER + 1} AS slot,
    pos,
    unnest(CASE WHEN pos % {fx.REDELIVER_EVERY} = 0 THEN [0, 1] ELSE [0] END) AS dup
  FROM oe),
LB AS (SELECT *, CAST(floor(slot / {fx.BATCH_SPAN}) AS BIGINT) AS batch FROM L)"""

ROW = "order_id, customer_id, status, amount, updated_ms, _lsn"


def with_log(*ctes: str, final: str) -> str:
    parts = [LOG_CTES.strip()] + [c.strip() for c in ctes]
    return "WITH " + ",\n".join(parts) + "\n" + final.strip()


# Per key, the greatest LSN, first arrival on a tie; tombstones kept.
FOLD_CTES = (
    """RANKED AS (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY _lsn DESC, slot, pos, dup) AS rn
  FROM L)""",
    """S AS (
  SELECT order_id,
    CASE WHEN op = 'd' THEN NULL ELSE customer_id END AS customer_id,
    CASE WHEN op = 'd' THEN NULL ELSE status END AS status,
    CASE WHEN op = 'd' THEN NULL ELSE amount END AS amount,
    CASE WHEN op = 'd' THEN NULL ELSE updated_ms END AS updated_ms,
    _lsn, op = 'd' AS _deleted
  FROM RANKED WHERE rn = 1)""",
    f"""T AS (SELECT {ROW} FROM S WHERE NOT _deleted)""",
)

ARRIVAL_FOLD_CTES = (
    """ARANKED AS (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY slot DESC, pos DESC, dup DESC) AS rn
  FROM L)""",
    f"""A AS (SELECT {ROW} FROM ARANKED WHERE rn = 1 AND op <> 'd')""",
)

ORACLE: dict[str, str] = {}


def register(name: str, sql: str) -> None:
    ORACLE[name] = sql


register("fold_lsn", with_log(*FOLD_CTES, final="SELECT * FROM T"))
register("fold_lsn_state", with_log(*FOLD_CTES, final="SELECT * FROM S"))
register("fold_arrival", with_log(*ARRIVAL_FOLD_CTES, final="SELECT * FROM A"))
register("fold_redelivered", ORACLE["fold_lsn"])
register("fold_order_independent", with_log(
    *FOLD_CTES, final=f"SELECT *, CAST({fx.DELIVERY_ORDERINGS} AS BIGINT) AS orderings FROM T"))
register("dedup_to_latest", with_log(
    """R AS (
  SELECT *, row_number() OVER (PARTITION BY batch, order_id ORDER BY _lsn DESC, slot, pos, dup) AS rn
  FROM LB)""",
    final="""SELECT batch, order_id, CASE WHEN op = 'd' THEN 'd' ELSE 'u' END AS op,
  customer_id, status, amount, updated_ms, _lsn FROM R WHERE rn = 1"""))

# -- counters and net changes ------------------------------------------------------------------

FLAG_CTES = (
    """W2 AS (
  SELECT *, max(_lsn) OVER (PARTITION BY order_id ORDER BY slot, pos, dup
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior
  FROM LB)""",
    """FL AS (
  SELECT slot, pos, dup, batch, order_id, _lsn, op, (prior IS NULL OR _lsn > prior) AS applied
  FROM W2)""",
)

register("applied_events", with_log(*FLAG_CTES, final="SELECT * FROM FL"))
register("merge_stats", with_log(*FLAG_CTES, final="""
SELECT count(*) AS seen, count(*) FILTER (WHERE applied) AS applied,
       count(*) FILTER (WHERE NOT applied) AS ignored FROM FL"""))
register("batch_stats", with_log(*FLAG_CTES, final="""
SELECT batch, count(*) AS delivered, count(*) FILTER (WHERE applied) AS applied,
       count(*) FILTER (WHERE NOT applied) AS ignored FROM FL GROUP BY batch"""))
register("pipeline_stats", with_log(*FLAG_CTES, *FOLD_CTES, final="""
SELECT (SELECT count(*) FROM FL) AS delivered,
       (SELECT count(*) FROM FL WHERE applied) AS applied,
       (SELECT count(*) FROM FL WHERE NOT applied) AS ignored,
       (SELECT count(DISTINCT batch) FROM FL) AS batches,
       (SELECT count(*) FROM T) AS live_rows"""))

NET_CTES = (
    """BR AS (
  SELECT *, row_number() OVER (PARTITION BY batch, order_id ORDER BY _lsn DESC, slot, pos, dup) AS rn
  FROM LB)""",
    """BP AS (
  SELECT *, max(_lsn) OVER (PARTITION BY order_id ORDER BY batch
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev
  FROM BR WHERE rn = 1)""",
    """NC AS (
  SELECT batch, order_id, customer_id, status, amount, updated_ms, _lsn,
         CASE WHEN op = 'd' THEN 'delete' ELSE 'upsert' END AS action
  FROM BP WHERE prev IS NULL OR _lsn > prev)""",
)
register("batch_net_changes", with_log(*NET_CTES, final="SELECT * FROM NC"))
register("batch_changed_keys", with_log(*NET_CTES, final="SELECT batch, order_id FROM NC"))
register("batch_against_state", with_log(
    """PB AS (
  SELECT batch, order_id, max(_lsn) AS mx, arg_max(op = 'd', _lsn) AS del
  FROM LB GROUP BY batch, order_id)""",
    """PR AS (
  SELECT batch, order_id, max(mx) OVER w AS stored_lsn, arg_max(del, mx) OVER w AS stored_deleted
  FROM PB
  WINDOW w AS (PARTITION BY order_id ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))""",
    final="""
SELECT e.slot, e.pos, e.dup, e.batch, e.order_id, e._lsn, p.stored_lsn, p.stored_deleted,
       CASE WHEN p.stored_lsn IS NULL THEN 'new' WHEN e._lsn > p.stored_lsn THEN 'apply'
            ELSE 'stale' END AS verdict
FROM LB e JOIN PR p ON e.batch = p.batch AND e.order_id = p.order_id"""))

# -- change-log images, envelopes and decode ---------------------------------------------------

register("changelog_before_after", with_log(
    """CP AS (
  SELECT *, lag(op) OVER w AS pop, lag(customer_id) OVER w AS pc, lag(status) OVER w AS ps,
         lag(amount) OVER w AS pa, lag(updated_ms) OVER w AS pu
  FROM L WHERE dup = 0
  WINDOW w AS (PARTITION BY order_id ORDER BY _lsn))""",
    final="""
SELECT order_id, _lsn, op,
  CASE WHEN pop <> 'd' THEN pc END AS before_customer_id,
  CASE WHEN pop <> 'd' THEN ps END AS before_status,
  CASE WHEN pop <> 'd' THEN pa END AS before_amount,
  CASE WHEN pop <> 'd' THEN pu END AS before_updated_ms,
  customer_id, status, amount, updated_ms
FROM CP"""))

DECODED_SQL = with_log(final="""
SELECT slot, pos, dup, order_id, customer_id, status, amount, updated_ms,
       CASE WHEN op = 'd' THEN 'd' ELSE 'u' END AS op, _lsn, ts_ms
FROM L""")
register("decode_envelope", DECODED_SQL)
register("decode_wrapped", DECODED_SQL)
register("json_round_trip", DECODED_SQL)
register("decode_op_counts", with_log(final="""
SELECT CASE WHEN op = 'd' THEN 'd' ELSE 'u' END AS op, count(*) AS n FROM L GROUP BY 1"""))
register("decode_event_time", with_log(final="""
SELECT slot, pos, dup, order_id, _lsn,
  COALESCE(NULLIF(CASE WHEN pos % 4 = 0 THEN 0 WHEN pos % 4 = 1 THEN NULL ELSE ts_ms END, 0),
           NULLIF(CASE WHEN pos % 8 = 1 THEN NULL ELSE ts_ms END, 0), 0) AS ts_ms
FROM L"""))
register("decode_rejects", with_log(final="""
SELECT reason, count(*) AS n FROM (
  SELECT CASE pos % 997
    WHEN 1 THEN 'bad_json' WHEN 2 THEN 'unknown_op' WHEN 3 THEN 'bad_lsn'
    WHEN 4 THEN 'no_image' WHEN 5 THEN 'no_key'
    WHEN 6 THEN CASE WHEN op = 'd' THEN 'ok' ELSE 'bad_value' END
    WHEN 7 THEN 'skipped' WHEN 8 THEN 'skipped'
    WHEN 9 THEN 'bad_json' WHEN 10 THEN 'bad_json' WHEN 11 THEN 'bad_json' WHEN 12 THEN 'bad_json'
    ELSE 'ok' END AS reason
  FROM L) GROUP BY reason"""))

# -- typed projection and reconciliation ---------------------------------------------------------

register("typed_projection", with_log(final="""
SELECT slot, pos, dup, order_id, customer_id, status,
       CAST(round_even(amount + 0.005, 2) AS DECIMAL(18,2)) AS amount, updated_ms
FROM L WHERE op <> 'd'"""))

RECON_CTES = FOLD_CTES + ARRIVAL_FOLD_CTES + (
    """J AS (
  SELECT COALESCE(t.order_id, a.order_id) AS order_id,
         t.order_id IS NOT NULL AS in_s, a.order_id IS NOT NULL AS in_l,
         (t.customer_id IS DISTINCT FROM a.customer_id OR t.status IS DISTINCT FROM a.status
          OR t.amount IS DISTINCT FROM a.amount OR t.updated_ms IS DISTINCT FROM a.updated_ms) AS differs,
         CAST(t.amount AS DECIMAL(38,2)) AS source_value, CAST(a.amount AS DECIMAL(38,2)) AS lake_value
  FROM T t FULL JOIN A a ON t.order_id = a.order_id)""",
    """K AS (
  SELECT order_id,
         CASE WHEN NOT in_l THEN 'missing' WHEN NOT in_s THEN 'extra'
              WHEN differs THEN 'mismatch' ELSE 'match' END AS class,
         CAST(abs(COALESCE(source_value, 0) - COALESCE(lake_value, 0)) AS DECIMAL(38,2)) AS drift,
         source_value, lake_value
  FROM J)""",
)

register("canonical_rows", with_log(*FOLD_CTES, *ARRIVAL_FOLD_CTES, final="""
SELECT 'source' AS side, order_id, customer_id, status, amount, updated_ms FROM T
UNION ALL
SELECT 'lake' AS side, order_id, customer_id, status, amount, updated_ms FROM A"""))
register("recon_keys", with_log(*RECON_CTES, final="SELECT order_id, class, drift FROM K"))
register("recon_missing", with_log(*FOLD_CTES, "LOSSY AS (SELECT * FROM T WHERE order_id % 101 <> 0)", final="""
SELECT t.order_id, CAST(abs(COALESCE(t.amount, 0) - COALESCE(l.amount, 0)) AS DECIMAL(38,2)) AS drift
FROM T t FULL JOIN LOSSY l ON t.order_id = l.order_id WHERE l.order_id IS NULL"""))
register("recon_extra", with_log(*RECON_CTES, final="SELECT order_id, drift FROM K WHERE class = 'extra'"))
register("recon_mismatch", with_log(*RECON_CTES, final="""
SELECT order_id, source_value, lake_value, drift FROM K WHERE class = 'mismatch'"""))
register("recon_summary", with_log(*RECON_CTES, final="""
SELECT count(*) FILTER (WHERE class <> 'extra') AS rows_source,
       count(*) FILTER (WHERE class <> 'missing') AS rows_lake,
       count(*) FILTER (WHERE class = 'missing') AS missing,
       count(*) FILTER (WHERE class = 'extra') AS extra,
       count(*) FILTER (WHERE class = 'mismatch') AS mismatch,
       (SELECT count(*) FROM (SELECT order_id FROM A GROUP BY order_id HAVING count(*) > 1)) AS duplicate_in_lake,
       CAST(COALESCE(sum(drift), 0) AS DECIMAL(38,2)) AS drift,
       CASE WHEN count(*) FILTER (WHERE class <> 'match') = 0 THEN 'parity' ELSE 'drift' END AS verdict
FROM K"""))
register("recon_drift", with_log(*RECON_CTES, final="""
SELECT class, count(*) AS keys, CAST(sum(drift) AS DECIMAL(38,2)) AS drift FROM K GROUP BY class"""))
register("recon_samples", with_log(*RECON_CTES, final="""
SELECT class, order_id, rn FROM (
  SELECT class, order_id, CAST(row_number() OVER (PARTITION BY class ORDER BY order_id) AS INTEGER) AS rn
  FROM K WHERE class <> 'match') WHERE rn <= 5"""))

# -- guarded merge, state table, streaming -------------------------------------------------------
# Each of these must equal the plain fold of the whole log, however the log was cut, replayed,
# compacted or streamed.

for _name in ("apply_changes", "state_read_live", "merge_microbatches", "resolve_on_read",
              "stream_merge", "stream_replay"):
    register(_name, ORACLE["fold_lsn"])
register("merge_guarded", ORACLE["fold_lsn_state"])
register("inspect_table", with_log(*FOLD_CTES, final="""
SELECT (SELECT count(*) FROM T) AS live_rows, (SELECT count(DISTINCT batch) FROM LB) AS snapshots"""))
# Snapshot rows carry the snapshot's LSN S, so a key untouched after S keeps S as its LSN.
register("bootstrap_from_snapshot", with_log(
    *FOLD_CTES, "SN AS (SELECT CAST(floor(max(_lsn) / 2) AS BIGINT) AS s FROM L)", final="""
SELECT order_id, customer_id, status, amount, updated_ms,
       CASE WHEN _lsn <= (SELECT s FROM SN) THEN (SELECT s FROM SN) ELSE _lsn END AS _lsn
FROM T"""))
# The lake of a correct merge, computed another way: per key the greatest LSN by aggregate, then its row.
register("recon_parity", with_log(
    *FOLD_CTES,
    "MX AS (SELECT order_id, max(_lsn) AS m FROM L GROUP BY order_id)",
    """B AS (SELECT DISTINCT L.order_id, customer_id, status, amount, updated_ms FROM L JOIN MX
  ON L.order_id = MX.order_id AND L._lsn = MX.m WHERE op <> 'd')""",
    """P AS (
  SELECT t.order_id AS s, b.order_id AS l, t.amount AS sa, b.amount AS la,
    (t.customer_id IS DISTINCT FROM b.customer_id OR t.status IS DISTINCT FROM b.status
     OR t.amount IS DISTINCT FROM b.amount OR t.updated_ms IS DISTINCT FROM b.updated_ms) AS differs
  FROM T t FULL JOIN B b ON t.order_id = b.order_id)""",
    final="""
SELECT count(s) AS rows_source, count(l) AS rows_lake,
       count(*) FILTER (WHERE l IS NULL) AS missing, count(*) FILTER (WHERE s IS NULL) AS extra,
       count(*) FILTER (WHERE s IS NOT NULL AND l IS NOT NULL AND differs) AS mismatch,
       (SELECT count(*) FROM (SELECT order_id FROM B GROUP BY order_id HAVING count(*) > 1)) AS duplicate_in_lake,
       CAST(COALESCE(sum(abs(COALESCE(sa, 0) - COALESCE(la, 0))), 0) AS DECIMAL(38,2)) AS drift,
       CASE WHEN count(*) FILTER (WHERE l IS NULL OR s IS NULL OR differs) = 0 THEN 'parity' ELSE 'drift' END AS verdict
FROM P"""))

# -- Kafka coordinates, several runs, streaming verdicts, a second table -------------------------

register("merge_batches_kafka_shape", ORACLE["fold_lsn"])
register("state_two_runs", ORACLE["fold_lsn"])
register("applied_events_partitioned", with_log(
    f"""TP AS (
  SELECT CAST(order_id % 4 AS INTEGER) AS partition, slot * {2 * fx.EVENTS_PER_KEY} + (pos % {fx.EVENTS_PER_KEY}) * 2 + dup AS "offset",
         order_id, _lsn FROM L)""",
    """TW AS (
  SELECT *, max(_lsn) OVER (PARTITION BY order_id ORDER BY partition, "offset"
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior FROM TP)""",
    final="""SELECT partition, "offset", order_id, _lsn, (prior IS NULL OR _lsn > prior) AS applied FROM TW"""))
register("epoch_verdicts", with_log(
    *FLAG_CTES,
    """RD AS (
  SELECT *, CAST(floor(batch * 4 / ((SELECT max(batch) FROM FL) + 1)) AS INTEGER) AS round FROM FL)""",
    "RM AS (SELECT round, order_id, max(_lsn) AS m FROM RD GROUP BY round, order_id)",
    """RV AS (
  SELECT r.round, r.applied, (SELECT max(m) FROM RM WHERE RM.order_id = r.order_id AND RM.round < r.round) AS stored, r._lsn
  FROM RD r)""",
    final="""
SELECT round, CASE WHEN stored IS NULL THEN 'new' WHEN _lsn > stored THEN 'apply' ELSE 'stale' END AS verdict,
       count(*) AS n, count(*) FILTER (WHERE applied) AS n_applied FROM RV GROUP BY 1, 2"""))
register("decode_before_images", with_log(
    """BI AS (
  SELECT order_id, _lsn, lag(op) OVER w AS pop, lag(order_id) OVER w AS pk, lag(customer_id) OVER w AS pc,
         lag(status) OVER w AS ps, lag(amount) OVER w AS pa, lag(updated_ms) OVER w AS pu
  FROM L WHERE dup = 0 WINDOW w AS (PARTITION BY order_id ORDER BY _lsn))""",
    final="""
SELECT L.slot, L.pos, L.dup, L._lsn, CASE WHEN pop <> 'd' THEN pk END AS before_order_id,
  CASE WHEN pop <> 'd' THEN pc END AS before_customer_id, CASE WHEN pop <> 'd' THEN ps END AS before_status,
  CASE WHEN pop <> 'd' THEN pa END AS before_amount, CASE WHEN pop <> 'd' THEN pu END AS before_updated_ms
FROM L JOIN BI ON L._lsn = BI._lsn"""))
ORACLE["fold_second_spec"] = """
WITH o AS (
  SELECT CAST(o_orderkey AS BIGINT) AS k, CAST(o_totalprice AS DECIMAL(18,2)) AS p, unnest([0, 1]) AS v FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY v DESC) AS rn FROM o)
SELECT 'T-' || k AS ticket, make_timestamp((1600000000000 + k * 1000 + v) * 1000) AS opened,
  CASE WHEN k % 2 = 0 THEN 'even "quoted"' END AS note,
  CAST(round_even(CAST((p + v) AS DECIMAL(18,6)) * CAST(0.125 AS DECIMAL(4,3)), 3) AS DECIMAL(18,3)) AS fee,
  k * 2 + v AS _lsn
FROM r WHERE rn = 1 AND k % 5 <> 0"""


# -- state by key ranges, commit log, keyed streams, event batches, digests ------------------------

ROUND_CTE = """RL AS (
  SELECT *, CAST(floor(batch * 4 / ((SELECT max(batch) FROM LB) + 1)) AS INTEGER) AS round FROM LB)"""


def _fold_of(source: str, name: str) -> str:
    """State, tombstones included, of the events of ``source``."""
    return f"""{name} AS (
  SELECT order_id, CASE WHEN op <> 'd' THEN customer_id END AS customer_id, CASE WHEN op <> 'd' THEN status END AS status,
         CASE WHEN op <> 'd' THEN amount END AS amount, CASE WHEN op <> 'd' THEN updated_ms END AS updated_ms,
         _lsn, op = 'd' AS _deleted
  FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY _lsn DESC, slot, pos, dup) AS rn FROM {source})
  WHERE rn = 1)"""


register("compact_incremental", ORACLE["fold_lsn_state"])
register("stream_state_store", ORACLE["fold_lsn_state"])
register("probe_pruned", with_log(
    ROUND_CTE, "OLD AS (SELECT * FROM RL WHERE round < 3)", _fold_of("OLD", "OS"), final="""
SELECT e.slot, e.pos, e.dup, e.order_id, e._lsn, o._lsn AS stored_lsn, o._deleted AS stored_deleted,
       CASE WHEN o._lsn IS NULL THEN 'new' WHEN e._lsn > o._lsn THEN 'apply' ELSE 'stale' END AS verdict
FROM RL e LEFT JOIN OS o ON e.order_id = o.order_id WHERE e.round = 3"""))
register("state_as_of", with_log(
    ROUND_CTE, "OLD AS (SELECT * FROM RL WHERE round < 2)", _fold_of("OLD", "OS"), final="SELECT * FROM OS"))
register("snapshot_history", with_log(ROUND_CTE, final="""
SELECT CAST(1 AS BIGINT) AS number, 'load' AS run, batch AS epoch, count(DISTINCT order_id) AS rows
FROM RL WHERE round < 2 GROUP BY batch
UNION ALL
SELECT CAST(round AS BIGINT) AS number, 'seq' AS run, CAST(round AS BIGINT) AS epoch, count(DISTINCT order_id) AS rows
FROM RL WHERE round >= 2 GROUP BY round"""))
register("epoch_counters", with_log(*FLAG_CTES, """RF AS (
  SELECT *, CAST(floor(batch * 4 / ((SELECT max(batch) FROM FL) + 1)) AS BIGINT) AS epoch FROM FL)""", final="""
SELECT epoch, count(*) AS delivered, count(*) AS accepted, CAST(0 AS BIGINT) AS rejected,
       count(*) FILTER (WHERE op = 'd') AS deletes, max(_lsn) AS max_lsn,
       count(*) FILTER (WHERE applied) AS applied, count(*) FILTER (WHERE NOT applied) AS ignored
FROM RF GROUP BY epoch"""))
register("batches_of_500", with_log(*FLAG_CTES, """CB AS (
  SELECT applied, CAST(floor((row_number() OVER (ORDER BY slot, pos, dup) - 1) / 500) AS BIGINT) AS batch FROM FL)""", final="""
SELECT batch, count(*) AS delivered, count(*) FILTER (WHERE applied) AS applied,
       count(*) FILTER (WHERE NOT applied) AS ignored FROM CB GROUP BY batch"""))
register("recon_by_digest", ORACLE["recon_summary"])
register("recon_by_digest_parity", ORACLE["recon_parity"])
