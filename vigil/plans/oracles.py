"""The same results in plain SQL, over the same tables."""

from __future__ import annotations

from vigil.plans.queries import LOADED_AT, REPLAY, TRAINED_AT

LIMIT, COOLDOWN = REPLAY.trigger_limit, REPLAY.cooldown_ms
HISTORY, CHUNK, REFRESH = REPLAY.history_limit, REPLAY.chunk_rows, REPLAY.refresh_ms

DEV = """
dev AS (SELECT user_id::INT AS id, epoch_us(ts) // 1000 AS eventtime, value,
               trunc(value)::BIGINT AS bp, event_id, event_type FROM events)"""

MSG = """
parts AS (SELECT event_id, event_type, (user_id + 1000)::INT AS id, epoch_us(ts) // 1000 AS eventtime,
                 110 + user_id % 26 AS base, regexp_extract(props, '"k": *(-?[0-9]+)', 1)::INT AS k FROM events),
raw AS (SELECT *, k % 15 - 7 AS variation,
               CASE WHEN event_type = 'error' AND k % 10 = 0 THEN 5 ELSE 1 END AS isanomaly FROM parts),
msg AS (SELECT event_id, event_type, id, eventtime,
               CASE WHEN isanomaly = 1 THEN base::DOUBLE ELSE base::DOUBLE * 1.1::DOUBLE END + variation::DOUBLE AS value,
               base::DOUBLE AS base FROM raw),
txt AS (SELECT *, '{"source":{"id":' || id || ',"base":' || base || '},"eventtime":' || eventtime ||
               ',"variation":' || variation || ',"isanomaly":' || isanomaly || '}' AS body FROM raw)"""

WALK = f"""
ordered AS (SELECT id, eventtime AS t, row_number() OVER (PARTITION BY id ORDER BY eventtime, event_id) AS rn FROM {{src}}),
walk AS (
  SELECT id, rn, t, 1 AS seen, NULL::BIGINT AS pause_end, false AS hit FROM ordered WHERE rn = 1
  UNION ALL
  SELECT o.id, o.rn, o.t,
    CASE WHEN w.pause_end IS NOT NULL AND o.t < w.pause_end THEN w.seen WHEN w.seen + 1 >= {LIMIT} THEN 0 ELSE w.seen + 1 END,
    CASE WHEN w.pause_end IS NOT NULL AND o.t < w.pause_end THEN w.pause_end
         WHEN w.seen + 1 >= {LIMIT} THEN o.t + {COOLDOWN} ELSE w.pause_end END,
    NOT coalesce(o.t < w.pause_end, false) AND w.seen + 1 >= {LIMIT}
  FROM walk w JOIN ordered o ON o.id = w.id AND o.rn = w.rn + 1),
trig AS (SELECT id, t AS eventtime FROM walk WHERE hit)"""

COLLECTED = f"""
collected AS (
  SELECT * FROM (
    SELECT g.id, g.eventtime AS trained_at, d.eventtime, trunc(d.value)::INT AS value,
           row_number() OVER (PARTITION BY g.id, g.eventtime ORDER BY d.eventtime DESC) AS rn
    FROM trig g JOIN {{src}} d ON d.id = g.id AND d.eventtime <= g.eventtime)
  WHERE rn <= {HISTORY})"""

LATEST = f"""
latest AS (
  SELECT * FROM (SELECT id, eventtime, bp::INT AS value,
                        row_number() OVER (PARTITION BY id ORDER BY eventtime DESC) AS rn FROM dev)
  WHERE rn <= {HISTORY})"""


def _fit(name, source, trained_at):
    grouped = "id, trained_at" if trained_at == "trained_at" else "id"
    return f"""
{name}_stats AS (SELECT id, count(*) AS n, sum(value::BIGINT)::BIGINT AS s, sum(value::BIGINT * value::BIGINT)::BIGINT AS ss,
                 {trained_at} AS trained_at FROM {source} GROUP BY {grouped}),
{name} AS (SELECT id, 'model_' || id || '_' || strftime(make_timestamp(trained_at * 1000), '%M') AS model, n, s, ss,
                  s::DOUBLE / n::DOUBLE AS centroid, sqrt((n * ss - s * s)::DOUBLE) / n::DOUBLE AS radius, trained_at
           FROM {name}_stats)"""


VERSIONS = _fit("versions", "collected", "trained_at")
VISIBLE = f"""
visible AS (SELECT *, (trained_at // {REFRESH} + 1) * {REFRESH} AS effective_from FROM versions)"""


def _distance(bp, m="m"):
    return f"""CASE WHEN {m}.n IS NULL THEN 0::DOUBLE
         WHEN {m}.n * {m}.ss - {m}.s * {m}.s > 0
           THEN abs({bp} * {m}.n - {m}.s)::DOUBLE / sqrt(({m}.n * {m}.ss - {m}.s * {m}.s)::DOUBLE)
         WHEN {bp} * {m}.n = {m}.s THEN 0::DOUBLE ELSE 'infinity'::DOUBLE END"""


def _sql(*ctes, select):
    return f"WITH RECURSIVE {', '.join(ctes)}\n{select}"


def _replay(src):
    return WALK.format(src=src), COLLECTED.format(src=src), VERSIONS, VISIBLE


def _msg_scores():
    whole = "(SELECT id, eventtime, trunc(value)::BIGINT AS value FROM msg)"
    scored = f"""
scored AS (SELECT e.id, e.eventtime, e.value, e.base, {_distance('trunc(e.value)::BIGINT')} AS distance
           FROM msg e LEFT JOIN models m ON m.id = e.id)"""
    return MSG, _fit("models", whole, "max(eventtime)"), scored


def _windows(length, extra="", source=DEV, rows="dev"):
    return _sql(source, select=f"""
SELECT make_timestamp(w * {length} * 1000) AS window_start, make_timestamp((w + 1) * {length} * 1000) AS window_end,
       count(*) AS batch_rows, min(eventtime) AS first_eventtime, max(eventtime) AS last_eventtime
FROM (SELECT eventtime, eventtime // {length} AS w FROM {rows}) {extra} GROUP BY w""")


LATEST_CHUNKS = f"(SELECT id, rn // {CHUNK} AS chunk, count(*) AS n FROM latest GROUP BY ALL)"
LOADED = f"TIMESTAMP '{LOADED_AT}'"


def _stamp(ms):
    return f"make_timestamp({ms} * 1000)"


# The events before the middle of the table's time, and those of them that come first.
HALVES = """
middle AS (SELECT (min(eventtime) + max(eventtime)) // 2 AS half_time FROM dev),
halves AS (SELECT dev.*, eventtime < half_time AS early, eventtime < half_time AND event_id % 7 <> 0 AS in_first
           FROM dev, middle)"""


def _late(stage, length, lateness):
    return f"""
SELECT '{stage}' AS stage, {_stamp(f'w * {length}')} AS window_start, {_stamp(f'(w + 1) * {length}')} AS window_end,
       count(*) AS batch_rows, min(eventtime) AS first_eventtime, max(eventtime) AS last_eventtime
FROM (SELECT *, eventtime // {length} AS w FROM halves)
WHERE (in_first OR (w + 1) * {length} > (SELECT max(eventtime) - {lateness} FROM halves WHERE in_first))
  AND (w + 1) * {length} <= (SELECT max(eventtime) - {lateness} FROM halves)
GROUP BY w"""


USABLE = "event_type NOT IN ('error', 'view') AND NOT (event_type = 'click' AND k % 10 IN (1, 2))"

# The three steps in which the events of the pane query come, and the watermark in each.
ARRIVED = """
ends AS (SELECT min(eventtime) AS t0, max(eventtime) AS t1 FROM dev),
arrived AS (
  SELECT dev.*, least(3, CASE WHEN eventtime < t0 + (t1 - t0) // 3 THEN 1 WHEN eventtime < t0 + 2 * (t1 - t0) // 3 THEN 2 ELSE 3 END
                         + CASE WHEN event_id % 7 = 0 THEN 1 + event_id % 2 ELSE 0 END) AS step FROM dev, ends),
marks AS (SELECT s AS step, coalesce((SELECT max(eventtime) FROM arrived WHERE arrived.step < s), 0) AS mark
          FROM range(1, 4) t(s))"""


def _panes(length, lateness):
    """Without a delay each batch fires what it brings. With a long one, rows wait for the first later step whose
    watermark has passed the end of their window, or for late ones the end and the lateness."""
    panes = "count(*) AS batch_rows, min(eventtime) AS first_eventtime, max(eventtime) AS last_eventtime"
    kind = f"""CASE WHEN w + {length + lateness} <= mark THEN 'dropped' WHEN w + {length} <= mark THEN 'late' ELSE 'early' END"""
    return _sql(DEV, ARRIVED, f"""
placed AS (SELECT eventtime, step, w, {kind} AS firing
           FROM (SELECT *, eventtime // {length} * {length} AS w FROM arrived JOIN marks USING (step))),
waiting AS (
  SELECT p.*, CASE WHEN firing = 'dropped' THEN step ELSE (
      SELECT min(m.step) FROM marks m
      WHERE m.step > p.step AND p.w + {length} + CASE WHEN firing = 'late' THEN {lateness} ELSE 0 END <= m.mark) END AS fired
  FROM placed p)""", select=f"""
SELECT 'none' AS delay, w AS window_start, firing, {panes} FROM placed GROUP BY step, w, firing
UNION ALL
SELECT 'long' AS delay, w AS window_start, CASE WHEN firing = 'early' THEN 'on time' ELSE firing END AS firing, {panes}
FROM waiting WHERE fired IS NOT NULL GROUP BY fired, w, firing""")


def _stored_or_late(stage, lateness):
    return f"""
SELECT '{stage}' AS stage, id + 1000 AS id, eventtime,
       in_first OR (eventtime // 2000 + 1) * 2000 + {lateness} > (SELECT max(eventtime) FROM halves WHERE in_first) AS stored
FROM halves"""


def oracle_sql() -> dict[str, str]:
    dev_models = _fit("models", "(SELECT id, eventtime, bp AS value FROM dev)", "max(eventtime)")
    latest_models = _fit("models", "latest", "max(eventtime)")
    replay = _replay("dev")
    text = "strftime({}, '%Y-%m-%d %H:%M:%S.%g')"
    rejects = _sql(MSG, select="""
SELECT CASE WHEN event_type = 'error' THEN substr(body, 1, 30)
            WHEN event_type = 'view' THEN replace(body, '"eventtime":' || eventtime || ',', '')
            WHEN k % 10 = 1 THEN replace(body, '"base":' || base, '"base":NaN')
            ELSE replace(body, '"base":' || base, '"base":1e12') END AS data
FROM txt WHERE event_type IN ('error', 'view') OR event_type = 'click' AND k % 10 IN (1, 2)""")
    snapshot_windows = _sql(DEV, select=f"""
SELECT t.tick, coalesce(u.n_events, 0) AS n_events
FROM (SELECT unnest(range(min(eventtime) // {REFRESH} * {REFRESH}, max(eventtime) + 1, {REFRESH})) AS tick FROM dev) t
LEFT JOIN (SELECT eventtime // {REFRESH} * {REFRESH} AS tick, count(*) AS n_events FROM dev GROUP BY 1) u USING (tick)""")
    live_training = (f"""
latest AS (
  SELECT * FROM (SELECT id, eventtime, trunc(value)::INT AS value, count(*) OVER (PARTITION BY id) AS events,
                        row_number() OVER (PARTITION BY id ORDER BY eventtime DESC) AS rn FROM msg)
  WHERE rn <= {HISTORY} AND events >= {LIMIT})""", _fit("models", "latest", f"{TRAINED_AT}::BIGINT"))
    window_start = _stamp("(eventtime // 2000 * 2000)")
    window_end = _stamp("(eventtime // 2000 * 2000 + 2000)")
    anomaly_log = _sql(*_msg_scores(), select=f"""
SELECT id, eventtime, 'Anomaly Detected: Event: (' || id || ', ' || eventtime || ', ' || trunc(value)::BIGINT ||
       '), Timestamp: ' || {text.format(_stamp('eventtime'))} || ', Window: [' || {text.format(window_start)} || ', ' ||
       {text.format(window_end)} || '), Current Time ' || {text.format(LOADED)} AS line
FROM scored WHERE distance > 3.0::DOUBLE""")
    return {
        "decode_events": _sql(MSG, select="SELECT id, eventtime, value, base FROM msg"),
        "decode_damaged": _sql(MSG, select="""
SELECT id, eventtime, CASE WHEN event_type = 'click' AND k % 10 = 4
         THEN base::DOUBLE * 1.1::DOUBLE + variation::DOUBLE ELSE value END AS value, base::DOUBLE AS base
FROM raw JOIN (SELECT event_id, value FROM msg) USING (event_id)
WHERE event_type NOT IN ('error', 'view') AND NOT (event_type = 'click' AND k % 10 IN (1, 2))"""),
        "reject_reasons": _sql(MSG, select="""
SELECT reason, count(*) AS n_messages FROM (
  SELECT CASE WHEN event_type = 'error' THEN 'no message' WHEN event_type = 'view' THEN 'no eventtime'
              WHEN k % 10 IN (1, 2) AND event_type = 'click' THEN 'value out of range' END AS reason FROM raw)
WHERE reason IS NOT NULL GROUP BY reason"""),
        "reject_messages": rejects,
        "reject_stream": rejects,
        "key_triples": _sql(MSG, select="SELECT id, eventtime, trunc(value)::BIGINT AS value FROM msg"),
        "event_time": _sql(MSG, select=f"SELECT id, eventtime, {_stamp('eventtime')} AS event_ts FROM msg"),
        "stored_readings": _sql(MSG, select="SELECT id AS device_id, eventtime, trunc(value)::INT AS value FROM msg"),
        "window_batches": _windows(3_600_000),
        "window_batches_2s": _windows(2_000),
        "training_windows_15s": _sql(DEV, WALK.format(src="dev"), select=f"""
SELECT id, eventtime, {_stamp('(eventtime // 15000 * 15000)')} AS window_start,
       {_stamp('(eventtime // 15000 * 15000 + 15000)')} AS window_end FROM trig"""),
        "count_per_device": _sql(DEV, select="SELECT id, count(*) AS n_events FROM dev GROUP BY id"),
        "snapshot_windows": snapshot_windows,
        "ticks_stream": snapshot_windows,
        "collection_triggers": _sql(DEV, WALK.format(src="dev"), select="SELECT id, eventtime FROM trig"),
        "collection_triggers_sliced": _sql(DEV, WALK.format(src="dev"), select="SELECT id, eventtime FROM trig"),
        "training_history": _sql(DEV, LATEST, select=f"""
SELECT id AS device_id, rn, rn // {CHUNK} AS chunk, eventtime, value FROM latest"""),
        "history_at_triggers": _sql(DEV, *replay, select=f"""
SELECT id AS device_id, trained_at, rn, rn // {CHUNK} AS chunk, eventtime, value FROM collected"""),
        "load_chunk_counts": _sql(DEV, LATEST, select=f"SELECT * FROM {LATEST_CHUNKS}"),
        "load_batches": _sql(DEV, LATEST, select=f"SELECT id, n FROM {LATEST_CHUNKS}"),
        "load_barrier": _sql(DEV, LATEST, select=f"""
SELECT id, string_agg(n::VARCHAR, ',' ORDER BY n) AS chunk_sizes, sum(n)::BIGINT AS n_rows
FROM {LATEST_CHUNKS} GROUP BY id"""),
        "typed_training_rows": _sql(DEV, LATEST, select=f"""
SELECT id AS device_id, value, eventtime, {_stamp('eventtime')} AS collected_at, {LOADED} AS loaded_at FROM latest"""),
        "training_set": _sql(DEV, *replay, select=f"""
SELECT * FROM (SELECT id AS device_id, row_number() OVER (PARTITION BY id ORDER BY eventtime DESC) AS rn, eventtime, value
               FROM (SELECT DISTINCT id, eventtime, value FROM collected)) WHERE rn <= {HISTORY}"""),
        "collection_log": _sql(DEV, WALK.format(src="dev"), select=f"""
SELECT id, eventtime, 'Training Events Collected For: Event: (' || id || ', ' || eventtime || '), Timestamp: ' ||
       {text.format(_stamp('eventtime'))} || ', Window: [' || {text.format(_stamp('(eventtime // 15000 * 15000)'))} || ', ' ||
       {text.format(_stamp('(eventtime // 15000 * 15000 + 15000)'))} || '), Current Time ' || {text.format(LOADED)} AS line
FROM trig"""),
        "train_models": _sql(DEV, LATEST, latest_models, select="SELECT * FROM models"),
        "trained_lines": _sql(DEV, LATEST, latest_models, select="""
SELECT id, 'MODEL TRAINED: (' || id || ', ' || model || ')' AS line FROM models"""),
        "saved_lines": _sql(DEV, *replay, select="""
SELECT id, 'MODEL SAVED: (' || id || ', ' || arg_max(model, trained_at) || ')' AS line FROM versions GROUP BY id"""),
        "model_versions": _sql(DEV, *replay, select="SELECT * FROM versions"),
        "model_snapshots": _sql(DEV, *replay, select="""
SELECT id, model, trained_at, effective_from,
       lead(effective_from) OVER (PARTITION BY id ORDER BY effective_from) AS effective_until FROM visible"""),
        "model_catalog": _sql(DEV, *replay, select="""
SELECT * FROM versions QUALIFY row_number() OVER (PARTITION BY id ORDER BY trained_at DESC) = 1"""),
        "score_events": _sql(DEV, dev_models, select=f"""
SELECT e.id, e.eventtime, e.value, {_distance('e.bp')} AS distance FROM dev e LEFT JOIN models m ON m.id = e.id"""),
        "score_latest_history": _sql(DEV, LATEST, latest_models, select=f"""
SELECT e.id, e.eventtime, e.value, m.model, {_distance('e.bp')} AS distance FROM dev e LEFT JOIN models m ON m.id = e.id"""),
        "score_events_asof": _sql(DEV, *replay, select=f"""
SELECT e.id, e.eventtime, e.value, m.model, {_distance('e.bp')} AS distance
FROM dev e ASOF LEFT JOIN visible m ON e.id = m.id AND e.eventtime >= m.effective_from"""),
        "score_batches_2s": _sql(*_msg_scores(), select=f"""
SELECT {_stamp('w * 2000')} AS window_start, {_stamp('(w + 1) * 2000')} AS window_end, count(*) AS batch_rows,
       count_if(distance > 3.0::DOUBLE)::BIGINT AS anomalies, max(distance) AS greatest_distance
FROM (SELECT *, eventtime // 2000 AS w FROM scored) GROUP BY w"""),
        "anomalies": _sql(*_msg_scores(), select="SELECT * FROM scored WHERE distance > 3.0::DOUBLE"),
        "anomaly_log": anomaly_log,
        "alerts": _sql(*_msg_scores(), select=f"""
SELECT id, {_stamp('eventtime')} AS eventtime, {LOADED} AS notified_at, value, base
FROM scored WHERE distance > 3.0::DOUBLE"""),
        "merge_distance": _sql(DEV, dev_models, select=f"""
SELECT e.id AS device_id, e.eventtime,
       CASE WHEN e.event_type <> 'click' THEN e.bp::INT END AS value,
       CASE WHEN e.event_type IN ('error', 'click') THEN ({_distance('e.bp')})::FLOAT END AS distance
FROM dev e LEFT JOIN models m ON m.id = e.id"""),
        "alerts_end_to_end": _sql(MSG, *_replay("msg"), select=f"""
SELECT id, {_stamp('eventtime')} AS eventtime, {LOADED} AS notified_at, value, base FROM (
  SELECT e.id, e.eventtime, e.value, e.base, {_distance('trunc(e.value)::BIGINT')} AS distance
  FROM msg e ASOF LEFT JOIN visible m ON e.id = m.id AND e.eventtime >= m.effective_from)
WHERE distance > 3.0::DOUBLE"""),
        "window_counts_stream": _windows(
            3_600_000, "WHERE (w + 1) * 3600000 <= (SELECT max(eventtime) - 2000 FROM dev)"
        ),
        "persist_stream": _sql(MSG, select="SELECT id AS device_id, eventtime, trunc(value)::INT AS value FROM msg"),
        "counter_stream": _sql(DEV, select=f"""
SELECT id, eventtime FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY eventtime) AS rn FROM dev)
WHERE rn = {LIMIT}"""),
        "counter_restart_stream": _sql(DEV, HALVES, select=f"""
SELECT id, eventtime FROM (
  SELECT *, row_number() OVER (PARTITION BY id, early ORDER BY eventtime) AS in_half,
         row_number() OVER (PARTITION BY id ORDER BY eventtime) AS rn,
         count(*) FILTER (early) OVER (PARTITION BY id) AS n_early FROM halves)
WHERE CASE WHEN n_early >= {LIMIT} THEN in_half = {LIMIT} ELSE rn = {LIMIT} END"""),
        "late_rows_stream": _sql(DEV, HALVES, select=" UNION ALL ".join(
            _late(*stage) for stage in (("persist", 2_000, 2_000), ("training", 15_000, 30_000), ("score", 2_000, 120_000)))),
        "pane_counts_stream": _panes(3_600_000, 2 * 86_400_000),
        "training_panes_stream": _sql(DEV, select=f"""
SELECT id, eventtime, firing, eventtime // 15000 * 15000 AS window_start, 1::BIGINT AS n
FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY eventtime) AS rn FROM dev), (VALUES ('trigger'), ('pane')) f(firing)
WHERE rn = {LIMIT}"""),
        "late_events_stream": _sql(DEV, HALVES, select=" UNION ALL ".join(
            _stored_or_late(*stage) for stage in (("persist", 86_400_000), ("score", 3 * 86_400_000)))),
        "batch_counts_stream": _sql(MSG, f"""
timed AS (SELECT *, ({USABLE}) AS usable, (min(eventtime) OVER () + max(eventtime) OVER ()) // 2 AS half_time FROM raw),
steps AS (SELECT *, CASE WHEN eventtime < half_time AND event_id % 7 <> 0 THEN 0 ELSE 1 END AS step FROM timed),
mark AS (SELECT max(eventtime) AS mark FROM steps WHERE usable AND step = 0)""", select="""
SELECT 'ingest' AS query, step::BIGINT AS batch, count(*) AS messages, count_if(usable)::BIGINT AS events, count_if(NOT usable)::BIGINT AS rejects,
       (count_if(usable AND step = 1 AND (eventtime // 2000 + 1) * 2000 + 2000 <= mark)
        + count_if(usable AND step = 1 AND (eventtime // 2000 + 1) * 2000 + 120000 <= mark))::BIGINT AS late,
       max(eventtime) FILTER (usable) AS last_eventtime
FROM steps, mark GROUP BY step"""),
        "folded_tables_stream": _sql(MSG, select=f"""
SELECT 'readings' AS kind, id AS device_id, eventtime, trunc(value)::INT AS value FROM msg
UNION ALL
SELECT 'latest', id, eventtime, trunc(value)::INT FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY eventtime DESC) AS rn FROM msg) WHERE rn <= {HISTORY}"""),
        "score_stream": _sql(*_msg_scores(), select="SELECT * FROM scored WHERE distance > 3.0::DOUBLE"),
        "score_event_time_stream": _sql(MSG, *_replay("msg"), select=f"""
SELECT e.id AS device_id, e.eventtime, ({_distance('trunc(e.value)::BIGINT')})::FLOAT AS distance
FROM msg e ASOF LEFT JOIN visible m ON e.id = m.id AND e.eventtime >= m.effective_from"""),
        "score_distances_stream": _sql(*_msg_scores(), select="""
SELECT id AS device_id, eventtime, distance::FLOAT AS distance FROM scored"""),
        "ingest_stream": _sql(*_msg_scores(), select="""
SELECT id AS device_id, eventtime, trunc(value)::INT AS value, distance::FLOAT AS distance FROM scored"""),
        "anomaly_lines_stream": f"SELECT id, line FROM ({anomaly_log})",
        "train_stream": _sql(MSG, *live_training, select="SELECT * FROM models"),
        "training_rows_stream": _sql(MSG, *live_training, select=f"""
SELECT id AS device_id, eventtime, value, rn // {CHUNK} AS chunk FROM latest"""),
    }
