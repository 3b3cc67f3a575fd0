"""DuckDB SQL oracles for the registered queries.

They compute from the driver tables' columns directly (no JSON), re-stating
the adapter rules of :mod:`clickweave.plans.adapter` in SQL. Column names
equal the Spark query's.
"""

from __future__ import annotations

EV = """ev AS (
  SELECT event_id AS eid, event_type AS et, value AS val, ts,
    CAST(user_id AS VARCHAR) AS userid,
    CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
    CASE WHEN event_id % 13 = 0 THEN 'a_' || json_extract_string(props, '$.k')
         ELSE json_extract_string(props, '$.k') END AS docid,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS date,
    CASE WHEN event_id % 53 = 0 THEN NULL
         ELSE (['apple','oppo','xiaomi','oppobrowser','mibrowser','vivobrowser','other'])[event_id % 7 + 1] END AS appid,
    CASE WHEN event_type = 'view' THEN 'views' WHEN event_id % 2 = 1 THEN 'click' END AS type,
    event_type = 'view' AS has_views,
    CASE WHEN event_type = 'view' THEN CAST(event_id % 4 + 1 AS INTEGER) END AS n_views,
    (event_type <> 'view' OR event_id % 3 = 0) AS has_click,
    CASE WHEN event_type IN ('view', 'click') THEN 'clickDoc' WHEN event_type = 'purchase' THEN 'shareDoc'
         WHEN event_type = 'error' THEN 'dislike'
         ELSE (['viewComment','like','addComment','play'])[event_id % 4 + 1] END AS cevent,
    event_id % 17 <> 0 AS has_details,
    CASE WHEN event_id % 17 = 0 OR event_id % 11 = 0 THEN NULL WHEN event_id % 29 = 0 THEN 'n/a'
         ELSE printf('%.2f', value) END AS dwell,
    event_id % 19 <> 0 AS has_view,
    CASE WHEN event_id % 2 = 0 THEN 'selected' ELSE 'hot' END AS channel,
    CASE WHEN event_id % 3 = 0 THEN 'feed' ELSE 'profile' END AS mashtype,
    CAST(event_id % 10 AS VARCHAR) AS pos,
    event_id % 101 = 0 AS bad
  FROM events
)"""

PLATFORM = """CASE WHEN appid IN ('apple','oppo','xiaomi') THEN 'app_' || appid
    WHEN appid IN ('oppobrowser','mibrowser') THEN appid ELSE 'other_' || appid END"""

CODE = """CASE cevent WHEN 'clickDoc' THEN 'clk' WHEN 'viewComment' THEN 'vc' WHEN 'shareDoc' THEN 'shr'
    WHEN 'like' THEN 'lk' WHEN 'dislike' THEN 'dlk' WHEN 'addComment' THEN 'ac' ELSE 'None' END"""

BAD_DWELL = "(cevent = 'clickDoc' AND TRY_CAST(dwell AS FLOAT) IS NULL)"

# records that normalise (no quarantine reason)
NORM_OK = f"(NOT bad AND appid IS NOT NULL AND NOT (NOT has_views AND has_click AND {BAD_DWELL}))"

VIEWS = f"""vrows AS (
  SELECT userid, CAST((k + 7 * i) % 100 AS VARCHAR) AS docid, 'vw' AS event,
         strftime(ts - to_minutes(CAST(i AS BIGINT)), '%Y-%m-%d %H:%M:%S') AS date, platform, i
  FROM (SELECT *, {PLATFORM} AS platform, unnest(range(n_views)) AS i FROM ev WHERE {NORM_OK} AND has_views)
)"""

CLICKS = f"""crows AS (
  SELECT userid, docid, {CODE} AS event, date, {PLATFORM} AS platform, cevent, dwell
  FROM ev WHERE {NORM_OK} AND NOT has_views AND has_click
)"""

NORM = f"""{VIEWS}, {CLICKS},
norm AS (SELECT userid, docid, event, date, platform FROM vrows
         UNION ALL SELECT userid, docid, event, date, platform FROM crows)"""

WEIGHTED = """wev AS (
  SELECT userid, docid, event,
         CAST(epoch(strptime(date, '%Y-%m-%d %H:%M:%S')) AS BIGINT) AS t,
         CASE event WHEN 'vw' THEN 0 WHEN 'clk' THEN 1 WHEN 'ac' THEN 2 WHEN 'shr' THEN 3 WHEN 'lk' THEN 3
                    WHEN 'dlk' THEN 4 END AS weight
  FROM norm WHERE event IN ('vw','clk','ac','shr','lk','dlk')
    AND epoch(strptime(date, '%Y-%m-%d %H:%M:%S')) >= epoch(TIMESTAMP '2017-09-29 00:00:00')
)"""

USTATS = """ustats AS (
  SELECT userid, max(t) AS t_max, min(t) AS t_min,
         count(*) FILTER (WHERE weight BETWEEN 1 AND 3) AS n_strong, count(*) AS n_events
  FROM wev GROUP BY userid
)"""

ASOF = "CAST(epoch(TIMESTAMP '2024-01-31 00:00:00') AS BIGINT)"

QUAL = f"""qual AS (
  SELECT * FROM ustats
  WHERE n_strong >= 10 AND t_max >= {ASOF} - 30 * 86400 AND t_min <= {ASOF} - 5 * 86400
    AND n_strong * 2 <= n_events AND t_max - t_min >= 3 * 86400 AND n_events <= 20000
)"""

LABELS = """labels_ AS (
  SELECT userid, docid, w,
         max(t) FILTER (WHERE weight = w) AS tm, tl,
         max(weight) FILTER (WHERE t = tl) AS wl
  FROM (SELECT wev.*, max(weight) OVER (PARTITION BY userid, docid) AS w,
               max(t) OVER (PARTITION BY userid, docid) AS tl
        FROM wev WHERE userid IN (SELECT userid FROM qual))
  GROUP BY userid, docid, w, tl
)"""

POOL = """pool AS (
  SELECT userid, docid, cls, blank, time,
         row_number() OVER (PARTITION BY userid ORDER BY cls, time DESC, docid) AS raw_pos,
         CASE WHEN NOT blank THEN CAST(sum(CASE WHEN blank THEN 0 ELSE 1 END) OVER (
              PARTITION BY userid ORDER BY cls, time DESC, docid ROWS UNBOUNDED PRECEDING) AS BIGINT) END AS n,
         count(*) OVER (PARTITION BY userid) AS size
  FROM (SELECT userid, docid, 0 AS cls, false AS blank, tm AS time FROM labels_ WHERE w = 4
        UNION ALL
        SELECT userid, docid, 1 AS cls, w > 0 AS blank, tl AS time FROM labels_ WHERE wl = 0)
)"""

POS = """pos_ AS (
  SELECT userid, docid, row_number() OVER (PARTITION BY userid ORDER BY tm DESC, docid) AS r
  FROM labels_ WHERE w BETWEEN 1 AND 3
)"""

GROUPS = """grp AS (
  SELECT userid, CAST((n + 2) // 3 AS BIGINT) AS g,
         max(docid) FILTER (WHERE (n - 1) % 3 = 0) AS neg1,
         max(docid) FILTER (WHERE (n - 1) % 3 = 1) AS neg2,
         max(docid) FILTER (WHERE (n - 1) % 3 = 2) AS neg3,
         max(raw_pos) FILTER (WHERE (n - 1) % 3 = 2) AS g_end
  FROM pool WHERE n IS NOT NULL GROUP BY userid, (n + 2) // 3
),
psize AS (SELECT userid, max(size) AS size FROM pool GROUP BY userid)"""

TRAIN = f"""train AS (
  SELECT p.userid, p.docid AS pos, g.neg1, g.neg2, g.neg3,
         CAST((g.neg1 IS NOT NULL)::INT + (g.neg2 IS NOT NULL)::INT + (g.neg3 IS NOT NULL)::INT AS INTEGER) AS n_negs,
         CAST(p.r AS INTEGER) AS r
  FROM pos_ p
  JOIN psize s ON s.userid = p.userid
  LEFT JOIN grp g ON g.userid = p.userid AND g.g = p.r
  LEFT JOIN grp prev ON prev.userid = p.userid AND prev.g = p.r - 1
  WHERE p.r <= 250 AND s.size - (CASE WHEN p.r = 1 THEN 0 ELSE prev.g_end END) >= 3
)"""

TRAIN_ALL = f"WITH {EV}, {NORM}, {WEIGHTED}, {USTATS}, {QUAL}, {LABELS}, {POOL}, {POS}, {GROUPS}, {TRAIN}"

CLICKS_H = """hclicks AS (
  SELECT userid, docid, date FROM ev
  WHERE NOT bad AND has_click AND cevent = 'clickDoc' AND has_details
)"""

HIST_USERS = """husers AS (SELECT userid, count(*) AS n_clicks FROM hclicks GROUP BY userid HAVING count(*) >= 10)"""

NORM_ALL = f"WITH {EV}, {NORM}"

DOCS = """docs AS (
  SELECT doc_id, CASE WHEN doc_id % 23 <> 0 THEN CAST(doc_id AS VARCHAR) END AS _id,
         CASE WHEN doc_id % 7 = 0 THEN 'news' WHEN doc_id % 5 = 0 THEN 'video' ELSE 'news' END AS ctype,
         text
  FROM documents
)"""

REPLIES = """replies AS (
  SELECT CAST(doc_id AS VARCHAR) AS _id, '[["quality"],["toxic"]]' AS htc_key,
         CAST(to_json([[CAST(quality AS DOUBLE)], [CAST(toxic AS DOUBLE)]]) AS VARCHAR) AS htc_value
  FROM labels
)"""

LAST_REPLIES = """last_replies AS (
  SELECT CAST(doc_id AS VARCHAR) AS _id, '[["quality"],["toxic"]]' AS htc_key,
         CAST(to_json([[CAST(quality + x AS DOUBLE)], [CAST(toxic + x AS DOUBLE)]]) AS VARCHAR) AS htc_value
  FROM (SELECT *, CASE WHEN doc_id % 3 = 0 THEN 10 ELSE 0 END AS x FROM labels)
)"""

SCORED = """scored AS (
  SELECT d._id, d.ctype, d.text, o.lang, CASE WHEN d.doc_id % 100 = 77 THEN 'error' WHEN d.doc_id % 4 = 1 THEN 'skipped'
         ELSE 'ok' END AS status
  FROM docs d JOIN documents o ON o.doc_id = d.doc_id WHERE d._id IS NOT NULL AND d.ctype <> 'video'
)"""

PARSED_VIEW = """SELECT CASE WHEN bad THEN NULL ELSE userid END AS userid,
       CASE WHEN bad THEN NULL ELSE appid END AS appid,
       CASE WHEN bad THEN NULL ELSE type END AS type FROM ev"""


def _hour_between(lo: str, hi: str) -> str:
    return f"strftime(ts, '%Y-%m-%d-%H') BETWEEN '{lo}' AND '{hi}'"


ORACLES: dict[str, str] = {
    "parse_raw": f"""WITH {EV}
SELECT userid, appid, type, n_views,
       CASE WHEN has_click THEN cevent END AS click_event,
       CASE WHEN has_click THEN docid END AS click_docid,
       CASE WHEN has_click THEN dwell END AS dwell,
       CASE WHEN has_view THEN channel END AS channel,
       CASE WHEN has_view THEN mashtype END AS mashtype,
       CASE WHEN has_view THEN pos END AS pos
FROM ev WHERE NOT bad""",
    "platform_classify": f"""WITH {EV}
SELECT userid, appid, {PLATFORM} AS platform FROM ev WHERE NOT bad AND appid IS NOT NULL""",
    "view_events": f"""{NORM_ALL} SELECT userid, docid, event, date, platform FROM vrows""",
    "view_events_alternate": f"""{NORM_ALL}
SELECT userid, docid, event, date, platform FROM vrows WHERE i % 2 = 1""",
    "click_events": f"""{NORM_ALL} SELECT userid, docid, event, date, platform FROM crows""",
    "click_events_min_dwell": f"""{NORM_ALL}
SELECT userid, docid, event, date, platform FROM crows
WHERE NOT (event = 'clk' AND TRY_CAST(dwell AS FLOAT) > 0 AND TRY_CAST(dwell AS FLOAT) < 8)
  AND strpos(docid, '_') = 0""",
    "normalise_events": f"""{NORM_ALL} SELECT userid, docid, event, date, platform FROM norm""",
    "quarantine_events": f"""WITH {EV}
SELECT reason, count(*) AS n FROM (
  SELECT CASE WHEN bad THEN 'bad_json' WHEN appid IS NULL THEN 'missing_appid'
              WHEN NOT has_views AND has_click AND {BAD_DWELL} THEN 'bad_dwell' END AS reason
  FROM ev) WHERE reason IS NOT NULL GROUP BY reason""",
    "click_extract": f"""WITH {EV}
SELECT userid, docid,
       CASE WHEN cevent IN ('clickDoc', 'play') THEN cevent || ':' || dwell ELSE cevent END AS event, pos
FROM ev
WHERE NOT bad AND appid = 'oppobrowser' AND type IS DISTINCT FROM 'views' AND has_click
  AND (cevent NOT IN ('clickDoc', 'play') OR dwell IS NOT NULL)
  AND has_view AND channel = 'selected' AND mashtype = 'profile'""",
    "app_log_extract": f"""WITH {EV}
SELECT userid, appid, type, n_views, CASE WHEN has_click THEN cevent END AS click_event
FROM ev WHERE NOT bad AND appid = 'vivobrowser'""",
    "active_users": f"""WITH {EV}, {CLICKS_H}, {HIST_USERS} SELECT userid, n_clicks FROM husers""",
    "active_user_clicks": f"""WITH {EV}, {CLICKS_H}, {HIST_USERS}
SELECT userid, docid, date FROM hclicks WHERE userid IN (SELECT userid FROM husers)""",
    "user_history": f"""WITH {EV}, {CLICKS_H}, {HIST_USERS},
per_doc AS (SELECT userid, docid, max(date) AS date FROM hclicks
            WHERE userid IN (SELECT userid FROM husers) GROUP BY userid, docid),
ranked AS (SELECT *, row_number() OVER (PARTITION BY userid ORDER BY date DESC, docid) AS rk FROM per_doc)
SELECT userid, string_agg(docid || ' ' || date, ' ' ORDER BY rk) AS items, CAST(count(*) AS INTEGER) AS n_items
FROM ranked WHERE rk <= 20 GROUP BY userid""",
    "event_weights": f"""{NORM_ALL}, {WEIGHTED} SELECT userid, docid, event, t, weight FROM wev""",
    "user_stats": f"""{NORM_ALL}, {WEIGHTED}, {USTATS} SELECT * FROM ustats""",
    "qualified_users": f"""{NORM_ALL}, {WEIGHTED}, {USTATS}, {QUAL} SELECT * FROM qual""",
    "doc_labels": f"""{NORM_ALL}, {WEIGHTED}, {USTATS}, {QUAL}, {LABELS}
SELECT userid, docid, w, tm, tl, wl FROM labels_""",
    "negative_pool": f"""{NORM_ALL}, {WEIGHTED}, {USTATS}, {QUAL}, {LABELS}, {POOL}
SELECT userid, raw_pos, docid, cls, blank, n, size FROM pool""",
    "train_rows": f"""{TRAIN_ALL} SELECT * FROM train""",
    "scan_raw_log": f"""WITH {EV} {PARSED_VIEW}""",
    "hour_range_scan": f"""WITH {EV} {PARSED_VIEW} WHERE {_hour_between('2024-01-03-22', '2024-01-06-01')}""",
    "union_logs": f"""WITH {EV}
{PARSED_VIEW} WHERE {_hour_between('2024-01-02-00', '2024-01-04-23')}
UNION ALL
{PARSED_VIEW} WHERE {_hour_between('2024-01-04-00', '2024-01-05-12')}""",
    "doc_scan_days": f"""WITH {DOCS} SELECT _id, ctype, CAST(length(text) AS INTEGER) AS n_chars FROM docs""",
    "sink_tsv": f"""{NORM_ALL} SELECT userid, docid, event, date, platform, 'r1' AS run FROM norm""",
    "compact_files": f"""{NORM_ALL} SELECT userid, docid, event, date, platform FROM norm""",
    "doc_filter": f"""WITH {DOCS} SELECT _id, ctype FROM docs WHERE _id IS NOT NULL AND ctype <> 'video'""",
    "doc_enrich": f"""WITH {DOCS}, {REPLIES}
SELECT d._id, d.ctype, coalesce(r.htc_key, '[[],[]]') AS htc_key, coalesce(r.htc_value, '[[],[]]') AS htc_value,
       CASE WHEN r._id IS NULL THEN 'default' ELSE 'ok' END AS status
FROM docs d LEFT JOIN replies r ON r._id = d._id WHERE d._id IS NOT NULL AND d.ctype <> 'video'""",
    "features_update_matched": f"""WITH {DOCS}, {LAST_REPLIES}
SELECT d._id, d.ctype, coalesce(r.htc_key, '[["old"],[]]') AS htc_key,
       coalesce(r.htc_value, '[[' || CAST(CAST(d._id AS DOUBLE) AS VARCHAR) || '],[]]') AS htc_value, r._id IS NOT NULL AS updated
FROM docs d LEFT JOIN last_replies r ON r._id = d._id WHERE d._id IS NOT NULL""",
    "features_insert_new": f"""WITH {DOCS}, {LAST_REPLIES}
SELECT _id, '[["old"],[]]' AS htc_key, '[[' || CAST(CAST(_id AS DOUBLE) AS VARCHAR) || '],[]]' AS htc_value
FROM last_replies WHERE CAST(_id AS BIGINT) % 2 = 0
UNION ALL
SELECT d._id, r.htc_key, r.htc_value FROM docs d JOIN last_replies r ON r._id = d._id
WHERE d.ctype <> 'video' AND d.doc_id % 2 = 1""",
    "doc_score": f"""WITH {DOCS}, {SCORED}
SELECT _id, ctype, CASE WHEN status = 'ok' THEN '[["chars"],["' || lang || '"]]' ELSE '[[],[]]' END AS htc_key,
       CASE WHEN status = 'ok' THEN '[[' || CAST(CAST(length(text) AS DOUBLE) AS VARCHAR) || '],[' ||
            CAST(length(text) / 2 AS VARCHAR) || ']]' ELSE '[[],[]]' END AS htc_value, status FROM scored""",
    "doc_score_counts": f"""WITH {DOCS}, {SCORED} SELECT status, count(*) AS n FROM scored GROUP BY status""",
    "events_tsv_rejects": f"""{NORM_ALL}
SELECT reason, count(*) AS n FROM (
  SELECT CASE WHEN event NOT IN ('vw','clk','ac','shr','lk','dlk') THEN 'no_weight'
              WHEN strptime(date, '%Y-%m-%d %H:%M:%S') < TIMESTAMP '2024-01-10 12:00:00' THEN 'too_early' END AS reason
  FROM norm) WHERE reason IS NOT NULL GROUP BY reason""",
    "fn_string": f"""{NORM_ALL}
SELECT userid, docid, substr(date, 1, 10) AS day, substr(date, 12, 2) AS hour,
       split_part(substr(date, 1, 10), '-', 1) AS year, strpos(docid, '_') > 0 AS is_compound,
       userid || chr(9) || docid || chr(9) || event AS line,
       CAST(octet_length(encode(userid || chr(9) || docid || chr(9) || event)) AS INTEGER) AS line_bytes,
       trim(docid) AS trimmed
FROM norm""",
    "fn_time": f"""{NORM_ALL}
SELECT userid, date,
       CAST(epoch(strptime(date, '%Y-%m-%d %H:%M:%S')) AS BIGINT) AS t_utc,
       CAST(epoch(strptime(date, '%Y-%m-%d %H:%M:%S')) AS BIGINT) - 28800 AS t_cn,
       strftime(strptime(date, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d-%H') AS hour_key,
       strftime(strptime(date, '%Y-%m-%d %H:%M:%S') + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS next_hour,
       strftime(CAST(strptime(date, '%Y-%m-%d %H:%M:%S') AS DATE) + 1, '%Y-%m-%d') AS next_day,
       CAST(day(last_day(strptime(date, '%Y-%m-%d %H:%M:%S'))) AS INTEGER) AS days_in_month
FROM norm""",
    "fn_cast": f"""WITH {EV}
SELECT userid, CASE WHEN has_details THEN dwell END AS dwell,
       CAST(round(TRY_CAST(dwell AS FLOAT) * 100) AS BIGINT) AS dwell_x100,
       TRY_CAST(substr(date, 12, 2) AS INTEGER) AS hour,
       CASE WHEN has_view THEN CAST(pos AS INTEGER) END AS pos,
       CAST(userid AS BIGINT) AS user_num
FROM ev WHERE NOT bad AND has_click""",
}

ORACLES["quarantine_rows"] = """
SELECT event_id, reason FROM (
  SELECT event_id, (['', 'bad_view', 'bad_shape', 'bad_shape', 'bad_shape', 'missing_userid', 'missing_appid', 'missing_docid',
                     'bad_dwell', 'odd_views', 'bad_json', ''])[event_id % 12 + 1] AS reason FROM events) WHERE reason <> ''"""
ORACLES["odd_events"] = """
WITH docs AS (
  SELECT event_id, event_id % 12 AS k, unnest(CASE event_id % 12 WHEN 0 THEN ['a', 'b'] WHEN 1 THEN ['a'] WHEN 9 THEN ['a', 'b', 'c']
    WHEN 11 THEN ['d'] ELSE [] END) AS d FROM events)
SELECT 'u' AS userid, d || event_id AS docid, CASE WHEN k = 11 THEN 'lk' ELSE 'vw' END AS event, 't' AS date, 'app_oppo' AS platform
FROM docs"""

# tight thresholds, under which every rule rejects some users and both limits cut rows
ORACLES["user_rules"] = f"""{NORM_ALL}, {WEIGHTED}, {USTATS}
SELECT *, n_strong >= 12 AS enough_strong, t_max >= {ASOF} - 2 * 86400 AS recent, t_min <= {ASOF} - 28 * 86400 AS settled,
       n_strong * 2 <= n_events AS mostly_weak, t_max - t_min >= 27 * 86400 AS long_enough, n_events <= 80 AS under_cap
FROM ustats"""
TRAIN_CAPPED = TRAIN_ALL.replace("n_events <= 20000", "n_events <= 80")
ORACLES["train_rows_limited"] = f"{TRAIN_CAPPED} SELECT * FROM train WHERE r <= 3"
ORACLES["train_removed"] = f"""{TRAIN_CAPPED.replace("p.r <= 250 AND ", "")},
broken AS (
  SELECT count(*) FILTER (WHERE n_strong < 10) AS a, count(*) FILTER (WHERE t_max < {ASOF} - 30 * 86400) AS b,
         count(*) FILTER (WHERE t_min > {ASOF} - 5 * 86400) AS c, count(*) FILTER (WHERE n_strong * 2 > n_events) AS d,
         count(*) FILTER (WHERE t_max - t_min < 3 * 86400) AS e, count(*) FILTER (WHERE n_events > 80) AS f FROM ustats)
SELECT unnest(['enough_strong', 'recent', 'settled', 'mostly_weak', 'long_enough', 'under_cap']) AS rule,
       unnest([a, b, c, d, e, f]) AS n FROM broken
UNION ALL SELECT 'max_rows', count(*) FROM train WHERE r > 3"""
ORACLES["event_weights_floor"] = ORACLES["event_weights"].replace("2017-09-29 00:00:00", "2024-01-10 12:00:00")

# same rows as their base query
ORACLES["click_extract_sorted"] = ORACLES["click_extract"]
ORACLES["train_rows_shuffled"] = ORACLES["train_rows"]
ORACLES["scan_events_tsv"] = ORACLES["event_weights"]

# every third document stands again on a later day, with a longer or an empty text
ORACLES["features_update_days"] = f"""WITH {DOCS}, {SCORED},
sized AS (
  SELECT s._id, prefer, CASE WHEN prefer = 'newest' AND CAST(s._id AS BIGINT) % 3 = 0
      THEN CASE WHEN CAST(s._id AS BIGINT) % 2 = 0 THEN length(s.text || ' again') ELSE 0 END ELSE length(s.text) END AS n
  FROM scored s, (SELECT unnest(['newest', 'oldest']) AS prefer) WHERE s.status = 'ok')
SELECT d._id, d.ctype, p.prefer, n IS NOT NULL AS updated,
       CASE WHEN n IS NULL THEN '[["old"],[]]' ELSE '[["chars"],["' || o.lang || '"]]' END AS htc_key,
       CASE WHEN n IS NULL THEN '[[' || CAST(CAST(d._id AS DOUBLE) AS VARCHAR) || '],[]]'
            ELSE '[[' || CAST(CAST(n AS DOUBLE) AS VARCHAR) || '],[' || CAST(n / 2 AS VARCHAR) || ']]' END AS htc_value
FROM docs d JOIN documents o ON o.doc_id = d.doc_id CROSS JOIN (SELECT unnest(['newest', 'oldest']) AS prefer) p
LEFT JOIN sized z ON z._id = d._id AND z.prefer = p.prefer
WHERE d._id IS NOT NULL"""
ORACLES["doc_score_stalls"] = ORACLES["doc_score"]
ORACLES["doc_score_batches"] = f"""WITH {DOCS}, {SCORED}
SELECT count(*) AS n, least(count(*), 10) AS largest_batch FROM scored"""

# a third of all events are user 0's, on documents of their own
EV_HOT = EV.replace("FROM events", """FROM (SELECT * REPLACE (
    CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS user_id,
    CASE WHEN event_id % 3 = 0 THEN '{"k": ' || event_id || '}' ELSE props END AS props) FROM events)""")
ORACLES["train_rows_uncapped"] = (
    TRAIN_ALL.replace(EV, EV_HOT).replace(" AND n_events <= 20000", "").replace("p.r <= 250 AND ", "") + " SELECT * FROM train"
)
ORACLES["click_extract_ranged"] = f"""WITH clicks AS ({ORACLES["click_extract"].replace(EV, EV_HOT)})
SELECT *, row_number() OVER (ORDER BY userid, pos, docid, event) AS place FROM clicks"""
ORACLES["train_rows_permuted"] = f"""{TRAIN_ALL},
keyed AS (SELECT *, md5('7:' || to_json({{'userid': userid, 'pos': pos, 'neg1': neg1, 'neg2': neg2, 'neg3': neg3, 'n_negs': n_negs, 'r': r}})) AS key FROM train),
dealt AS (SELECT *, CAST(CAST('0x' || substr(key, 1, 8) AS BIGINT) % 10 AS INTEGER) AS partition FROM keyed)
SELECT * EXCLUDE (key), row_number() OVER (PARTITION BY layout, partition ORDER BY key) - 1 AS position
FROM dealt CROSS JOIN (SELECT unnest(['given', 'dealt']) AS layout)"""
ORACLES["compact_by_size"] = f"""{NORM_ALL} SELECT userid, docid, event, date, platform, true AS fits FROM norm"""
ORACLES["key_states"] = """WITH r AS (
  SELECT event_id, event_id % 31 = 0 AS bad, (['absent', 'null', 'value', 'value'])[event_id % 4 + 1] AS views,
         (event_id // 4) % 5 AS c FROM events),
s AS (
  SELECT event_id, CASE WHEN NOT bad THEN views END AS views,
         CASE WHEN NOT bad THEN (['absent', 'null', 'value', 'value', 'value'])[c + 1] END AS click,
         CASE WHEN NOT bad THEN (['absent', 'absent', 'null', 'value', 'absent'])[c + 1] END AS click_docid,
         CASE WHEN NOT bad THEN (['absent', 'absent', 'value', 'null', 'absent'])[c + 1] END AS click_event FROM r)
SELECT *, coalesce(views = 'value', false) AS views_absent, coalesce(views <> 'absent', false) AS views_present,
       coalesce(click_docid = 'value', false) AS click_docid_absent, coalesce(click_docid <> 'absent', false) AS click_docid_present FROM s"""
# day 0 of the next month is the last day of this one
LENIENT = """l AS (
  SELECT event_id, event_id % 8 AS form, CASE WHEN event_id % 8 = 3
      THEN last_day(ts)::TIMESTAMP + (date_trunc('second', ts) - date_trunc('day', ts)) ELSE date_trunc('second', ts) END AS w FROM events)"""
ORACLES["events_tsv_lenient"] = f"""WITH {LENIENT}
SELECT event_id, CAST(epoch(w) AS BIGINT) AS t FROM l WHERE form < 6 AND w >= TIMESTAMP '2024-01-10 12:00:00'"""
ORACLES["events_tsv_odd"] = f"""WITH {LENIENT}, x AS (
  SELECT lenient, CASE WHEN form = 7 THEN 'too_short' WHEN form = 6 OR (form > 0 AND NOT lenient AND NOT (form = 1 AND padded)) THEN 'bad_date'
      WHEN w < TIMESTAMP '2024-01-10 12:00:00' THEN 'too_early' END AS reason
  FROM (SELECT *, strftime(w, '%Y-%m-%d %H:%M:%S') = strftime(w, '%Y-%-m-%-d %-H:%-M:%-S') AS padded FROM l)
  CROSS JOIN (SELECT unnest([false, true]) AS lenient))
SELECT lenient, reason, count(*) AS n FROM x WHERE reason IS NOT NULL GROUP BY ALL"""
ORACLES["features_update_buckets"] = f"""WITH {DOCS}, {LAST_REPLIES},
b AS (SELECT *, CAST('0x' || substr(md5(_id), 1, 8) AS BIGINT) % 64 AS bucket FROM docs WHERE _id IS NOT NULL),
hit AS (SELECT DISTINCT bucket FROM b JOIN last_replies USING (_id) WHERE bucket < 8)
SELECT b._id, b.ctype, b.bucket, b.bucket IN (SELECT bucket FROM hit) AS rewritten,
       CASE WHEN r._id IS NULL THEN '[["old"],[]]' ELSE r.htc_key END AS htc_key,
       CASE WHEN r._id IS NULL THEN '[[' || CAST(CAST(b._id AS DOUBLE) AS VARCHAR) || '],[]]' ELSE r.htc_value END AS htc_value
FROM b LEFT JOIN last_replies r ON r._id = b._id AND b.bucket < 8"""
ORACLES["scan_gz_only"] = "SELECT true AS gz_is_the_rest, count(*) AS n_lines, true AS fewer FROM events"
ORACLES["sink_overwrite"] = f"""{NORM_ALL}
SELECT userid, event, count(*) AS n, CAST(1 AS BIGINT) AS n_files FROM norm WHERE event = 'clk' GROUP BY ALL"""
ORACLES["app_log_partitions"] = f"""WITH {EV}
SELECT CAST(7 AS BIGINT) AS n_partitions, count(*) AS n, true AS even FROM ev WHERE NOT bad AND appid = 'vivobrowser'"""
ORACLES["click_reducers"] = f"""WITH clicks AS ({ORACLES["click_extract"]})
SELECT userid, count(*) AS n, CAST(1 AS BIGINT) AS n_reducers, true AS in_order FROM clicks GROUP BY userid"""
ORACLES["user_rules_now"] = f"""{NORM_ALL}, {WEIGHTED}, {USTATS}
SELECT userid, t_max >= epoch(now()) - 30 * 86400 AS recent, t_min <= epoch(now()) - 5 * 86400 AS settled, n_strong >= 10 AS enough_strong
FROM ustats"""
