"""The registered queries in SQL, written apart from the DataFrame code."""

from __future__ import annotations

_VIEWS = {
    "ratings_raw": """
        SELECT 'U' || o_custkey AS user_id, 'P' || l_partkey AS parent_asin,
               CASE WHEN l_quantity = 50 THEN NULL ELSE l_quantity % 7 END AS rating,
               epoch_ms(l_shipdate) AS "timestamp", l_orderkey, l_linenumber
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "projected": """
        SELECT user_id, parent_asin AS item_id, CAST(rating AS FLOAT) AS rating, "timestamp"
        FROM ratings_raw""",
    "complete": """
        SELECT * FROM projected
        WHERE user_id IS NOT NULL AND item_id IS NOT NULL AND rating IS NOT NULL AND "timestamp" IS NOT NULL""",
    "cleaned": """
        SELECT user_id, item_id, rating, "timestamp" FROM (
            SELECT *, row_number() OVER (
                PARTITION BY user_id, item_id ORDER BY "timestamp" DESC, rating DESC) AS place
            FROM complete WHERE rating >= 1 AND rating <= 5)
        WHERE place = 1""",
    "ratings": """
        SELECT *, CAST(substr(user_id, 2) AS INT) AS user_idx, CAST(substr(item_id, 2) AS INT) AS item_idx
        FROM cleaned""",
    "labels_by_segment": """
        SELECT * FROM (VALUES (0, 'Enthusiast'), (1, 'Critic'), (2, 'Casual'), (3, 'Explorer'), (4, 'Hardcore'))
            AS t(segment, segment_label)""",
    "segments": """
        SELECT user_idx, segment, segment_label
        FROM (SELECT DISTINCT CAST(o_custkey AS INT) AS user_idx, CAST(o_custkey % 5 AS INT) AS segment FROM orders)
        JOIN labels_by_segment USING (segment)""",
    "partial_segments": """
        SELECT user_idx, segment, segment_label
        FROM (SELECT CAST(c_custkey AS INT) AS user_idx, CAST(c_custkey % 5 AS INT) AS segment
              FROM customer WHERE c_acctbal >= 0)
        JOIN labels_by_segment USING (segment)""",
    "segment_stats": """
        SELECT segment, item_idx, avg(CAST(rating AS DOUBLE)) AS avg_rating, count(*) AS n_ratings
        FROM ratings JOIN segments USING (user_idx)
        GROUP BY segment, item_idx HAVING count(*) >= 10""",
    "segment_top": """
        SELECT * FROM (
            SELECT *, row_number() OVER (
                PARTITION BY segment ORDER BY avg_rating DESC, n_ratings DESC, item_idx) AS rank
            FROM segment_stats)
        WHERE rank <= 5""",
    "titles": """
        SELECT item_idx, coalesce(title, item_id) AS title FROM (
            SELECT 'P' || p_partkey AS item_id, CAST(p_partkey AS INT) AS item_idx,
                   CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE p_name || ' ' || p_type || ' ' || p_brand END AS title
            FROM part)""",
    "raw_events": """
        SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""",
    "rated_events": """
        SELECT event_id, event_type, ts, k AS item_id,
               CASE WHEN event_type = 'signup' THEN -1 ELSE user_id END AS user_id,
               CAST(CASE WHEN event_id % 13 = 0 THEN 0.5
                         WHEN k % 10 = 7 THEN 4.6 + 0.1 * (event_id % 4)
                         ELSE 1.0 + 0.5 * (event_id % 9) END AS DECIMAL(4,1)) AS rating,
               ts + to_seconds(CAST(event_id % 7 AS INT)) AS kafka_ts
        FROM raw_events""",
    "messages": """
        SELECT CASE WHEN event_type <> 'error' THEN
                        '{"user_id":' || user_id || ',"item_id":' || item_id || ',"rating":' || rating
                        || ',"timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '"}'
                    WHEN event_id % 3 = 0 THEN '{bad'
                    WHEN event_id % 3 = 1 THEN '[1]'
                    ELSE '{"user_id":"CORRUPTED","item_id":null,"rating":"N/A","timestamp":"bad-ts"}'
               END AS value, kafka_ts, event_id, event_type, rating
        FROM rated_events""",
    "parsed": """
        SELECT value AS raw, kafka_ts,
               CASE WHEN json_valid(value) THEN json_extract_string(value, '$.user_id') END AS user_id,
               CASE WHEN json_valid(value) THEN json_extract_string(value, '$.item_id') END AS item_id,
               CASE WHEN json_valid(value) THEN json_extract_string(value, '$.rating') END AS rating,
               CASE WHEN json_valid(value) THEN json_extract_string(value, '$.timestamp') END AS "timestamp"
        FROM messages""",
    "validated": """
        SELECT raw, TRY_CAST(user_id AS BIGINT) AS user_id, TRY_CAST(item_id AS BIGINT) AS item_id,
               TRY_CAST(rating AS DOUBLE) AS rating, TRY_CAST("timestamp" AS TIMESTAMP) AS event_time, kafka_ts,
               CASE WHEN NOT json_valid(raw) OR json_type(raw) <> 'OBJECT' THEN 'unparseable_json'
                    WHEN user_id IS NULL OR item_id IS NULL OR rating IS NULL OR "timestamp" IS NULL
                        THEN 'missing_field'
                    WHEN TRY_CAST(user_id AS BIGINT) IS NULL OR TRY_CAST(item_id AS BIGINT) IS NULL THEN 'bad_id'
                    WHEN TRY_CAST(rating AS DOUBLE) IS NULL THEN 'bad_rating'
                    WHEN TRY_CAST(rating AS DOUBLE) NOT BETWEEN 1 AND 5 THEN 'rating_out_of_range'
                    WHEN TRY_CAST("timestamp" AS TIMESTAMP) IS NULL THEN 'bad_timestamp'
               END AS reject_reason
        FROM parsed""",
    "clean": """
        SELECT user_id, item_id, CAST(rating AS DOUBLE) AS rating, ts AS event_time, kafka_ts
        FROM rated_events WHERE event_type <> 'error' AND rating BETWEEN 1 AND 5""",
    "items_live": """
        SELECT item_id, avg(rating) AS avg_rating, count(*) AS interaction_count,
               round(count(*) * avg(rating) / 30.0, 4) AS engagement_score
        FROM clean GROUP BY item_id""",
    "item_windows": """
        SELECT w AS window_start, w + INTERVAL 24 HOURS AS window_end, item_id,
               avg(rating) AS avg_rating, count(*) AS interaction_count,
               round(count(*) * avg(rating) / 86400.0, 4) AS engagement_score
        FROM (SELECT *, time_bucket(INTERVAL 8 HOURS, event_time, TIMESTAMP '1970-01-01') - i * INTERVAL 8 HOURS AS w
              FROM clean, range(3) AS t(i))
        GROUP BY w, item_id""",
    "user_windows": """
        SELECT w AS window_start, w + INTERVAL 9 DAYS AS window_end, user_id, count(*) AS interaction_count
        FROM (SELECT *, time_bucket(INTERVAL 3 DAYS, event_time, TIMESTAMP '1970-01-01') - i * INTERVAL 3 DAYS AS w
              FROM clean, range(3) AS t(i))
        GROUP BY w, user_id""",
    "alerts": """
        SELECT 'TRENDING' AS alert_type, -1 AS user_id, item_id,
               'Trending Item #' || item_id || ' (Score: '
               || CAST(CAST(engagement_score AS DECIMAL(38,4)) AS DECIMAL(38,2)) || ')' AS message,
               window_end AS "timestamp"
        FROM item_windows WHERE avg_rating > 4.5 AND interaction_count > 3
        UNION ALL
        SELECT 'ACTIVITY_SPIKE', user_id, -1, 'Sudden activity spike from User #' || user_id, window_end
        FROM user_windows WHERE interaction_count > 10""",
    "factors": """
        SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS features FROM embeddings""",
    "router_users": """
        SELECT DISTINCT user_id FROM (
            SELECT c_custkey AS user_id FROM customer
            UNION ALL SELECT user_id FROM rated_events WHERE event_type <> 'error')""",
    "best_by_factors": """
        SELECT * FROM (
            SELECT u.id AS user_id, i.id AS item_id, list_dot_product(u.features, i.features) AS score,
                   row_number() OVER (PARTITION BY u.id
                       ORDER BY list_dot_product(u.features, i.features) DESC, i.id) AS rank
            FROM factors u CROSS JOIN factors i)
        WHERE rank <= 5""",
    "tagged": """
        SELECT r.user_id, s.segment,
               CASE WHEN r.user_id = -1 THEN 'cold_start_global'
                    WHEN f.id IS NOT NULL THEN 'als_segment_' || coalesce(s.segment_label, 'Unknown')
                    WHEN s.segment IS NOT NULL THEN 'segment_fallback_' || s.segment
                    ELSE 'default_fallback' END AS path
        FROM router_users r LEFT JOIN factors f ON f.id = r.user_id
        LEFT JOIN partial_segments s ON s.user_idx = r.user_id""",
    "trending_items": """
        SELECT item_id, engagement_score AS score,
               row_number() OVER (ORDER BY engagement_score DESC, item_id) AS rank
        FROM item_windows
        WHERE window_end = (SELECT max(window_end) FROM item_windows )
        QUALIFY rank <= 5""",
    "served": """
        SELECT t.user_id, t.path, l.rank, l.item_id, l.score
        FROM tagged t LEFT JOIN (
            SELECT user_id, rank, item_id, score FROM best_by_factors
            WHERE user_id IN (SELECT user_id FROM tagged WHERE path LIKE 'als%')
            UNION ALL SELECT -1, rank, item_id, score FROM trending_items
            UNION ALL SELECT user_id, rank, item_idx, avg_rating
            FROM tagged JOIN segment_top ON segment_top.segment = tagged.segment AND path LIKE 'segment%'
            UNION ALL SELECT user_id, rank, item_idx, avg_rating
            FROM tagged JOIN segment_top ON segment_top.segment = 0 AND path LIKE 'default%'
        ) l ON l.user_id = t.user_id""",
}


def _needs(text: str, known: list[str]) -> set[str]:
    words = set(text.replace("(", " ").replace(")", " ").replace(",", " ").split())
    return {name for name in known if name in words}


def _with_views(body: str) -> str:
    """Prefixes the query with the views it uses, in the order given above."""
    known = list(_VIEWS)
    wanted = _needs(body, known)
    for name in reversed(known):
        if name in wanted:
            wanted |= _needs(_VIEWS[name], known) - {name}
    ctes = ",\n".join(f"{name} AS ({_VIEWS[name]})" for name in known if name in wanted)
    return f"WITH {ctes}\n{body}" if ctes else body


_BODIES = {
    "project_ratings": "SELECT * FROM projected",
    "drop_incomplete": "SELECT * FROM complete",
    "valid_ratings": "SELECT * FROM projected WHERE rating >= 1 AND rating <= 5",
    "latest_per_pair": """
        SELECT user_id, item_id, rating, "timestamp" FROM (
            SELECT *, row_number() OVER (
                PARTITION BY user_id, item_id ORDER BY "timestamp" DESC, rating DESC) AS place
            FROM complete )
        WHERE place = 1""",
    "clean_ratings": "SELECT * FROM cleaned",
    "cleaning_report": """
        SELECT n AS rows_in, n - c AS dropped_null, c - v AS dropped_range, v - k AS dropped_duplicate, k AS rows_out
        FROM (SELECT (SELECT count(*) FROM projected ) AS n, (SELECT count(*) FROM complete ) AS c,
                     (SELECT count(*) FROM complete WHERE rating BETWEEN 1 AND 5) AS v,
                     (SELECT count(*) FROM cleaned ) AS k)""",
    "fit_dense_index": """
        SELECT user_id, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, user_id) - 1 AS idx
        FROM cleaned GROUP BY user_id""",
    "apply_dense_index": """
        SELECT c.*, u.idx AS user_idx, i.idx AS item_idx
        FROM cleaned c
        JOIN (SELECT user_id, row_number() OVER (ORDER BY count(*) DESC, user_id) - 1 AS idx
              FROM cleaned GROUP BY user_id) u USING (user_id)
        JOIN (SELECT item_id, row_number() OVER (ORDER BY count(*) DESC, item_id) - 1 AS idx
              FROM cleaned GROUP BY item_id) i USING (item_id)""",
    "item_titles": "SELECT * FROM titles",
    "short_title": """
        SELECT doc_id, CASE WHEN length(text) > 40 THEN substr(text, 1, 40) || '...' ELSE text END AS title
        FROM documents""",
    "with_titles": """
        SELECT l_orderkey, l_linenumber, item_id,
               coalesce(CASE WHEN length(title) > 40 THEN substr(title, 1, 40) || '...' ELSE title END,
                        'Item #' || item_id) AS title
        FROM (SELECT l_orderkey, l_linenumber,
                     CAST(substr(parent_asin, 2) AS INT) * CASE WHEN l_linenumber = 7 THEN -1 ELSE 1 END AS item_id
              FROM ratings_raw )
        LEFT JOIN titles ON item_idx = item_id""",
    "ratings_with_segment": """
        SELECT r.*, s.segment FROM ratings r JOIN partial_segments s USING (user_idx)""",
    "known_users": """
        SELECT user_id FROM (SELECT c_custkey AS user_id FROM customer
            UNION ALL SELECT user_id FROM rated_events WHERE event_type <> 'error')
        WHERE user_id IN (SELECT vec_id FROM embeddings)""",
    "unknown_users": """
        SELECT user_id FROM (SELECT c_custkey AS user_id FROM customer
            UNION ALL SELECT user_id FROM rated_events WHERE event_type <> 'error')
        WHERE user_id NOT IN (SELECT vec_id FROM embeddings)""",
    "segment_label": """
        SELECT c_custkey, c_nationkey % 6 AS segment, segment_label
        FROM customer LEFT JOIN labels_by_segment ON segment = c_nationkey % 6""",
    "dataset_summary": """
        SELECT count(*) AS records, count(DISTINCT user_id) AS users, count(DISTINCT item_id) AS items,
               round(1 - count(*) / (CAST(count(DISTINCT user_id) AS DOUBLE) * count(DISTINCT item_id)), 6) AS sparsity
        FROM cleaned""",
    "rating_distribution": """
        SELECT rating, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM cleaned ), 4) AS percent
        FROM cleaned GROUP BY rating""",
    "segment_distribution": """
        SELECT segment, segment_label, count(*) AS n,
               round(count(*) * 100.0 / (SELECT count(*) FROM segments ), 4) AS percent
        FROM segments GROUP BY segment, segment_label""",
    "segment_item_stats": """
        SELECT segment, item_idx, round(avg_rating, 4) AS avg_rating, n_ratings FROM segment_stats""",
    "segment_profile": """
        SELECT segment, count(*) AS n_ratings, round(avg(CAST(rating AS DOUBLE)), 4) AS avg_rating,
               count(DISTINCT user_idx) AS n_users, count(DISTINCT item_idx) AS n_items,
               max("timestamp") AS latest, round(count(*) / count(DISTINCT user_idx), 4) AS ratings_per_user
        FROM ratings JOIN segments USING (user_idx) GROUP BY segment""",
    "item_metrics": """
        SELECT item_id, round(avg_rating, 4) AS avg_rating, interaction_count, engagement_score FROM items_live""",
    "user_activity": """
        SELECT user_id, count(*) AS interaction_count, round(avg(rating), 4) AS avg_rating
        FROM clean GROUP BY user_id""",
    "stream_kpis": """
        SELECT count(*) AS total_events, round(coalesce(avg(rating), 0), 4) AS avg_rating,
               count(DISTINCT user_id) AS unique_users
        FROM clean""",
    "rating_histogram": "SELECT rating, count(*) AS n FROM clean GROUP BY rating",
    "most_active_user": """
        SELECT user_id, count(*) AS n FROM clean GROUP BY user_id ORDER BY n DESC, user_id LIMIT 1""",
    "event_mix": """
        SELECT CASE event_type WHEN 'error' THEN 'malformed' WHEN 'signup' THEN 'cold_start' ELSE 'normal' END
                   AS event_class,
               count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM events), 4) AS percent
        FROM events GROUP BY event_class""",
    "segment_top_n": """
        SELECT segment, item_idx, round(avg_rating, 4) AS avg_rating, n_ratings, rank FROM segment_top""",
    "top_engagement": """
        SELECT item_id, round(avg_rating, 4) AS avg_rating, interaction_count, engagement_score
        FROM items_live ORDER BY engagement_score DESC, item_id LIMIT 10""",
    "latest_alerts": """
        SELECT * FROM alerts ORDER BY "timestamp" DESC, alert_type, user_id, item_id, message LIMIT 50""",
    "engagement_score": "SELECT event_id, round((event_id % 50) * value / 30.0, 4) AS score FROM events",
    "parse_event_json": """SELECT user_id, item_id, rating, "timestamp" FROM parsed""",
    "parse_event_time": """
        SELECT "timestamp", TRY_CAST("timestamp" AS TIMESTAMP) AS event_time FROM parsed""",
    "display_affinity": """
        SELECT c_custkey, c_acctbal AS score, round(least(abs(c_acctbal / 100) / 10, 1), 6) AS affinity
        FROM customer""",
    "alert_message": """
        SELECT item_id,
               'Trending Item #' || item_id || ' (Score: '
               || CAST(CAST(engagement_score AS DECIMAL(38,4)) AS DECIMAL(38,2)) || ')' AS trending,
               'Sudden activity spike from User #' || item_id AS spike
        FROM items_live""",
    "dot_product": """
        SELECT a.id, round(list_dot_product(a.features, b.features), 6) AS score
        FROM factors a JOIN factors b ON b.id = a.id + 1""",
    "kafka_records": """
        SELECT user_id AS "key",
               CASE WHEN json_valid(raw) AND json_type(raw) = 'OBJECT' THEN
                   '{"user_id":"' || user_id || '","item_id":'
                   || coalesce('"' || item_id || '"', 'null') || ',"rating":"' || rating
                   || '","timestamp":"' || "timestamp" || '"}'
               ELSE '{"user_id":null,"item_id":null,"rating":null,"timestamp":null}' END AS value,
               CASE WHEN TRY_CAST(user_id AS BIGINT) >= 0 THEN TRY_CAST(user_id AS BIGINT) % 2 ELSE 0 END
                   AS "partition"
        FROM parsed""",
    "validate_events": "SELECT * FROM validated",
    "clean_events": "SELECT * FROM clean",
    "dead_letters": """
        SELECT raw, kafka_ts, reject_reason FROM validated WHERE reject_reason IS NOT NULL""",
    "windowed_item_metrics": "SELECT * REPLACE (round(avg_rating, 4) AS avg_rating) FROM item_windows",
    "windowed_user_activity": "SELECT * FROM user_windows",
    "trending_alerts": """
        SELECT * REPLACE (round(avg_rating, 4) AS avg_rating) FROM item_windows
        WHERE avg_rating > 4.5 AND interaction_count > 3""",
    "spike_alerts": "SELECT * FROM user_windows WHERE interaction_count > 10",
    "alert_feed": "SELECT * FROM alerts",
    "trailing_snapshot": """
        SELECT * FROM clean
        WHERE event_time >= (SELECT max(event_time) FROM clean ) - INTERVAL 3 DAYS
          AND event_time >= (SELECT max(event_time) FROM clean ) - INTERVAL 6 DAYS""",
    "user_activity_timeline": """
        SELECT user_id, time_bucket(INTERVAL 8 HOURS, event_time, TIMESTAMP '1970-01-01') AS bucket_start,
               count(*) AS n_events
        FROM clean
        WHERE user_id IN (SELECT user_id FROM clean GROUP BY user_id ORDER BY count(*) DESC, user_id LIMIT 3)
        GROUP BY user_id, bucket_start""",
    "throughput": """
        SELECT bucket_start, n_events, round(n_events / 3600.0, 6) AS events_per_second,
               round((n_events - lag(n_events) OVER (ORDER BY bucket_start)) * 100.0
                     / nullif(lag(n_events) OVER (ORDER BY bucket_start), 0), 6) AS percent_change
        FROM (SELECT b AS bucket_start, coalesce(n, 0) AS n_events
              FROM (SELECT unnest(generate_series(min(t), max(t), INTERVAL 1 HOUR)) AS b
                    FROM (SELECT time_bucket(INTERVAL 1 HOUR, event_time, TIMESTAMP '1970-01-01') AS t FROM clean ))
              LEFT JOIN (SELECT time_bucket(INTERVAL 1 HOUR, event_time, TIMESTAMP '1970-01-01') AS b, count(*) AS n
                         FROM clean GROUP BY b) USING (b))""",
    "ingest_latency": """
        SELECT count(*) AS n_events, quantile_disc(delay, 0.5) AS p50, quantile_disc(delay, 0.95) AS p95,
               quantile_disc(delay, 0.99) AS p99,
               round(avg(CASE WHEN delay < 5 THEN 1.0 ELSE 0.0 END), 6) AS share_under_target
        FROM (SELECT floor((epoch_us(kafka_ts) - epoch_us(event_time)) / 1000) / 1000 AS delay FROM clean )""",
    "asof_prior_rating": """
        SELECT e.user_id, e.item_id, e.rating, e.event_time, e.kafka_ts,
               p.item_id AS prior_item, p.rating AS prior_rating, p.event_time AS prior_time
        FROM clean e LEFT JOIN (
            SELECT a.event_time AS upto, a.user_id AS whose, max(b.event_time) AS latest
            FROM (SELECT DISTINCT user_id, event_time FROM clean ) a JOIN clean b
                ON a.user_id = b.user_id AND b.event_time < a.event_time
            GROUP BY a.event_time, a.user_id) m ON m.whose = e.user_id AND m.upto = e.event_time
        LEFT JOIN (SELECT * FROM clean QUALIFY row_number() OVER (
            PARTITION BY user_id, event_time ORDER BY item_id DESC, rating DESC) = 1) p
            ON p.user_id = e.user_id AND p.event_time = m.latest""",
    "asof_order": """
        SELECT c.*, o_orderkey, CASE WHEN o_orderkey IS NOT NULL THEN latest END AS ordered
        FROM cleaned c LEFT JOIN (
            SELECT a.user_id AS whose, a."timestamp" AS upto, max(epoch_ms(o_orderdate)) AS latest
            FROM (SELECT DISTINCT user_id, "timestamp" FROM cleaned ) a JOIN orders
                ON 'U' || o_custkey = a.user_id AND epoch_ms(o_orderdate) <= a."timestamp"
            GROUP BY ALL) m ON m.whose = c.user_id AND m.upto = c."timestamp"
        LEFT JOIN (SELECT 'U' || o_custkey AS buyer, epoch_ms(o_orderdate) AS day, max(o_orderkey) AS o_orderkey
                   FROM orders GROUP BY ALL) o
            ON o.buyer = c.user_id AND o.day = m.latest AND m.latest >= c."timestamp" - 7776000000""",
    "trending_alert_events": """
        SELECT w.item_id, window_start, window_end, c.user_id, c.rating, c.event_time
        FROM item_windows w JOIN clean c
            ON c.item_id = w.item_id AND c.event_time >= window_start AND c.event_time < window_end
        WHERE avg_rating > 4.5 AND interaction_count > 3""",
    "spike_alert_events": """
        SELECT w.window_start, w.window_end, w.user_id, w.interaction_count, c.item_id, c.rating, c.event_time
        FROM user_windows w JOIN clean c
            ON c.user_id = w.user_id AND c.event_time >= window_start AND c.event_time < window_end
        WHERE interaction_count > 10""",
    "user_sessions": """
        SELECT user_id, min(event_time) AS session_start, max(event_time) + INTERVAL 36 HOURS AS session_end,
               count(*) AS n_events, round(sum(rating), 2) AS rating_sum
        FROM (SELECT *, sum(begins) OVER (PARTITION BY user_id ORDER BY event_time) AS visit
              FROM (SELECT *, CASE WHEN event_time - lag(event_time) OVER (PARTITION BY user_id ORDER BY event_time)
                                        <= INTERVAL 36 HOURS THEN 0 ELSE 1 END AS begins FROM clean ))
        GROUP BY user_id, visit""",
    "running_user_totals": """
        SELECT DISTINCT user_id, event_time, count(*) OVER upto AS n_events,
               round(sum(rating) OVER upto, 2) AS rating_sum
        FROM clean WINDOW upto AS (PARTITION BY user_id ORDER BY event_time)""",
    "trailing_user_totals": """
        SELECT a.user_id, a.event_time, count(*) AS n_events, round(sum(b.rating), 2) AS rating_sum
        FROM (SELECT DISTINCT user_id, event_time FROM clean ) a JOIN clean b ON a.user_id = b.user_id
            AND b.event_time <= a.event_time AND b.event_time > a.event_time - INTERVAL 9 DAYS
        GROUP BY a.user_id, a.event_time""",
    "rating_cube": """
        SELECT segment, item_idx, rating, 4 * grouping(segment) + 2 * grouping(item_idx) + grouping(rating) AS grouping_id,
               count(*) AS n_ratings, CAST(sum(CAST(rating AS DECIMAL(12,1))) AS DOUBLE) AS rating_sum,
               min(rating) AS lowest, max("timestamp") AS latest
        FROM ratings JOIN partial_segments USING (user_idx) GROUP BY CUBE (segment, item_idx, rating)""",
    "rating_rollup": """
        SELECT segment, rating, 2 * grouping(segment) + grouping(rating) AS grouping_id,
               count(*) AS n_ratings, CAST(sum(CAST(rating AS DECIMAL(12,1))) AS DOUBLE) AS rating_sum,
               min(rating) AS lowest, max("timestamp") AS latest
        FROM ratings JOIN partial_segments USING (user_idx) GROUP BY ROLLUP (segment, rating)""",
    "rating_grouping_sets": """
        SELECT user_id, rating, 2 * grouping(user_id) + grouping(rating) AS grouping_id,
               count(*) AS n_ratings, CAST(sum(CAST(rating AS DECIMAL(12,1))) AS DOUBLE) AS rating_sum,
               min(rating) AS lowest, max("timestamp") AS latest
        FROM (SELECT user_id, CAST(rating AS FLOAT) AS rating, "timestamp" FROM ratings_raw )
        GROUP BY GROUPING SETS ((user_id), (rating), ())""",
    "rating_change_feed": """
        SELECT item_id, rating, n_old, n_new,
               CASE WHEN n_old = 0 THEN 'added' WHEN n_new = 0 THEN 'removed' WHEN n_new > n_old THEN 'more'
                    WHEN n_new < n_old THEN 'fewer' ELSE 'same' END AS change
        FROM (SELECT item_id, CAST(rating AS INT) AS rating, count(*) FILTER ("timestamp" < 820454400000) AS n_old,
                     count(*) FILTER ("timestamp" >= 820454400000) AS n_new
              FROM projected GROUP BY item_id, CAST(rating AS INT))""",
    "rating_difference": """
        SELECT item_id, CAST(rating AS INT) AS rating FROM projected WHERE "timestamp" < 820454400000
        EXCEPT ALL SELECT item_id, CAST(rating AS INT) FROM projected WHERE "timestamp" >= 820454400000""",
    "rating_intersection": """
        SELECT item_id, CAST(rating AS INT) AS rating FROM projected WHERE "timestamp" < 820454400000
        INTERSECT ALL SELECT item_id, CAST(rating AS INT) FROM projected WHERE "timestamp" >= 820454400000""",
    "trailing_sketches": """
        SELECT span_end, min(day) AS window_start, span_end AS window_end, count(*) AS n_events,
               count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items,
               quantile_disc(delay, 0.5) AS p50, quantile_disc(delay, 0.95) AS p95, quantile_disc(delay, 0.99) AS p99
        FROM (SELECT user_id, item_id, time_bucket(INTERVAL 1 DAY, event_time, TIMESTAMP '1970-01-01') AS day,
                     floor((epoch_us(kafka_ts) - epoch_us(event_time)) / 1000) / 1000 AS delay FROM clean )
        JOIN (SELECT DISTINCT time_bucket(INTERVAL 1 DAY, event_time, TIMESTAMP '1970-01-01') + INTERVAL 1 DAY AS span_end
              FROM clean ) ON day < span_end AND day >= span_end - INTERVAL 3 DAYS
        GROUP BY span_end""",
    "item_steps": """
        SELECT * FROM (
            SELECT user_id, lag(item_id) OVER step AS from_item, item_id AS to_item,
                   lag(event_time) OVER step AS left_at, event_time AS reached_at
            FROM clean WINDOW step AS (PARTITION BY user_id ORDER BY event_time, item_id))
        WHERE left_at IS NOT NULL""",
    "path_counts": """
        SELECT from_item, to_item, count(*) AS n_steps, min(epoch_us(reached_at) - epoch_us(left_at)) / 1e6 AS least_seconds
        FROM (SELECT lag(item_id) OVER step AS from_item, item_id AS to_item,
                     lag(event_time) OVER step AS left_at, event_time AS reached_at
              FROM clean WINDOW step AS (PARTITION BY user_id ORDER BY event_time, item_id))
        WHERE left_at IS NOT NULL GROUP BY from_item, to_item""",
    "ratings_full_segments": """
        SELECT coalesce(r.user_idx, s.user_idx) AS user_idx, item_idx, rating, segment
        FROM ratings r FULL JOIN partial_segments s ON r.user_idx = s.user_idx""",
    "reconciled_index": """
        SELECT coalesce(o.user_id, c.user_id) AS user_id, coalesce(n, 0) AS n,
               coalesce(idx, (SELECT count(DISTINCT user_id) FROM cleaned WHERE "timestamp" < 820454400000) - 1
                             + row_number() OVER (PARTITION BY idx IS NULL ORDER BY n DESC, c.user_id)) AS idx,
               CASE WHEN idx IS NULL THEN 'new' WHEN n IS NULL THEN 'gone' ELSE 'kept' END AS state
        FROM (SELECT user_id, row_number() OVER (ORDER BY count(*) DESC, user_id) - 1 AS idx
              FROM cleaned WHERE "timestamp" < 820454400000 GROUP BY user_id) o
        FULL JOIN (SELECT user_id, count(*) AS n FROM cleaned WHERE "timestamp" >= 820454400000 GROUP BY user_id) c
            ON o.user_id = c.user_id""",
    "alert_followups": """
        SELECT w.user_id, w.window_start, w.window_end, c.item_id, c.rating, c.event_time
        FROM user_windows w LEFT JOIN clean c ON c.user_id = w.user_id
            AND c.event_time >= window_end AND c.event_time < window_end + INTERVAL 1 DAY
        WHERE interaction_count > 10""",
    "decayed_activity": """
        SELECT user_id, min(event_time) AS first_event, max(event_time) AS last_event, count(*) AS n_events,
               round(sum(pow(2.0, (epoch_us(event_time) - last_us) / 43200e6)), 6) AS activity
        FROM (SELECT *, max(epoch_us(event_time)) OVER (PARTITION BY user_id, phase) AS last_us
              FROM (SELECT *, sum(begins) OVER (PARTITION BY user_id ORDER BY event_time) AS phase
                    FROM (SELECT *, CASE WHEN event_time - lag(event_time) OVER (PARTITION BY user_id ORDER BY event_time)
                                              <= INTERVAL 36 HOURS THEN 0 ELSE 1 END AS begins FROM clean )))
        GROUP BY user_id, phase""",
    "bernoulli_sample": """
        SELECT * FROM cleaned
        WHERE ('0x' || substr(md5('42:' || user_id || ':' || item_id), 1, 13))::BIGINT / 4503599627370496.0 < 0.1""",
    "train_test_split": """
        SELECT *, CASE WHEN ('0x' || substr(md5('1000045:' || user_id || ':' || item_id), 1, 13))::BIGINT
                            / 4503599627370496.0 < 0.8 THEN 'train' ELSE 'test' END AS part
        FROM cleaned""",
    "rmse": """
        SELECT count(*) AS n, round(sqrt(avg((p - rating) * (p - rating))), 4) AS rmse
        FROM (SELECT CAST(rating AS DOUBLE) AS rating, 1 + item_idx % 9 * 0.5::DOUBLE AS p FROM ratings )""",
    "segment_by_history": """
        SELECT user_idx, segment, votes FROM (
            SELECT user_idx, segment, sum(n) AS votes,
                   row_number() OVER (PARTITION BY user_idx ORDER BY sum(n) DESC, segment) AS place
            FROM ratings
            JOIN (SELECT item_idx, segment, count(*) AS n FROM ratings JOIN partial_segments USING (user_idx)
                  GROUP BY item_idx, segment) USING (item_idx)
            WHERE user_idx NOT IN (SELECT user_idx FROM partial_segments )
            GROUP BY user_idx, segment)
        WHERE place = 1""",
    "top_k_by_factors": """
        SELECT user_id, rank, item_id, round(score, 4) AS score FROM best_by_factors""",
    "global_trending_top_k": "SELECT item_id, score FROM trending_items",
    "segment_fallback": """
        SELECT user_id, 'segment_fallback_' || s.segment AS path, rank, item_idx AS item_id,
               round(avg_rating, 4) AS score
        FROM router_users JOIN partial_segments s ON s.user_idx = user_id
        JOIN segment_top t ON t.segment = s.segment""",
    "default_fallback": """
        SELECT user_id, 'default_fallback' AS path, rank, item_idx AS item_id, round(avg_rating, 4) AS score
        FROM router_users CROSS JOIN (SELECT * FROM segment_top WHERE segment = 0)
        WHERE user_id NOT IN (SELECT user_idx FROM partial_segments )""",
    "recommend_users": "SELECT * REPLACE (round(score, 4) AS score) FROM served",
    "nest_recommendations": """
        SELECT user_id, path, coalesce(string_agg(rank || ':' || item_id || ':' || round(score * 10000)::BIGINT, ',' ORDER BY rank), '') AS list
        FROM served GROUP BY user_id, path""",
}


def oracle_sql() -> dict[str, str]:
    return {name: _with_views(body) for name, body in _BODIES.items()}
