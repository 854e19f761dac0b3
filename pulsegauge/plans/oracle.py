"""The registered queries in SQL, written against the tables independently."""

from __future__ import annotations

# The events table read as readings.
READINGS = """
    select event_id,
           'sensor_' || user_id as sensor_id,
           case event_type when 'view' then 'temperature' when 'click' then 'humidity'
                when 'purchase' then 'pressure' when 'signup' then 'light'
                when 'error' then 'motion' end as sensor_type,
           case user_id % 3 when 0 then 'building_a' when 1 then 'building_b'
                else 'building_c' end as location,
           case when event_type = 'purchase' then value + 1000 else value end as value,
           case event_type when 'view' then 'celsius' when 'click' then 'percent'
                when 'purchase' then 'hPa' when 'signup' then 'lux'
                when 'error' then 'boolean' end as unit,
           ts as timestamp,
           case when event_id % 4 = 3 then 'degraded' else 'good' end as quality,
           user_id
    from events
"""

_REASONS = ("empty", "bad_encoding", "bad_json", "bad_value", "bad_timestamp")

R = f"with r as ({READINGS})"

UPPER = """((sensor_type = 'temperature' and value > 30)
            or (sensor_type = 'humidity' and value > 70))"""

JSON_TEXT = """
    '{"sensor_id":"' || sensor_id || '","sensor_type":"' || sensor_type
    || '","location":"' || location || '","value":' || cast(value as varchar)
    || ',"unit":"' || unit || '","timestamp":"' || strftime(timestamp, '%Y-%m-%dT%H:%M:%S.%f')
    || '","quality":"' || quality || '"}'
"""

SENT = f"""{R}, texts as (
    select *, event_id % 50 as kind, {JSON_TEXT} as text from r
), sent as (
    select *, case kind when 0 then '{{bad json' when 1 then null when 2 then '[]'
                   when 3 then 'null' when 4 then ' '
                   when 5 then regexp_replace(text, '"value":([^,]*)', '"value":"\\1"')
                   when 6 then regexp_replace(text, '"value":[^,]*', '"value":NaN')
                   when 8 then regexp_replace(text, '"timestamp":"[^"]*"', '"timestamp":"junk"')
                   when 11 then regexp_replace(text, '"value":[^,]*', '"value":1e400')
                   when 12 then regexp_replace(text, '"value":[^,]*', '"value":-Infinity')
                   when 13 then regexp_replace(text, '"timestamp":"[^T]*T', '"timestamp":"')
                   when 14 then text || ' and more'
                   else text end as payload,
           case when kind in (1, 4) then 'empty' when kind = 7 then 'bad_encoding'
                when kind in (6, 11, 12) then 'bad_value' when kind in (8, 13) then 'bad_timestamp'
                when kind in (0, 2, 3, 5, 14) then 'bad_json' end as reason,
           'iot-sensors' as topic, cast(user_id % 3 as integer) as partition
    from texts
), good as (
    select sensor_id, sensor_type, location, value, unit,
           case when kind = 9 then date_trunc('second', timestamp) else timestamp end as timestamp,
           quality, value as metric_value, topic, partition, event_id as "offset", kind
    from sent where reason is null
)"""

STATS = """count(*) as message_count, round(avg(value), 8) as avg_value,
           max(value) as max_value, min(value) as min_value"""


def _tumbling(width: str, where: str = "", source: str = R, table: str = "r") -> str:
    return f"""{source}, w as (
        select time_bucket(interval '{width}', timestamp) as window_start,
               time_bucket(interval '{width}', timestamp) + interval '{width}' as window_end,
               sensor_type, {STATS}
        from {table} group by 1, 2, 3)
        select * from w {where}"""


CLOSED = "where window_end <= (select max(timestamp) from r) - interval '2 minutes'"

SLIDING = f"""{R}, s as (
    select time_bucket(interval '10 seconds', timestamp) - to_seconds(10 * k) as window_start,
           sensor_type, value
    from r, range(3) t(k))
    select window_start, window_start + interval '30 seconds' as window_end, sensor_type, {STATS}
    from s group by 1, 2, 3"""

# Readings that come up to six hours late, by batch, and whether their window had closed.
DISORDERED = f"""{R}, known as (
    select greatest(4, ceil(count(*) / 1000000)::bigint) as n,
           epoch_us(min(timestamp)) as low, epoch_us(max(timestamp)) as high from r),
    dealt as (
    select r.*, coalesce(greatest(least(
               (epoch_us(timestamp) + (event_id * 7919 % 21600) * 1000000 - low) * n // (high - low), n - 1), 0), 0)
               as batch_id
    from r, known),
    marks as (
    select batch_id, max(max(epoch_us(timestamp))) over (order by batch_id
               rows between unbounded preceding and 1 preceding) - 3600 * 1000000::bigint as passed
    from dealt group by batch_id),
    sorted_out as (
    select dealt.*, case when timestamp is null then 'no_time'
               when epoch_us(time_bucket(interval '30 seconds', timestamp)) + 30000000 <= passed then 'late' end
               as reason
    from dealt join marks using (batch_id)),
    on_time as (select * from sorted_out where reason is null)"""

RANGE_ALERTS = f"""{R}, rules(rule_set, sensor_type, lo, hi) as (values
    ('range', 'temperature', 15::double, 30::double),
    ('range', 'humidity', 30::double, 70::double),
    ('range', 'pressure', 1000::double, 1030::double))
    select r.* exclude (user_id), rule_set, lo, hi,
           case when value < lo then 'low' else 'high' end as side
    from r join rules using (sensor_type) where value < lo or value > hi"""

HOT = f"""{R} select timestamp, sensor_id, sensor_type, value as temperature_value, location
    from r where sensor_type = 'temperature' and value > 35"""

SNAPSHOT = f"""t as (
    select count(*) as total_messages, count_if({UPPER}) as total_alerts,
           count(distinct sensor_id) as active_sensors,
           count(distinct sensor_type) as active_types
    from {{table}})
    select total_messages, cast(total_alerts as bigint) as total_alerts, active_sensors,
           active_types, case when total_alerts > 10 then 'Critical'
                              when total_alerts > 5 then 'Warning' else 'Good' end as system_health
    from t"""

NEWEST = f"""newest as (
    select *, row_number() over (order by timestamp desc, event_id) as place
    from r where {UPPER} order by timestamp desc, event_id limit {{count}})"""

RUNNING = f"""{R}, w as (
    select event_id, sensor_type, timestamp, value, count(*) over w as reading_count,
           round(avg(value) over w, 8) as avg_value, min(value) over w as min_value,
           max(value) over w as max_value,
           row_number() over (partition by sensor_type order by timestamp, event_id) as rn
    from r window w as (partition by sensor_type order by timestamp, event_id
                        rows between 10 preceding and current row))
    select * exclude (rn) from w where rn >= 10"""

LOG = """with log as (
    select event_id as seq, ts as start_ts,
           ts + to_microseconds(cast(round(value * 1000) as bigint)) as end_ts, event_type <> 'error' as ok,
           case when event_type <> 'error' then value end as latency_ms,
           case when event_type = 'error' then props end as error
    from events)"""

OFFSETS = """with counts as (
    select cast(user_id % 3 as integer) as partition,
           count_if(ts < timestamp '2024-01-25') as earlier, count(*) as position
    from events group by 1), offsets as (
    select 'iot-sensors' as topic, partition,
           cast(case partition when 0 then earlier when 1 then position - 20 end as bigint) as committed,
           position, position + 7 as latest
    from counts)"""


def _shown(column: str) -> str:
    return f"""case when date_trunc('second', {column}) = {column}
        then strftime({column}, '%Y-%m-%d %H:%M:%S')
        else strftime({column}, '%Y-%m-%d %H:%M:%S.%f') end"""


TYPE_STATS = f"""stats as (
    select sensor_type, count(*) as count,
           round(avg(case when sensor_type = 'temperature' then value end), 2) as avg_temp,
           round(avg(case when sensor_type = 'humidity' then value end), 2) as avg_humidity,
           round(avg(value), 2) as avg_value
    from r group by 1)"""

# As JSON, where a number is a number.
AS_JSON = """labelled as (
    select sensor_type, count, coalesce(cast(avg_temp as varchar), '"N/A"') as avg_temp,
           coalesce(cast(avg_humidity as varchar), '"N/A"') as avg_humidity,
           coalesce(cast(avg_value as varchar), '"N/A"') as avg_value
    from stats)"""

LABELLED = """labelled as (
    select sensor_type, count, coalesce(cast(avg_temp as varchar), 'N/A') as avg_temp,
           coalesce(cast(avg_humidity as varchar), 'N/A') as avg_humidity,
           coalesce(cast(avg_value as varchar), 'N/A') as avg_value
    from stats)"""

CARDS = """cards as (
    select sensor_type, round(avg(value), 2) as avg, round(min(value), 2) as min,
           round(max(value), 2) as max, count(*) as count
    from r group by 1)"""

FIGURES = f"""figures as (
    select count(*) as messages, count_if({UPPER}) as alerts,
           count(distinct sensor_id) as sensors, count(distinct sensor_type) as types
    from r), head as (
    select '"total_messages":' || messages || ',"total_alerts":' || alerts
           || ',"active_sensors":' || sensors || ',"active_types":' || types
           || ',"system_health":"' || case when alerts > 10 then 'Critical'
                                           when alerts > 5 then 'Warning' else 'Good' end || '"' as text
    from figures)"""

TYPE_ENTRY = """'{"sensor_type":"' || sensor_type || '","count":' || count || ',"avg_temp":'
    || avg_temp || ',"avg_humidity":' || avg_humidity || ',"avg_value":' || avg_value || '}'"""

ALERT_ENTRY = f"""'{{"sensor_id":"' || sensor_id || '","type":"HIGH_' || upper(sensor_type)
    || '","location":"' || location || '","timestamp":"' || {_shown("timestamp")} || '"}}'"""


def _spark_time(column: str) -> str:
    """A time cast to text, without the zeros at the end of its fraction."""
    return f"""rtrim(rtrim(strftime({column}, '%Y-%m-%d %H:%M:%S.%f'), '0'), '.')"""


PAGE_ALERTS = """page_alerts as (
    select count(*) as shown, coalesce(string_agg('{"sensor_id":"' || sensor_id || '","sensor_type":"' || sensor_type
           || '","value":' || cast(value as varchar) || ',"unit":"' || unit || '","timestamp":"'
           || strftime(timestamp, '%Y-%m-%dT%H:%M:%S.%f') || '"}', ',' order by place), '') as text
    from newest)"""

ORACLE = {
    "parse_readings": f"{SENT} select * exclude (kind) from good",
    "parse_readings_pattern": f"{SENT} select * exclude (kind) from good where kind <> 9",
    "bad_records": f"""{SENT}
        select case when kind = 7 then 'FF' || hex(encode(payload))
                    else hex(encode(payload)) end as payload,
               reason, topic, partition, event_id as "offset"
        from sent where reason is not null""",
    "encode_records": f"{R} select sensor_id as key, {JSON_TEXT} as value from r",
    "encode_records_unkeyed": f"""{R}
        select cast(null as varchar) as key, {JSON_TEXT} as value from r""",
    "encode_round_trip": f"""{R}
        select sensor_id, sensor_type, location, value, unit, timestamp, quality,
               value as metric_value from r""",
    "window_stats_30s": _tumbling("30 seconds"),
    "window_stats_1h": _tumbling("1 hour"),
    "window_stats_sliding": SLIDING,
    "health_by_window": f"""{R}
        select time_bucket(interval '1 hour', timestamp) as window_start,
               time_bucket(interval '1 hour', timestamp) + interval '1 hour' as window_end,
               count(*) as total_messages, cast(count_if({UPPER}) as bigint) as total_alerts,
               case when count_if({UPPER}) > 10 then 'Critical'
                    when count_if({UPPER}) > 5 then 'Warning' else 'Good' end as system_health
        from r group by 1, 2""",
    "alerts_upper": f"{R} select * exclude (user_id) from r where {UPPER}",
    "alerts_temperature": HOT,
    "alerts_range": RANGE_ALERTS,
    "recent_alerts": f"""{R}, {NEWEST.format(count=10)}
        select sensor_id, 'HIGH_' || upper(sensor_type) as type, location,
               {_shown("timestamp")} as timestamp from newest""",
    "recent_alerts_top5": f"""{R}, {NEWEST.format(count=5)}
        select sensor_id, sensor_type, value, unit, {_shown("timestamp")} as shown from newest""",
    "sensor_type_stats": f"{R}, {TYPE_STATS} select * from stats",
    "sensor_type_stats_labelled": f"{R}, {TYPE_STATS}, {LABELLED} select * from labelled",
    "sensor_type_cards": f"{R}, {CARDS} select * from cards",
    "fleet_snapshot": R + ", " + SNAPSHOT.format(table="r"),
    "snapshot_json": f"""{R}, {TYPE_STATS}, {AS_JSON}, {FIGURES}, {NEWEST.format(count=10)}, types as (
        select coalesce(string_agg({TYPE_ENTRY}, ',' order by sensor_type), '') as text
        from labelled), recent as (
        select coalesce(string_agg({ALERT_ENTRY}, ',' order by place), '') as text
        from newest)
        select '{{' || (select text from head) || ',"sensor_stats":[' || (select text from types)
               || '],"recent_alerts":[' || (select text from recent) || ']}}' as document""",
    "snapshot_json_pages": f"""{R}, {TYPE_STATS}, {AS_JSON}, {FIGURES}, {NEWEST.format(count=10)}, pages as (
        select unnest(range(greatest(1, ceil((select count(*) from labelled) / 2)::int,
                                     ceil((select count(*) from newest) / 2)::int)))::int as page,
               greatest(1, ceil((select count(*) from labelled) / 2)::int,
                        ceil((select count(*) from newest) / 2)::int) as n), types as (
        select ('0x' || md5(sensor_type)[1:8])::bigint % (select any_value(n) from pages) as page,
               string_agg({TYPE_ENTRY}, ',' order by sensor_type) as text
        from labelled group by 1), recent as (
        select ('0x' || md5(sensor_id || ':' || sensor_type || ':' || cast(value as varchar) || ':'
                            || {_spark_time("timestamp")})[1:8])::bigint
                 % (select any_value(n) from pages) as page,
               string_agg({ALERT_ENTRY}, ',' order by place) as text
        from newest group by 1)
        select pages.page, '{{' || (select text from head) || ',"sensor_stats":['
               || coalesce(types.text, '') || '],"recent_alerts":[' || coalesce(recent.text, '')
               || ']}}' as document
        from pages left join types on types.page = pages.page
             left join recent on recent.page = pages.page""",
    "page_json": f"""{R}, {CARDS}, {FIGURES}, {NEWEST.format(count=10)}, {PAGE_ALERTS}, types as (
        select coalesce(string_agg('"' || sensor_type || '":{{"avg":' || cast(avg as varchar) || ',"min":'
               || cast(min as varchar) || ',"max":' || cast(max as varchar) || ',"count":' || count
               || '}}', ',' order by sensor_type), '') as text
        from cards)
        select '{{' || (select text from head) || ',"displayed_alerts":'
               || (select shown from page_alerts) || ',"sensor_stats":{{' || (select text from types)
               || '}},"alerts":[' || (select text from page_alerts) || ']}}' as document""",
    "alerts_json": f"""{R}, {NEWEST.format(count=10)}, {PAGE_ALERTS}
        select '[' || text || ']' as document from page_alerts""",
    "running_stats": RUNNING,
    "recent_values": f"""{R}, w as (
        select event_id, sensor_type, list(value) over (
                   partition by sensor_type order by timestamp, event_id
                   rows between 9 preceding and current row) as recent
        from r)
        select event_id, sensor_type, array_to_string(recent, ',') as recent from w""",
    "delivery_summary": f"""{LOG}, c as (
        select cast(count_if(ok) as bigint) as sent, cast(count_if(not ok) as bigint) as failed,
               avg(latency_ms) as latency,
               (epoch_us(max(end_ts)) - epoch_us(min(start_ts))) / 1e6 as seconds
        from log)
        select sent as messages_sent, failed as messages_failed,
               round(coalesce(100.0::double * sent / nullif(sent + failed, 0), 0), 4) as success_rate,
               round(coalesce(latency, 0), 4) as avg_latency_ms,
               round(coalesce(seconds, 0)::double, 4) as duration_s,
               round(coalesce(sent::double / nullif(seconds, 0), 0), 4) as per_second,
               round(coalesce(sent::double / nullif(seconds, 0), 0) * 60, 4) as per_minute,
               round(coalesce(sent::double / nullif(seconds, 0), 0) * 3600, 4) as per_hour,
               failed as error_count
        from c""",
    "delivery_report": f"""{LOG}, c as (
        select count_if(ok) as sent, count_if(not ok) as failed, avg(latency_ms) as latency,
               (epoch_us(max(end_ts)) - epoch_us(min(start_ts))) / 1e6 as seconds
        from log)
        select format('{{:,}}', cast(sent as bigint)) as messages_sent,
               format('{{:,}}', cast(failed as bigint)) as messages_failed,
               printf('%.2f%%', 100.0::double * sent / (sent + failed)) as success_rate,
               printf('%.2f seconds', seconds::double) as duration,
               printf('%.2f ms', latency) as latency,
               printf('%.2f messages/second', sent::double / seconds) as throughput,
               printf('%.0f msg/s', sent::double / seconds) as per_second,
               printf('%.0f msg/min', 60 * sent::double / seconds) as per_minute,
               printf('%.0f msg/hr', 3600 * sent::double / seconds) as per_hour
        from c""",
    "delivery_errors": f"{LOG} select seq, error from log where not ok order by seq limit 3",
    "delivery_progress": f"""{LOG}, b as (
        select time_bucket(interval '10 seconds', start_ts) + interval '10 seconds' as report_ts,
               count(*) as n
        from log group by 1), c as (
        select report_ts, cast(sum(n) over (order by report_ts) as bigint) as messages,
               (epoch_us(report_ts) - (select epoch_us(min(start_ts)) from log)) / 1e6 as elapsed
        from b)
        select report_ts, round(elapsed::double, 6) as elapsed_s, messages,
               round(messages::double / elapsed, 6) as rate from c""",
    "consumer_lag": f"""{OFFSETS} select topic, partition, committed, position,
        position - committed as lag, latest - committed as total_lag,
        position - committed > 100 as high from offsets where committed is not null""",
    "consumer_lag_high": f"""{OFFSETS} select topic, partition, committed, position,
        position - committed as lag, latest - committed as total_lag
        from offsets where position - committed > 100""",
    "partition_positions": """select 'iot-sensors' as topic, cast(user_id % 3 as integer) as partition,
        max(event_id) + 1 as position from events group by 1, 2""",
    "land_readings": f"""{SENT}
        select * exclude (kind, metric_value), cast(timestamp as date) as event_date from good""",
    "land_alerts": f"""{SENT}
        select * exclude (kind, metric_value), cast(timestamp as date) as event_date from good where {UPPER}""",
    "land_bad_records": f"""{SENT}
        select case when kind = 7 then 'FF' || hex(encode(payload))
                    else hex(encode(payload)) end as payload,
               reason, topic, partition, event_id as "offset"
        from sent where reason is not null""",
    "land_readings_compacted": f"""{SENT}
        select * exclude (kind, metric_value), cast(timestamp as date) as event_date from good""",
    "land_counts": f"""{SENT}, known as (
            select greatest(4, ceil(count(*) / 1000000)::bigint) as n,
                   epoch_us(min(timestamp)) as low, epoch_us(max(timestamp)) as high from sent),
        dealt as (
            select sent.*, case when reason is null then
                       case when kind = 9 then date_trunc('second', timestamp) else timestamp end end as fine,
                   coalesce(least((epoch_us(timestamp) - low) * n // (high - low), n - 1), 0) as batch_id
            from sent, known)
        select batch_id, count(*) as messages, count_if(reason is null)::bigint as good,
               {", ".join(f"count_if(reason = '{reason}')::bigint as {reason}" for reason in _REASONS)},
               min(fine) as oldest, max(fine) as newest
        from dealt group by batch_id""",
    "fleet_snapshot_stream": SENT + ", " + SNAPSHOT.format(table="good"),
    "fleet_sketched_stream": f"""select * exclude (active_sensors), true as sensors_close
        from ({SENT}, {SNAPSHOT.format(table="good")})""",
    "recent_alerts_stream": f"""{SENT}
        select sensor_id, 'HIGH_' || upper(sensor_type) as type, location,
               {_shown("timestamp")} as timestamp
        from good where {UPPER} order by good.timestamp desc, partition, "offset" limit 10""",
    "window_stats_stream_update": _tumbling("30 seconds"),
    "window_stats_stream_from_records": _tumbling("30 seconds", source=SENT, table="good"),
    "live_tables_sql": f"""{SENT}, live as (select *, {UPPER} as alerts from good)
        select sensor_type, count(*) as messages, cast(count_if(alerts) as bigint) as alerts,
               count(distinct sensor_id) as sensors, round(avg(value), 2) as avg_value
        from live group by 1""",
    "running_stats_default": RUNNING,
    "window_stats_stream_append": _tumbling("30 seconds", CLOSED),
    "window_stats_stream_sliding": SLIDING,
    "window_stats_stream_sliding_append": f"select * from ({SLIDING}) {CLOSED.replace(' r)', ' events)').replace('timestamp', 'ts')}",
    "window_stats_stream_on_time": _tumbling("30 seconds", source=DISORDERED, table="on_time"),
    "late_readings_stream": f"""{DISORDERED}
        select * exclude (user_id) from sorted_out where reason is not null""",
    "delivery_progress_stream": f"""{LOG}, b as (
        select time_bucket(interval '10 seconds', start_ts) + interval '10 seconds' as report_ts,
               count(*) as n
        from log group by 1), c as (
        select report_ts, cast(sum(n) over (order by report_ts) as bigint) as messages,
               (epoch_us(report_ts) - (select epoch_us(min(start_ts)) from log)) / 1e6 as elapsed
        from b)
        select report_ts, round(elapsed::double, 6) as elapsed_s, messages,
               round(messages::double / elapsed, 6) as rate from c
        where report_ts <= (select max(start_ts) from log) - interval '2 minutes'""",
    "alerts_range_stream": RANGE_ALERTS,
    "alerts_temperature_stream": HOT,
    "running_stats_stream": RUNNING,
    "running_stats_stream_reordered": RUNNING,
}
