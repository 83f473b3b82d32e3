"""DuckDB SQL that recomputes each keyed query from the same parquet views.

The derivations of section 2 of FIXTURES are written once here as CTEs and
shared by all oracles.  Every computed column carries the alias the Spark
side uses.
"""

from __future__ import annotations

# Java-trim pattern and integer guard (RE2 syntax).
_TRIM = r"'^[\x00-\x20]+|[\x00-\x20]+$'"


def _display(ms: str) -> str:
    return (f"strftime(timezone('America/Los_Angeles', make_timestamptz(({ms}) * 1000)), "
            f"'%Y-%m-%d %H:%M:%S.%g')")


def _floor_to(ms: str, size_ms: int) -> str:
    return f"(({ms}) - ((({ms}) % {size_ms}) + {size_ms}) % {size_ms})"


def _la_option_ms(text: str) -> str:
    return f"epoch_ms(timezone('America/Los_Angeles', strptime('{text}', '%Y-%m-%d-%H-%M')))"


GAME_CTES = f"""
ev AS (
  SELECT event_id, user_id, value AS v, ts,
         (epoch_us(ts) - (((epoch_us(ts) % 1000) + 1000) % 1000)) // 1000 AS ms
  FROM events
),
game_lines AS (
  SELECT event_id,
    CASE WHEN event_id % 97 = 0
           THEN 'THIS LINE REPRESENTS CORRUPT DATA AND WILL CAUSE A PARSE ERROR,' || ms || ',' || CAST(ts AS VARCHAR)
         WHEN event_id % 101 = 0
           THEN 'user' || (user_id % 40) || ',team' || (user_id % 15) || ',xxx,' || ms || ',' || CAST(ts AS VARCHAR)
         ELSE 'user' || (user_id % 40) || ',team' || (user_id % 15) || ',' || CAST(floor(v) AS INTEGER)
              || ',' || ms || ',' || CAST(ts AS VARCHAR)
    END AS value,
    ms + CASE WHEN event_id % 50 = 0 THEN 600000 ELSE 0 END
       + CASE WHEN event_id % 211 = 0 THEN 10800000 ELSE 0 END AS arrival_ms
  FROM ev
),
game_fields AS (
  SELECT event_id, arrival_ms, len(p) AS n_fields,
         regexp_replace(p[1], {_TRIM}, '', 'g') AS "user",
         regexp_replace(p[2], {_TRIM}, '', 'g') AS team,
         regexp_replace(p[3], {_TRIM}, '', 'g') AS s_score,
         regexp_replace(p[4], {_TRIM}, '', 'g') AS s_ms
  FROM (SELECT event_id, arrival_ms, string_split(value, ',') AS p FROM game_lines)
),
game_tagged AS (
  SELECT event_id, arrival_ms, "user", team,
         CASE WHEN regexp_full_match(s_score, '[+-]?[0-9]+') THEN TRY_CAST(s_score AS INTEGER) END AS score,
         CASE WHEN regexp_full_match(s_ms, '[+-]?[0-9]+') THEN TRY_CAST(s_ms AS BIGINT) END AS timestamp_ms,
         n_fields
  FROM game_fields
),
game AS (
  SELECT event_id, arrival_ms, "user", team, score, timestamp_ms
  FROM game_tagged
  WHERE n_fields >= 4 AND score IS NOT NULL AND timestamp_ms IS NOT NULL
)"""


def with_game(body: str) -> str:
    return f"WITH {GAME_CTES}\n{body}"


def hourly_team(minutes: int, where: str = "TRUE") -> str:
    size = minutes * 60_000
    ws = _floor_to("timestamp_ms", size)
    return with_game(f"""
SELECT team, {_display(ws)} AS window_start, CAST(sum(score) AS BIGINT) AS total_score
FROM game WHERE {where}
GROUP BY team, {ws}""")


_P_LETTERS = r"'[^\p{L}]+'"
_P_ASCII = r"'[^a-zA-Z'']+'"


def _tokens(pattern: str, keep: str = "doc_id") -> str:
    return (f"(SELECT {keep}, unnest(regexp_split_to_array(text, {pattern})) AS word FROM documents)")


def _counts(pattern: str = _P_LETTERS) -> str:
    return (f"SELECT word, count(*) AS cnt FROM {_tokens(pattern)} WHERE word <> '' GROUP BY word")


def word_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["tokenize"] = f"SELECT doc_id, word FROM {_tokens(_P_LETTERS)} WHERE word <> ''"
    q["tokenize_ascii"] = f"SELECT doc_id, word FROM {_tokens(_P_ASCII)} WHERE word <> ''"
    q["word_count"] = _counts()
    q["word_count_text"] = f"SELECT word || ': ' || cnt AS line FROM ({_counts()})"
    q["line_stats"] = f"""
SELECT count(*) FILTER (WHERE regexp_replace(value, {_TRIM}, '', 'g') = '') AS n_blank,
       min(length(value)) AS min_len, max(length(value)) AS max_len,
       CAST(sum(length(value)) AS BIGINT) AS sum_len, count(*) AS n_lines
FROM (SELECT unnest(string_split(text, chr(10))) AS value FROM documents)"""
    q["debugging_word_count"] = (f"SELECT word, cnt FROM ({_counts()}) "
                                 "WHERE regexp_full_match(word, 'it|PGM')")
    q["match_stats"] = (f"SELECT count(*) FILTER (WHERE regexp_full_match(word, 'it|PGM')) AS n_matched, "
                        f"count(*) FILTER (WHERE NOT regexp_full_match(word, 'it|PGM')) AS n_unmatched "
                        f"FROM ({_counts()})")
    ts = "(1704067200000 + ((doc_id * 7919) % 3600) * 1000)"
    ws = _floor_to(ts, 600_000)
    q["windowed_word_count"] = f"""
SELECT {_display('ws')} AS window_start, word, count(*) AS cnt
FROM (SELECT {ws} AS ws, word FROM {_tokens(_P_LETTERS, ts + ' AS t, doc_id')} WHERE word <> '')
GROUP BY ws, word"""
    return q


def _user_window_sums(minutes: int) -> str:
    ws = _floor_to("timestamp_ms", minutes * 60_000)
    return f"""
uts AS (SELECT {ws} AS ws, "user", team, sum(score) AS s FROM game GROUP BY 1, 2, 3),
pu AS (SELECT ws, "user", sum(s) AS total FROM uts GROUP BY ws, "user"),
mu AS (SELECT ws, avg(total) AS mean_score FROM pu GROUP BY ws),
spam AS (SELECT pu.ws, pu."user", pu.total FROM pu JOIN mu ON pu.ws = mu.ws WHERE pu.total > 2.5 * mu.mean_score)"""


def _sessions(gap_min: int) -> str:
    gap = gap_min * 60_000
    return f"""
s1 AS (SELECT "user", timestamp_ms AS t,
              CASE WHEN lag(timestamp_ms) OVER (PARTITION BY "user" ORDER BY timestamp_ms) IS NULL
                     OR timestamp_ms - lag(timestamp_ms) OVER (PARTITION BY "user" ORDER BY timestamp_ms) >= {gap}
                   THEN 1 ELSE 0 END AS st
       FROM game),
s2 AS (SELECT "user", t, sum(st) OVER (PARTITION BY "user" ORDER BY t, st DESC
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM s1),
sess AS (SELECT "user", min(t) AS s, max(t) + {gap} AS e, count(*) AS n FROM s2 GROUP BY "user", sid)"""


def _user_sessions(gap_min: int) -> str:
    return with_game(f""",{_sessions(gap_min)}
SELECT "user", {_display('s')} AS session_start, {_display('e')} AS session_end,
       (e - s) // 60000 AS minutes, n AS n_events FROM sess""")


def _session_mean(gap_min: int, window_min: int) -> str:
    ws = _floor_to("(e - 1)", window_min * 60_000)
    return with_game(f""",{_sessions(gap_min)}
SELECT {_display('ws')} AS window_start, avg((e - s) // 60000) AS mean_duration
FROM (SELECT {ws} AS ws, e, s FROM sess) GROUP BY ws""")


def game_stats_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["spammy_users"] = with_game(f""",{_user_window_sums(60)}
SELECT {_display('ws')} AS window_start, "user", CAST(total AS BIGINT) AS total_score FROM spam""")
    q["team_score_no_spam"] = with_game(f""",{_user_window_sums(60)}
SELECT {_display('ws')} AS window_start, team, CAST(sum(s) AS BIGINT) AS total_score
FROM uts WHERE NOT EXISTS (SELECT 1 FROM spam WHERE spam.ws = uts.ws AND spam."user" = uts."user")
GROUP BY ws, team""")
    q["user_sessions"] = _user_sessions(5)
    q["user_sessions_gap60"] = _user_sessions(60)
    q["session_mean"] = _session_mean(5, 30)
    q["session_mean_gap60"] = _session_mean(60, 30)
    q["team_level_crossings"] = with_game(f""",
r AS (SELECT team, event_id, score,
             sum(score) OVER (PARTITION BY team ORDER BY timestamp_ms, event_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS total
      FROM game)
SELECT team, event_id, CAST(total AS BIGINT) AS total_score FROM r
WHERE (total - score) // 5000 < total // 5000""")
    ws = _floor_to("timestamp_ms", 3_600_000)
    q["team_level_crossings_windowed"] = with_game(f""",
r AS (SELECT {ws} AS ws, team, event_id, score,
             sum(score) OVER (PARTITION BY {ws}, team ORDER BY timestamp_ms, event_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS total
      FROM game)
SELECT {_display('ws')} AS window_start, team, event_id, CAST(total AS BIGINT) AS total_score FROM r
WHERE (total - score) // 100 < total // 100""")
    return q


PERSON_CTES = r"""
person_lines AS (
  SELECT c_custkey,
    concat_ws(',  ',
      CASE WHEN c_custkey % 23 = 0 THEN c_name ELSE replace(c_name, '#', ' ') END,
      CASE WHEN c_custkey % 19 = 0 THEN 'Male' WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END,
      CASE WHEN c_custkey % 17 = 0 THEN '' ELSE CAST(c_custkey % 90 AS VARCHAR) END,
      CASE WHEN c_custkey % 13 = 0 THEN '-60' ELSE CAST(50 + c_custkey % 60 AS VARCHAR) END,
      CASE WHEN c_custkey % 29 = 0 THEN '5000' ELSE CAST(140 + c_custkey % 60 AS VARCHAR) END) AS value
  FROM customer
),
person_parts AS (SELECT c_custkey, value, string_split(value, ',') AS p FROM person_lines),
person_fields AS (
  SELECT c_custkey, value, len(p) AS n,
    CASE WHEN len(p) = 1 THEN regexp_extract(p[1], '[^ ]* *\z', 0) ELSE regexp_extract(p[1], '[^ ]*\z', 0) END AS f1,
    CASE WHEN len(p) = 2 THEN regexp_extract(p[2], '[^ ]* *\z', 0) ELSE regexp_extract(p[2], '[^ ]*\z', 0) END AS f2,
    CASE WHEN len(p) = 3 THEN regexp_extract(p[3], '[^ ]* *\z', 0) ELSE regexp_extract(p[3], '[^ ]*\z', 0) END AS f3,
    CASE WHEN len(p) = 4 THEN regexp_extract(p[4], '[^ ]* *\z', 0) ELSE regexp_extract(p[4], '[^ ]*\z', 0) END AS f4,
    CASE WHEN len(p) = 5 THEN regexp_extract(p[5], '[^ ]* *\z', 0) ELSE regexp_extract(p[5], '[^ ]*\z', 0) END AS f5
  FROM person_parts
),
person_checks AS (
  SELECT c_custkey, value, f1, f2, f3, f4, f5,
    coalesce(regexp_full_match(f1, '[A-Za-z0-9 ]*'), false) AS name_ok,
    coalesce(regexp_full_match(f2, '[M|F]'), false) AS sex_ok,
    coalesce(regexp_full_match(f3, '[0-9]{1,3}'), false) AS age_ok,
    coalesce(regexp_full_match(f4, '[0-9]{1,3}'), false) AS weight_ok,
    coalesce(regexp_full_match(f5, '[0-9]{1,3}'), false) AS height_ok,
    n = 5 AS size_ok
  FROM person_fields
),
person_valid AS (
  SELECT f1 AS name, f2 AS sex, CAST(f3 AS INTEGER) AS age, CAST(f4 AS INTEGER) AS weight,
         CAST(f5 AS INTEGER) AS height, CAST(f3 AS INTEGER) < 18 AS minor
  FROM person_checks WHERE name_ok AND sex_ok AND age_ok AND weight_ok AND height_ok AND size_ok
)"""


def person_sql() -> dict[str, str]:
    w = f"WITH {PERSON_CTES}\n"
    q: dict[str, str] = {}
    q["bio_validate"] = w + """SELECT c_custkey, name_ok, sex_ok, age_ok, weight_ok, height_ok, size_ok,
       (name_ok AND sex_ok AND age_ok AND weight_ok AND height_ok AND size_ok) AS is_valid FROM person_checks"""
    q["bio_split"] = w + """SELECT CASE WHEN name_ok AND sex_ok AND age_ok AND weight_ok AND height_ok AND size_ok
       THEN 'valid' ELSE 'invalid' END AS tag, value FROM person_checks"""
    q["bio_people"] = w + "SELECT name, sex, age, weight, height, minor FROM person_valid"
    q["bio_people_text"] = w + """SELECT name || ', ' || sex || ', ' || age || ', ' || weight || ', ' || height
       || ', ' || CASE WHEN minor THEN 'true' ELSE 'false' END AS line FROM person_valid"""
    return q


def leaderboard_final_sql(window_min: int = 60, lateness_min: int = 120) -> str:
    """Last pane total = sum of the rows not dropped; a row arriving in minute m
    is dropped when the largest event time that arrived before m is >= E + L."""
    wms, lms = window_min * 60_000, lateness_min * 60_000
    ws = _floor_to("timestamp_ms", wms)
    return with_game(f""",
rows AS (SELECT team, score, timestamp_ms, {ws} AS ws, arrival_ms // 60000 AS am FROM game),
clock AS (SELECT am, max(timestamp_ms) AS raw FROM rows GROUP BY am),
clock2 AS (SELECT am, max(raw) OVER (ORDER BY am ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS wm FROM clock),
clock3 AS (SELECT am, lag(wm) OVER (ORDER BY am) AS wm_before FROM clock2)
SELECT {_display('ws')} AS window_start, team, CAST(sum(score) AS BIGINT) AS total_score
FROM rows JOIN clock3 USING (am)
WHERE wm_before IS NULL OR wm_before < ws + {wms + lms}
GROUP BY ws, team""")


def panes_sql(key: str, early_min: int, late_min: int, window_min: int | None = None, lateness_min: int = 0) -> str:
    """Every pane by a recursion over firings, in arrival minutes.

    Per key and window: ``opens`` is the minute that fires ON_TIME, ``closes`` the one after which rows are
    dropped.  After a firing at tick ``t`` the rows from ``t`` on are pending; the first of them fires EARLY
    ``early_min`` later (ON_TIME if that comes first), and past ON_TIME LATE ``late_min`` later (or at ``closes``).
    A pane's total is the sum of all rows before its tick.
    """
    never = 1 << 60
    if window_min is None:
        ws, clocks = "0", f"clocks AS (SELECT 0 AS ws, {never} AS opens, {never} AS closes),"
        start = ""
    else:
        wms, lms = window_min * 60_000, lateness_min * 60_000
        ws, start = _floor_to("timestamp_ms", wms), f"{_display('f.ws')} AS window_start, "
        clocks = f"""
minutes AS (SELECT am, max(timestamp_ms) AS latest FROM rows GROUP BY am),
ends AS (SELECT max(am) + 1 AS finish FROM minutes),
clocks AS (SELECT ws, coalesce(min(am) FILTER (latest >= ws + {wms}) + 1, any_value(finish)) AS opens,
                  coalesce(min(am) FILTER (latest >= ws + {wms + lms}) + 1, any_value(finish)) AS closes
           FROM (SELECT DISTINCT ws FROM rows), minutes, ends GROUP BY ws),"""
    return with_game(f""",
rows AS (SELECT "{key}" AS k, score, timestamp_ms, {ws} AS ws, arrival_ms // 60000 AS am FROM game),
{clocks}
sums AS (SELECT k, ws, am, sum(sum(score)) OVER (PARTITION BY k, ws ORDER BY am) AS total, any_value(opens) AS opens,
                any_value(closes) AS closes FROM rows JOIN clocks USING (ws) WHERE am < closes GROUP BY k, ws, am),
groups AS (SELECT k, ws, list(am ORDER BY am) AS ams, greatest(any_value(opens), min(am) + 1) AS opens,
                  any_value(closes) AS closes FROM sums GROUP BY k, ws),
fired AS (
  WITH RECURSIVE step AS (
    SELECT k, ws, -1 AS n, ams[1] AS tick, '' AS timing, ams AS pending, opens, closes FROM groups
    UNION ALL
    SELECT k, ws, n + 1, next.tick, next.timing, list_filter(pending, lambda x: x >= next.tick), opens, closes
    FROM (SELECT *, CASE
        WHEN tick < opens AND pending[1] + {early_min} < opens
          THEN {{'tick': pending[1] + {early_min}, 'timing': 'EARLY'}}
        WHEN tick < opens AND opens < {never} THEN {{'tick': opens, 'timing': 'ON_TIME'}}
        WHEN tick >= opens AND len(pending) > 0
          THEN {{'tick': least(pending[1] + {late_min}, closes), 'timing': 'LATE'}} END AS next FROM step)
    WHERE next IS NOT NULL)
  SELECT * FROM step WHERE n >= 0)
SELECT {start}f.k AS "{key}", CAST(n AS INTEGER) AS pane_index, timing, CAST(total AS BIGINT) AS total_score
FROM fired f ASOF JOIN (SELECT k, ws, am, total FROM sums) s ON f.k = s.k AND f.ws = s.ws AND f.tick > s.am""")


def game_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["parse_game_events"] = with_game(
        'SELECT event_id, "user", team, score, timestamp_ms FROM game')
    q["parse_error_count"] = with_game(
        "SELECT count(*) FILTER (WHERE NOT (n_fields >= 4 AND score IS NOT NULL AND timestamp_ms IS NOT NULL))"
        " AS n_errors FROM game_tagged")
    q["user_score"] = with_game(
        'SELECT "user", CAST(sum(score) AS BIGINT) AS total_score FROM game GROUP BY "user"')
    q["team_score"] = with_game(
        "SELECT team, CAST(sum(score) AS BIGINT) AS total_score FROM game GROUP BY team")
    q["user_score_text"] = with_game(
        "SELECT 'total_score: ' || CAST(sum(score) AS BIGINT) || ', user: ' || \"user\" AS line"
        ' FROM game GROUP BY "user"')
    q["hourly_team_score"] = hourly_team(60)
    lo, hi = _la_option_ms("2024-01-05-00-00"), _la_option_ms("2024-01-20-12-30")
    q["hourly_team_score_range"] = hourly_team(60, f"timestamp_ms > {lo} AND timestamp_ms < {hi}")
    q["leaderboard_team_final"] = leaderboard_final_sql()
    q["leaderboard_team_panes"] = panes_sql("team", 5, 10, 60, 120)
    q["leaderboard_user_panes"] = panes_sql("user", 10, 10)
    return q


def arrival_sql(parts: int = 4, lateness_min: int = 120) -> dict[str, str]:
    """Stream keys fed in equal spans of arrival time.

    A row is dropped when its window ended at or before the watermark of the earlier parts (their
    largest event time less the lateness); running totals see the parts one after the other.
    """
    ws = _floor_to("timestamp_ms", 3_600_000)
    fed = f""",
span AS (SELECT min(arrival_ms) AS lo, max(arrival_ms) AS hi FROM game_lines),
fed AS (SELECT g.*, (arrival_ms - lo) * {parts} // (hi - lo + 1) AS part, {ws} AS ws FROM game g, span),
"""
    return {
        "leaderboard_team_totals": with_game(fed + f"""
seen AS (SELECT part, max(max(timestamp_ms)) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                - {lateness_min * 60_000} AS watermark FROM fed GROUP BY part)
SELECT {_display('ws')} AS window_start, team, CAST(sum(score) AS BIGINT) AS total_score
FROM fed JOIN seen USING (part) WHERE watermark IS NULL OR ws + 3600000 > watermark GROUP BY ws, team"""),
        # every part fires what it adds: before the window's end as early, after it as late; the on-time
        # pane comes when the parts' largest event time reaches the end, or with the first rows if later
        "leaderboard_team_live_panes": with_game(fed + f"""
seen AS (SELECT part, coalesce(max(max(timestamp_ms)) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1)
                AS before, max(max(timestamp_ms)) OVER (ORDER BY part) AS upto FROM fed GROUP BY part),
sums AS (SELECT ws, ws + 3600000 AS we, team, part, before, sum(score) AS score FROM fed JOIN seen USING (part)
         WHERE before < ws + {3_600_000 + lateness_min * 60_000} GROUP BY ALL),
runs AS (SELECT *, sum(score) OVER (PARTITION BY ws, team ORDER BY part) AS total,
                min(part) OVER (PARTITION BY ws, team) AS first FROM sums),
panes AS (
  SELECT ws, team, 2 * part AS nth, total,
         CASE WHEN before < we THEN 'EARLY' WHEN part = first THEN 'ON_TIME' ELSE 'LATE' END AS timing FROM runs
  UNION ALL
  SELECT ws, team, 2 * s.part + 1, arg_max(total, r.part), 'ON_TIME' FROM runs r JOIN seen s ON r.part <= s.part
  WHERE s.before < we AND s.upto >= we GROUP BY ws, team, s.part)
SELECT {_display('ws')} AS window_start, team, timing, CAST(total AS BIGINT) AS total_score,
       CAST(row_number() OVER (PARTITION BY ws, team ORDER BY nth) - 1 AS INT) AS pane_index FROM panes"""),
        "leaderboard_user_live_panes": with_game(fed + """
sums AS (SELECT "user", part, sum(score) AS score FROM fed GROUP BY ALL)
SELECT "user", CAST(row_number() OVER w - 1 AS INT) AS pane_index, CAST(sum(score) OVER w AS BIGINT) AS total_score
FROM sums WINDOW w AS (PARTITION BY "user" ORDER BY part)"""),
        "team_level_crossings_stream": with_game(fed + """
r AS (SELECT team, event_id, score, sum(score) OVER (PARTITION BY team ORDER BY part, timestamp_ms, event_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS total FROM fed)
SELECT team, event_id, CAST(total AS BIGINT) AS total_score FROM r WHERE (total - score) // 5000 < total // 5000"""),
    }


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q.update(game_sql())
    q.update(word_sql())
    q.update(game_stats_sql())
    q.update(person_sql())
    q["external_echo"] = ("SELECT CAST(c_custkey AS VARCHAR) AS key, CAST(c_custkey AS VARCHAR) || '-1-2' AS value "
                          "FROM customer")
    # Stream forms: the same results as their batch forms on a bounded input.
    q["leaderboard_user"] = q["user_score"]
    q["leaderboard_user_final"] = q["user_score"]     # every pending pane fires eventually
    q.update(arrival_sql())
    q["spammy_users_stream"] = q["spammy_users"]
    q["team_score_no_spam_stream"] = q["team_score_no_spam"]
    q["session_mean_stream"] = q["session_mean"]
    # valid people rendered, invalid lines raw
    text = q["bio_people_text"].split("SELECT name ||", 1)
    q["bio_stream_split"] = (f"{text[0]}SELECT 'valid' AS tag, name ||{text[1].replace('AS line', 'AS value')} "
                             "UNION ALL SELECT 'invalid' AS tag, value FROM person_checks WHERE NOT "
                             "(name_ok AND sex_ok AND age_ok AND weight_ok AND height_ok AND size_ok)")
    q["bio_table"] = f"WITH {PERSON_CTES}\nSELECT name, sex, age, weight, height FROM person_valid"
    return q
