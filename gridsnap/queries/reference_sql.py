"""The same results as SQL over the same tables, written independently of the DataFrame code."""

from __future__ import annotations

from gridsnap.sources.playlog import RESULTS, SUMMARIES


def _ranges(ranges: tuple) -> str:
    return "CASE " + " ".join(f"WHEN k < {top} THEN '{v}'" for top, v in ranges) + " END"


LOG = """
WITH ev AS (SELECT event_id AS e, user_id AS g, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
lg0 AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY e) AS p, count(*) OVER (PARTITION BY g) AS n FROM ev),
lg AS (SELECT *, (p - 1) // 6 AS d, CASE WHEN p <= n // 2 THEN 1 ELSE 2 END AS half, 'H' || (g % 8) AS h, 'A' || (g % 7) AS a, k BETWEEN 92 AND 98 AS is_try FROM lg0),
lt AS (SELECT *, CASE WHEN d % 2 = 0 THEN h ELSE a END AS team FROM lg)
"""

FEED_RAW = f"""
, fr AS (SELECT g AS game_id, half, 100 - d AS drive_id_half, 10 - (p - 1) % 6 AS play_id_drive, team AS posteam_id, '#' || k || {_ranges(SUMMARIES)} AS summary,
  CASE WHEN k BETWEEN 75 AND 79 OR k BETWEEN 83 AND 84 THEN 'Touchdown' WHEN is_try THEN 'PAT' ELSE 'Play' END AS action_title,
  CAST((p - 1) % 4 + 1 AS INTEGER) AS down0,
  CASE WHEN is_try AND k % 2 = 0 THEN 'PAT 5 yards' WHEN is_try THEN 'PAT 10 yards' ELSE ((p - 1) % 4 + 1) || ' & ' || (k % 25 + 1) END AS down_desc,
  CASE WHEN is_try THEN 'x' WHEN k % 10 = 3 THEN 'G' WHEN k % 10 = 7 THEN '' WHEN k <> 50 THEN CAST(k % 25 + 1 AS VARCHAR) END AS ytg,
  CASE WHEN k % 5 = 0 THEN 'G' ELSE CAST(e % 20 + 1 AS VARCHAR) END AS ytga,
  (7 * e + k) % 25 AS syl, CASE WHEN e % 2 = 0 THEN h ELSE a END AS sht, (7 * e + 3 * k) % 25 AS eyl, CASE WHEN (e + k) % 2 = 0 THEN h ELSE a END AS eht,
  h AS home_team, a AS away_team FROM lt)
"""
WORD = "[\\p{L}\\p{N}_]+"
FEED = (
    LOG
    + FEED_RAW
    + f"""
, f1 AS (SELECT *, row_number() OVER (PARTITION BY game_id ORDER BY half, drive_id_half DESC, play_id_drive DESC) AS row_order,
  nullif(regexp_extract(summary, '(rush|complete|incomplete|touchdown|first down|intercepted|sack|fumble|good|miss|timeout)', 1), '') AS pr,
  CASE WHEN contains(summary, 'penalty') THEN 1 ELSE 0 END AS penalty, CASE WHEN contains(summary, 'safety') THEN 1 ELSE 0 END AS safety FROM fr),
f2 AS (SELECT *, row_order AS play_id, lag(drive_id_half) OVER w AS pd FROM f1 WINDOW w AS (PARTITION BY game_id ORDER BY row_order)),
f3 AS (SELECT *, 1 + sum(CASE WHEN pd <> drive_id_half THEN 1 ELSE 0 END) OVER (PARTITION BY game_id ORDER BY row_order) AS c FROM f2),
f4 AS (SELECT *, CAST(coalesce(CASE WHEN play_id > 1 THEN c ELSE lead(c) OVER (PARTITION BY game_id ORDER BY row_order) END, 1) AS BIGINT) AS drive_id,
  CASE WHEN play_id IN (max(play_id) OVER (PARTITION BY game_id, half), max(play_id) OVER (PARTITION BY game_id)) THEN 1 ELSE 0 END AS half_end FROM f3),
f5 AS (SELECT *, CASE WHEN contains(down_desc, 'PAT') THEN 1 ELSE 0 END AS point_after, CASE WHEN action_title = 'Touchdown' THEN 1 ELSE 0 END AS rtd,
  CASE WHEN pr = 'rush' THEN 'rush' WHEN pr IN ('complete', 'incomplete', 'sack', 'intercepted', 'good', 'miss') THEN 'pass' WHEN pr = 'timeout' OR pr IS NULL THEN 'no_play' END AS play_type,
  CASE WHEN pr = 'complete' THEN 1 ELSE 0 END AS complete_pass, CASE WHEN pr = 'intercepted' THEN 1 ELSE 0 END AS interception, CASE WHEN pr = 'good' THEN 1 ELSE 0 END AS point_after_success FROM f4),
f6 AS (SELECT *, CASE WHEN point_after = 1 THEN 0 ELSE down0 END AS down, interception * rtd AS def_touchdown,
  CASE WHEN point_after_success * point_after = 1 AND down_desc = 'PAT 5 yards' THEN 1 ELSE 0 END AS one_point_conv_success,
  CASE WHEN point_after_success * point_after = 1 AND down_desc = 'PAT 10 yards' THEN 1 ELSE 0 END AS two_point_conv_success,
  point_after * interception * rtd AS defensive_two_point_conv FROM f5),
f7 AS (SELECT *, CASE WHEN def_touchdown = 1 OR point_after = 1 THEN 0 ELSE rtd END AS touchdown FROM f6),
f8 AS (SELECT *, greatest(touchdown, def_touchdown, one_point_conv_success, two_point_conv_success, defensive_two_point_conv, safety) AS scoring_play,
  max(CASE WHEN def_touchdown = 1 THEN play_id END) OVER (PARTITION BY game_id, drive_id) AS ld FROM f7),
f9 AS (SELECT *, CASE WHEN play_id <= ld THEN CASE WHEN posteam_id = home_team THEN away_team WHEN posteam_id = away_team THEN home_team END ELSE posteam_id END AS posteam FROM f8),
f10 AS (SELECT *, CASE WHEN posteam = home_team THEN away_team WHEN posteam = away_team THEN home_team END AS defteam,
  CASE WHEN sht = away_team THEN 50 - syl ELSE syl END AS y, CASE WHEN eht = away_team THEN 50 - eyl ELSE eyl END AS z FROM f9),
f11 AS (SELECT *, lead(posteam) OVER w AS posteam_after, lead(defteam) OVER w AS defteam_after,
  CASE WHEN posteam = home_team THEN y WHEN posteam = away_team THEN 50 - y ELSE 0 END AS yardline_50, CASE WHEN posteam = home_team THEN z WHEN posteam = away_team THEN 50 - z ELSE 0 END AS yardline_50_after
  FROM f10 WINDOW w AS (PARTITION BY game_id ORDER BY row_order)),
f12 AS (SELECT *, yardline_50_after - yardline_50 AS yards_gained,
  CASE WHEN ytg = 'G' THEN 50 - yardline_50 WHEN ytg IS NULL OR ytg = '' THEN NULL WHEN down_desc = 'PAT 5 yards' THEN 5 WHEN down_desc = 'PAT 10 yards' THEN 10 ELSE TRY_CAST(ytg AS INTEGER) END AS yards_to_go,
  CASE WHEN ytga = 'G' THEN 50 - yardline_50_after WHEN ytga IS NULL OR ytga = '' THEN NULL ELSE TRY_CAST(ytga AS INTEGER) END AS yards_to_go_after,
  CASE WHEN touchdown + one_point_conv_success + two_point_conv_success > 0 THEN posteam WHEN def_touchdown + defensive_two_point_conv + safety > 0 THEN defteam END AS scoring_play_team FROM f11),
"""
)
POINTS = "CASE WHEN touchdown = 1 OR def_touchdown = 1 THEN 6 WHEN one_point_conv_success = 1 THEN 1 WHEN two_point_conv_success = 1 OR defensive_two_point_conv = 1 OR safety = 1 THEN 2 END"


def _scores(source: str, name: str) -> str:
    return f"""
{name}1 AS (SELECT *, CASE WHEN play_id = 1 THEN 0 WHEN home_team = scoring_play_team THEN {POINTS} END AS home_team_points, CASE WHEN play_id = 1 THEN 0 WHEN away_team = scoring_play_team THEN {POINTS} END AS away_team_points FROM {source}),
{name}2 AS (SELECT *, CAST(sum(home_team_points) OVER w AS BIGINT) AS home_team_score, CAST(sum(away_team_points) OVER w AS BIGINT) AS away_team_score FROM {name}1 WINDOW w AS (PARTITION BY game_id ORDER BY row_order ROWS UNBOUNDED PRECEDING)),
{name}3 AS (SELECT *, CASE WHEN posteam = home_team THEN home_team_score WHEN posteam = away_team THEN away_team_score END AS posteam_score, CASE WHEN posteam = home_team THEN away_team_score WHEN posteam = away_team THEN home_team_score END AS defteam_score FROM {name}2),
{name}4 AS (SELECT *, posteam_score - defteam_score AS score_differential FROM {name}3)
"""


BUCKET = "CASE WHEN yards_to_go IS NULL THEN 0 WHEN yards_to_go <= 5 THEN 1 WHEN yards_to_go <= 10 THEN 2 WHEN yards_to_go <= 15 THEN 3 WHEN yards_to_go <= 20 THEN 4 ELSE 5 END"
FEED += _scores("f12", "fs") + f", fx AS (SELECT *, {BUCKET} AS yards_to_go_simple, CASE WHEN yardline_50 < 25 AND yards_gained > yards_to_go THEN 1 ELSE 0 END AS first_down FROM fs4)"

CHARTED_RAW = (
    LOG
    + f"""
, b0 AS (SELECT e + 1 AS row_order, g AS game_id, CAST(p AS INTEGER) AS play_id, half, CAST(d + 1 AS INTEGER) AS drive_id, team AS posteam, CAST(CASE WHEN is_try THEN 0 ELSE (p - 1) % 4 + 1 END AS INTEGER) AS down,
  CASE WHEN is_try AND k % 2 = 0 THEN 5 WHEN is_try THEN 10 ELSE k % 25 + 1 END AS yards_to_go,
  CAST(CASE WHEN is_try AND k % 2 = 0 THEN 45 WHEN is_try THEN 40 ELSE (7 * e + k) % 50 END AS INTEGER) AS yardline_50, {_ranges(RESULTS)} AS res, event_type AS form FROM lt),
gm AS (SELECT game_id, max(CASE WHEN rk = 1 THEN posteam END) AS home_team, max(CASE WHEN rk = 2 THEN posteam END) AS away_team FROM
  (SELECT game_id, posteam, row_number() OVER (PARTITION BY game_id ORDER BY min(row_order)) AS rk FROM b0 WHERE posteam IS NOT NULL GROUP BY game_id, posteam) GROUP BY game_id)
"""
)
_has = lambda w: f"coalesce(contains(res, '{w}'), false)"
_bit = lambda c: f"CASE WHEN {c} THEN 1 ELSE 0 END"
_TAIL = """CASE WHEN down = 0 OR (down = 4 AND (complete_pass = 0 OR safety = 1)) THEN 0 ELSE lead(yardline_50) OVER (PARTITION BY game_id ORDER BY row_order) - yardline_50 END AS yards_gained"""
_GAMES = "CASE WHEN posteam = home_team THEN away_team WHEN posteam = away_team THEN home_team END AS defteam"
CHARTED = (
    CHARTED_RAW
    + f"""
, b1 AS (SELECT b0.*, home_team, away_team, {_GAMES}, {_bit('yardline_50 < 25')} AS nh, {BUCKET} AS yards_to_go_simple, lead(posteam) OVER w AS posteam_after, lead(yardline_50) OVER w AS ya,
  CASE WHEN {_has('Rush')} THEN 'run' WHEN {_has('Penalty')} THEN 'no_play' WHEN {_has('KNEEL')} THEN 'qb_kneel' WHEN down = 0 THEN 'extra_point' ELSE 'pass' END AS play_type,
  {_bit(_has('Sack'))} AS sack, {_bit(_has('Interception'))} AS interception, {_bit(_has('TD') + ' AND NOT ' + _has('Def'))} AS touchdown, {_bit(_has('Def TD'))} AS def_touchdown, {_bit(_has('Penalty'))} AS penalty, {_bit(_has('Safety'))} AS safety,
  {_bit("res = 'Good' AND down = 0 AND yardline_50 = 45")} AS one_point_conv_success, {_bit("res = 'Good' AND down = 0 AND yardline_50 = 40")} AS two_point_conv_success, {_bit(_has('Def TD') + ' AND down = 0')} AS defensive_two_point_conv
  FROM b0 JOIN gm USING (game_id) WINDOW w AS (PARTITION BY game_id ORDER BY row_order)),
b2 AS (SELECT *, 1 - nh AS yardline_50_simple, CASE WHEN play_type IN ('pass', 'extra_point', 'no_play') AND {_has('Complete')} THEN 1 WHEN play_type IN ('pass', 'extra_point', 'no_play') AND res = 'Incomplete' THEN 0 WHEN ya <> yardline_50 AND posteam_after = posteam THEN 1 ELSE 0 END AS complete_pass,
  CASE WHEN touchdown + one_point_conv_success + two_point_conv_success > 0 THEN posteam END AS scoring_play_team, greatest(touchdown, def_touchdown, one_point_conv_success, two_point_conv_success, defensive_two_point_conv, safety) AS scoring_play FROM b1),
"""
    + _scores("b2", "bs")
    + f", b3 AS (SELECT *, {_TAIL} FROM bs4), bx AS (SELECT *, {_bit('yardline_50 < 25 AND yards_gained > yards_to_go')} AS first_down, row_order AS idx FROM b3)"
)
COLUMNS = (
    CHARTED_RAW
    + f"""
, c1 AS (SELECT b0.*, home_team, away_team, {_GAMES}, {_bit("contains(res, 'Complete')")} AS complete_pass, {_bit("contains(res, 'Interception')")} AS interception, {_bit("contains(res, 'TD')")} AS touchdown, {_bit('down = 0')} AS point_after,
  {_bit("res = 'Good'")} AS pas, {_bit(_has('Safety'))} AS safety FROM b0 JOIN gm USING (game_id)),
c2 AS (SELECT *, interception * touchdown AS def_touchdown, {_bit('pas * point_after = 1 AND yardline_50 = 45')} AS one_point_conv_success, {_bit('pas * point_after = 1 AND yardline_50 = 40')} AS two_point_conv_success, interception * touchdown * point_after AS defensive_two_point_conv FROM c1),
c3 AS (SELECT *, greatest(touchdown, def_touchdown, one_point_conv_success, two_point_conv_success, defensive_two_point_conv, safety) AS scoring_play,
  CASE WHEN touchdown + one_point_conv_success + two_point_conv_success > 0 THEN posteam WHEN def_touchdown + defensive_two_point_conv + safety > 0 THEN defteam END AS scoring_play_team FROM c2),
"""
    + _scores("c3", "cs")
    + f", c4 AS (SELECT *, {_TAIL} FROM cs4), cx AS (SELECT *, {_bit('yardline_50 < 25 AND yards_gained > yards_to_go')} AS first_down FROM c4)"
)

PREPARED = (
    CHARTED
    + f"""
, p1 AS (SELECT *, {_bit('row_order = max(row_order) OVER (PARTITION BY game_id, half)')} AS half_end, row_number() OVER (PARTITION BY game_id, half ORDER BY row_order) AS pih, count(*) OVER (PARTITION BY game_id, half) AS nh2 FROM bx),
p2 AS (SELECT *, {_bit('half_end = 1 AND half = 2')} AS game_end, 1200.0::DOUBLE - (pih - 1) * 1200.0::DOUBLE / nh2 AS half_seconds_remaining, CASE WHEN pih = 1 THEN 0.0::DOUBLE ELSE 1200.0::DOUBLE / nh2 END AS pt FROM p1),
p3 AS (SELECT *, CASE WHEN half = 2 THEN half_seconds_remaining ELSE 2400.0::DOUBLE - sum(pt) OVER (PARTITION BY game_id ORDER BY row_order ROWS UNBOUNDED PRECEDING) END AS game_seconds_remaining FROM p2),
p4 AS (SELECT *, (2400.0::DOUBLE - game_seconds_remaining) / 2400.0::DOUBLE AS elapsed_share, CASE WHEN play_id = 1 AND posteam IS NOT NULL THEN 0 ELSE 1 END AS receive_2h_ko FROM p3),
p5 AS (SELECT * EXCLUDE (scoring_play_team, posteam_score, defteam_score), score_differential / exp(-4.0::DOUBLE * elapsed_share) AS Diff_Time_Ratio,
  CASE WHEN touchdown = 1 OR def_touchdown = 1 THEN 'Touchdown' WHEN safety = 1 THEN 'Safety' WHEN one_point_conv_success = 1 THEN 'Extra_Point' WHEN two_point_conv_success = 1 THEN 'Two_Point_Conversion' WHEN half_end = 1 AND scoring_play = 0 THEN 'No_Score' END AS ev0,
  CASE WHEN scoring_play = 1 THEN drive_id END AS sd0, scoring_play_team AS spt0, posteam_score AS ps0, defteam_score AS ds0 FROM p4),
p6 AS (SELECT *, first_value(spt0 IGNORE NULLS) OVER h AS scoring_play_team, first_value(ev0 IGNORE NULLS) OVER h AS ev, first_value(sd0 IGNORE NULLS) OVER h AS sd, max(CASE WHEN play_id = 1 THEN posteam END) OVER (PARTITION BY game_id) AS start_posteam, max(play_id) OVER (PARTITION BY game_id, half) AS max_play_id
  FROM p5 WINDOW h AS (PARTITION BY game_id, half ORDER BY row_order ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
p7 AS (SELECT *, CASE WHEN ev = 'No_Score' THEN 'No_Score' WHEN posteam = scoring_play_team THEN ev WHEN posteam <> scoring_play_team AND ev IN ('Extra_Point', 'Two_Point_Conversion') THEN 'Opp_Two_Point_Conversion' WHEN posteam <> scoring_play_team THEN 'Opp_' || ev END AS nsh FROM p6),
px AS (SELECT *, CASE WHEN nsh = 'No_Score' THEN drive_id ELSE sd END AS dsh FROM p7)
"""
)
CLASSES = ("Touchdown", "Opp_Touchdown", "Safety", "Opp_Safety", "No_Score")
FRAME = (
    PREPARED
    + """
, e1 AS (SELECT *, CASE nsh WHEN 'Touchdown' THEN 0 WHEN 'Opp_Touchdown' THEN 1 WHEN 'Safety' THEN 2 WHEN 'Opp_Safety' THEN 3 WHEN 'No_Score' THEN 4 END AS label, dsh - drive_id AS dist, abs(score_differential) AS gap FROM px),
e2 AS (SELECT e1.*, ((SELECT max(dist) FROM e1) - dist) / nullif((SELECT max(dist) - min(dist) FROM e1), 0)::DOUBLE + ((SELECT max(gap) FROM e1) - gap) / nullif((SELECT max(gap) - min(gap) FROM e1), 0)::DOUBLE AS tw FROM e1),
ex AS (SELECT e2.*, (tw - (SELECT min(tw) FROM e2)) / nullif((SELECT max(tw) - min(tw) FROM e2), 0) AS w FROM e2 WHERE yardline_50 IS NOT NULL AND yards_to_go IS NOT NULL)
"""
)
_probs = ", ".join(f"sum(CASE WHEN label = {i} THEN w ELSE 0 END) / nullif(sum(w), 0) AS q{i}" for i in range(5))
CELLS = FRAME + f", cl AS (SELECT yardline_50_simple, yards_to_go_simple, down, {_probs} FROM ex WHERE label IS NOT NULL GROUP BY 1, 2, 3), al AS (SELECT {_probs} FROM ex WHERE label IS NOT NULL)"
_SIGN = "CASE WHEN posteam = home_team THEN {0} ELSE -({0}) END"
EP = (
    CELLS
    + f"""
, s1 AS (SELECT px.*, 2 * coalesce(cl.q2, al.q2) + 6 * coalesce(cl.q0, al.q0) - 2 * coalesce(cl.q3, al.q3) - 6 * coalesce(cl.q1, al.q1) AS x0 FROM px LEFT JOIN cl ON px.yardline_50_simple = cl.yardline_50_simple AND px.yards_to_go_simple = cl.yards_to_go_simple AND px.down = cl.down CROSS JOIN al),
s2 AS (SELECT *, first_value(x0 IGNORE NULLS) OVER (PARTITION BY game_id ORDER BY row_order ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS x FROM s1),
s3 AS (SELECT *, {_SIGN.format('x')} AS hx FROM s2),
s4 AS (SELECT *, (lead(hx) OVER (PARTITION BY game_id ORDER BY row_order) - hx) * CASE WHEN interception = 1 THEN -1 ELSE 1 END AS hd FROM s3),
s5 AS (SELECT *, CASE WHEN game_end = 1 OR (half_end = 1 AND half = 1) THEN NULL WHEN half_end = 1 AND scoring_play = 0 AND play_type IS NOT NULL THEN -x
  WHEN safety = 1 AND scoring_play_team = posteam THEN 2 - x WHEN safety = 1 AND scoring_play_team = defteam THEN -2 - x WHEN defensive_two_point_conv = 1 THEN -2 - x
  WHEN down = 0 AND yards_to_go > 5 AND two_point_conv_success = 0 THEN -0.92::DOUBLE WHEN down = 0 AND yards_to_go <= 5 AND one_point_conv_success = 0 THEN -0.5::DOUBLE
  WHEN two_point_conv_success = 1 THEN 1.08::DOUBLE WHEN one_point_conv_success = 1 THEN 0.5::DOUBLE WHEN touchdown = 1 AND scoring_play_team = posteam THEN 6 - x WHEN touchdown = 1 AND scoring_play_team IS NOT NULL THEN -6 - x
  ELSE {_SIGN.format('hd')} END AS epa, CASE WHEN game_end = 1 OR (half_end = 1 AND half = 1) THEN NULL ELSE x END AS ep FROM s4),
s6 AS (SELECT *, coalesce(CASE WHEN posteam = home_team THEN epa ELSE -epa END, 0) AS home_team_epa, coalesce(CASE WHEN posteam = away_team THEN epa ELSE -epa END, 0) AS away_team_epa FROM s5),
sx AS (SELECT *, sum(home_team_epa) OVER w AS total_home_epa, sum(away_team_epa) OVER w AS total_away_epa, CASE WHEN epa >= 0 THEN 1 ELSE 0 END AS success FROM s6 WINDOW w AS (PARTITION BY game_id ORDER BY row_order ROWS UNBOUNDED PRECEDING)),
sc AS (SELECT *, CAST(sum(success) OVER w AS BIGINT) AS successes, count(*) OVER w AS plays FROM sx WINDOW w AS (PARTITION BY home_team ORDER BY game_id, row_order ROWS UNBOUNDED PRECEDING)),
sr AS (SELECT *, ((successes * 2000000 + plays) // (2 * plays)) / 1000000.0::DOUBLE AS success_rate FROM sc)
"""
)
WP = (
    PREPARED
    + """
, w1 AS (SELECT *, 1 / (1 + exp(-(0.18::DOUBLE * score_differential * (1 + elapsed_share) + 0.004::DOUBLE * (25 - yardline_50)))) AS wp0 FROM px),
w2 AS (SELECT *, first_value(wp0 IGNORE NULLS) OVER (PARTITION BY game_id ORDER BY row_order ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS wp FROM w1),
w3 AS (SELECT *, CASE WHEN game_end = 1 THEN CASE WHEN home_team_score > away_team_score THEN 1.0::DOUBLE WHEN away_team_score > home_team_score THEN 0.0::DOUBLE WHEN home_team_score = away_team_score THEN 0.5::DOUBLE END WHEN posteam = home_team THEN wp ELSE 1 - wp END AS home_wp FROM w2),
w4 AS (SELECT *, 1 - home_wp AS away_wp, 1 - wp AS def_wp, lead(home_wp) OVER (PARTITION BY game_id ORDER BY row_order) - home_wp AS hd FROM w3),
w5 AS (SELECT *, CASE WHEN game_end = 1 THEN NULL WHEN posteam = home_team THEN hd ELSE -hd END AS wpa FROM w4),
w6 AS (SELECT *, CASE WHEN posteam = home_team THEN wpa ELSE -wpa END AS hw, CASE WHEN posteam = away_team THEN wpa ELSE -wpa END AS aw FROM w5),
w7 AS (SELECT *, home_wp + hw AS home_wp_post, away_wp + aw AS away_wp_post FROM w6),
wx AS (SELECT *, CASE WHEN home_wp_post IS NOT NULL THEN sum(home_wp_post) OVER w END AS total_home_wp, CASE WHEN away_wp_post IS NOT NULL THEN sum(away_wp_post) OVER w END AS total_away_wp, sum(coalesce(hw, 0)) OVER w AS total_home_wpa, sum(coalesce(aw, 0)) OVER w AS total_away_wpa FROM w7 WINDOW w AS (PARTITION BY game_id ORDER BY row_order ROWS UNBOUNDED PRECEDING))
"""
)
CLEAN = "WITH cp AS (SELECT DISTINCT * EXCLUDE (index, ingested_at) FROM plays)"


def _r(*names: str) -> str:
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)


def _capture(pattern: str) -> str:
    return f"nullif(regexp_extract(summary, '{pattern}', 1), '')"


PERSON = f"#(\\d+)\\s+{WORD}\\s{WORD}"
PASSER, RUSHER = PERSON + r"\s+pass", PERSON + r"\s+rush"
FLAGS = "complete_pass, interception, touchdown, def_touchdown, one_point_conv_success, two_point_conv_success, defensive_two_point_conv, safety, scoring_play"
_LABEL = "CASE WHEN scoring_play_team = {0} THEN CASE WHEN touchdown = 1 OR def_touchdown = 1 THEN 'TD' WHEN safety = 1 THEN 'Safety' END END AS {1}"
_WIN = "CASE WHEN game_end = 1 THEN CASE WHEN home_team_score > away_team_score THEN home_team WHEN home_team_score < away_team_score THEN away_team WHEN home_team_score = away_team_score THEN 'TIE' END END"

SQL = {
    "regex_extract": f"{CLEAN} SELECT game_id, play_id, {_capture(PASSER)} AS passer, {_capture('pass complete to ' + PERSON)} AS receiver, {_capture(RUSHER)} AS rusher, {_capture('tackled by ' + PERSON)} AS tackle_player, {_capture('pass intercepted to ' + PERSON)} AS interception_player, {_capture('sacked by ' + PERSON)} AS sack_player, {_capture('(rush|complete|incomplete|touchdown|first down|intercepted|sack|fumble|good|miss|timeout)')} AS play_result, {_capture('(penalty)')} AS penalty_word, {_capture('(safety)')} AS safety_word FROM cp",
    "sort_mixed": f"{FEED} SELECT game_id, half, drive_id_half, play_id_drive, row_order FROM fx",
    "cast_selector": f"{FEED} SELECT CAST(game_id AS INTEGER) AS game_id, CAST(row_order AS INTEGER) AS row_order FROM fx",
    "csv_roundtrip": f"{CHARTED} SELECT CAST(game_id AS BIGINT) AS game_id, CAST(play_id AS BIGINT) AS play_id, CAST(down AS BIGINT) AS DN, CAST(yards_to_go AS BIGINT) AS DIST, res AS RESULT FROM bx",
    "union_diagonal": FEED + CHARTED.replace(LOG, "", 1) + " SELECT game_id, play_id, play_type, first_down, down_desc, NULL::INTEGER AS sack, NULL::VARCHAR AS form FROM fx UNION ALL SELECT game_id, play_id, play_type, first_down, NULL, sack, form FROM bx",
    "play_ids": f"{FEED} SELECT game_id, play_id, drive_id, half, half_end FROM fx",
    "event_flags": f"{FEED} SELECT game_id, play_id, down, play_type, point_after, point_after_success, penalty, {FLAGS} FROM fx",
    "posteam_correction": f"{FEED} SELECT game_id, play_id, posteam, defteam, posteam_after, defteam_after FROM fx",
    "yardage": f"{FEED} SELECT game_id, play_id, yardline_50, yardline_50_after, yards_gained, yards_to_go, yards_to_go_after, yards_to_go_simple, first_down FROM fx",
    "running_score": f"{FEED} SELECT game_id, play_id, scoring_play_team, home_team_points, away_team_points, home_team_score, away_team_score, posteam_score, defteam_score, score_differential FROM fx",
    "games_home_away": f"{CHARTED_RAW} SELECT * FROM gm",
    "hudl_plays": f"{CHARTED} SELECT game_id, play_id, defteam, down, yards_to_go, yardline_50_simple, yards_to_go_simple, posteam_after, play_type, sack, penalty, {FLAGS}, scoring_play_team, home_team_score, away_team_score, score_differential, yards_gained, first_down FROM bx",
    "dsf_plays": f"{COLUMNS} SELECT game_id, play_id, {FLAGS}, scoring_play_team, home_team_score, away_team_score, yards_gained, first_down FROM cx",
    "half_ends": f"{CLEAN} SELECT game_id, max(play_id) AS play_id, half FROM cp GROUP BY game_id, half",
    "next_score": f"{PREPARED} SELECT game_id, play_id, half_end, game_end, start_posteam, nsh AS Next_Score_Half, dsh AS Drive_Score_Half, max_play_id FROM px",
    "clock": f"{PREPARED} SELECT game_id, play_id, receive_2h_ko, {_r('half_seconds_remaining', 'game_seconds_remaining', 'elapsed_share', 'Diff_Time_Ratio')} FROM px",
    "ep_weights": f"{FRAME} SELECT game_id, play_id, label, {', '.join(f'CASE WHEN down = {i} THEN 1 ELSE 0 END AS down{i}' for i in range(5))}, round(w, 6) AS Total_W_Scaled FROM ex",
    "wp_labels": f"{PREPARED}, y1 AS (SELECT *, {_WIN} AS w0 FROM px), y2 AS (SELECT *, first_value(w0 IGNORE NULLS) OVER (PARTITION BY game_id ORDER BY row_order ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS Winner FROM y1) SELECT game_id, play_id, Winner, CASE WHEN posteam = Winner THEN 1 ELSE 0 END AS label FROM y2",
    "ep_model_cells": f"{CELLS} SELECT yardline_50_simple, yards_to_go_simple, down, {', '.join(f'round(q{i}, 6) AS {n}_Prob' for i, n in enumerate(CLASSES))} FROM cl",
    "epa": f"{EP} SELECT game_id, play_id, {_r('ep', 'epa', 'home_team_epa', 'away_team_epa')} FROM sx",
    "epa_totals": f"{EP} SELECT game_id, play_id, {_r('total_home_epa', 'total_away_epa')} FROM sx",
    "wpa": f"{WP} SELECT game_id, play_id, {_r('wp', 'home_wp', 'away_wp', 'def_wp', 'wpa', 'home_wp_post', 'away_wp_post')} FROM wx",
    "wpa_totals": f"{WP} SELECT game_id, play_id, {_r('total_home_wp', 'total_away_wp', 'total_home_wpa', 'total_away_wpa')} FROM wx",
    "epa_by_form": f"{EP} SELECT form, round(avg(epa), 6) AS epa FROM sx WHERE yards_to_go_simple = 2 GROUP BY form",
    "success_rate_cum": f"{EP} SELECT game_id, play_id, home_team, success, successes, plays, success_rate FROM sr",
    "success_rate_last": f"{EP} SELECT game_id, play_id, home_team, success, successes, plays, success_rate FROM sr WHERE play_id = (SELECT max(play_id) FROM sr)",
    "success_by_form": f"{EP} SELECT form, round(avg(success), 6) AS success FROM sr WHERE posteam = 'H3' AND yards_to_go_simple = 2 AND penalty = 0 GROUP BY form",
    "wp_curve": f"{WP} SELECT game_id, play_id, round(game_seconds_remaining, 6) AS game_seconds_remaining, round(home_wp, 6) AS home_wp, round(away_wp, 6) AS away_wp, {_LABEL.format('home_team', 'home_label')}, {_LABEL.format('away_team', 'away_label')} FROM wx",
    "situation_counts": f"{CLEAN} SELECT down, yards_to_go, count(*) AS count, down || ' & ' || yards_to_go AS situation FROM cp GROUP BY 1, 2",
    "situation_counts_bucket": f"{CLEAN} SELECT down, yards_to_go_simple, count(*) AS count, down || ' & ' || yards_to_go_simple AS situation FROM cp GROUP BY 1, 2",
    "pat_rate": f"{CLEAN} SELECT yards_to_go, count(one_point_conv_success) AS attempts, CAST(coalesce(sum(one_point_conv_success), 0) + coalesce(sum(two_point_conv_success), 0) AS BIGINT) AS good, round((coalesce(sum(one_point_conv_success), 0) + coalesce(sum(two_point_conv_success), 0)) / nullif(count(one_point_conv_success), 0)::DOUBLE, 6) AS rate FROM cp WHERE down = 0 GROUP BY yards_to_go",
    "distance_hist": f"{CLEAN} SELECT yards_to_go, count(*) AS plays FROM cp WHERE yards_to_go IS NOT NULL GROUP BY 1",
    "heldout_game": f"{WP} SELECT game_id, play_id, {_r('home_wp', 'wpa')} FROM wx WHERE game_id = 35",
}
SQL["json_flatten"] = LOG + FEED_RAW + " SELECT game_id, half, posteam_id AS posteam_abb, summary, action_title, down0 AS down, down_desc, ytg AS yards_to_go, CASE WHEN syl = 7 THEN 0 ELSE syl END AS start_yard_line, home_team, away_team, 0 AS home_score, 'Unknown' AS stream_url FROM fr"
SQL["roster_flatten"] = 'SELECT DISTINCT length(Team) AS team_id, Team, "Player ID", Name, "Uniform Number", Position, Club FROM team_roster_old'
_CSV = "CAST(game_id AS {0}) AS game_id, CAST(play_id AS {0}) AS play_id"
SQL["scan_csv_all_string"] = f"{CHARTED} SELECT {_CSV.format('VARCHAR')}, CAST(down AS VARCHAR) AS DN, CAST(yards_to_go AS VARCHAR) AS DIST, res AS RESULT FROM bx"
SQL["scan_csv_typed"] = f"{CHARTED} SELECT {_CSV.format('BIGINT')}, CAST(down AS VARCHAR) AS DN, CAST(yards_to_go AS INTEGER) AS DIST, res AS RESULT FROM bx"
SQL["scan_csv_glob"] = f"{CHARTED} SELECT {_CSV.format('BIGINT')}, CAST(down AS BIGINT) AS DN, CASE WHEN game_id % 3 = 1 THEN CAST(yards_to_go AS BIGINT) END AS DIST, CASE WHEN game_id % 3 = 2 THEN res END AS RESULT FROM bx"
SQL["situation_counts_field"] = f"{CHARTED} SELECT down, yardline_50_simple, count(*) AS count, down || ' & ' || yardline_50_simple AS situation FROM bx GROUP BY 1, 2"
SQL["head_plays"] = f"{CHARTED} SELECT game_id, play_id, posteam, down, yards_to_go, play_type FROM bx ORDER BY game_id, play_id LIMIT 100"
_OTHERS = ("AS gap FROM px)", "AS gap FROM px WHERE game_id <> 35)")
SQL["heldout_game_ep"] = EP.replace(*_OTHERS) + f" SELECT game_id, play_id, {_r('ep', 'epa')} FROM sx WHERE game_id = 35"
_TRAIN = ("label", "yardline_50", "yards_to_go", "down0", "down1", "down2", "down3", "down4", "Total_W_Scaled")
_FRAME = FRAME.replace(*_OTHERS) + f", tr AS (SELECT game_id, play_id, label, yardline_50, yards_to_go, {', '.join(f'CASE WHEN down = {i} THEN 1 ELSE 0 END AS down{i}' for i in range(5))}, w AS Total_W_Scaled FROM ex)"
SQL["null_counts_frame"] = _FRAME + " " + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls FROM tr" for c in _TRAIN)
SQL["training_rows"] = _FRAME + f" SELECT game_id, play_id, {', '.join(_TRAIN[:-1])}, round(Total_W_Scaled, 6) AS Total_W_Scaled FROM tr WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in _TRAIN)
SQL["text_cast"] = f"{CLEAN} SELECT game_id, play_id, CAST(yards_to_go AS VARCHAR) AS yards_to_go, CAST(yards_to_go_after AS VARCHAR) AS yards_to_go_after FROM cp"
SQL["drop_cols"] = FEED + f" SELECT game_id, play_id, row_order AS index, {_capture(PASSER)} AS passer, {_capture('pass complete to ' + PERSON)} AS receiver FROM fx"
_PLAY_COLUMNS = "season competition_id competition_name competition_league gender game_id game_type game_group_id game_group half drive_id play_id half_end summary action_title down down_desc down_after down_after_desc yards_to_go yards_to_go_after yards_to_go_simple possession_time home_team away_team home_score away_score stream_url passer receiver rusher tackle_player interception_player sack_player play_result penalty safety play_type complete_pass interception touchdown point_after point_after_success def_touchdown one_point_conv_success two_point_conv_success defensive_two_point_conv scoring_play scoring_play_team posteam defteam posteam_after defteam_after yardline_50 yardline_50_after yards_gained first_down home_team_points away_team_points home_team_score away_team_score posteam_score defteam_score score_differential ep wp Winner".split()
SQL["null_counts"] = CLEAN + " " + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls FROM cp" for c in _PLAY_COLUMNS)
