"""The match-data view of the driver tables in SQL, flattened directly.

Used only to check results: each common table expression gives the rows a silver model must
produce from the documents.
"""

from __future__ import annotations

from arenamart.plans.catalogue.support import rounded

LOADED = "'2024-06-01 00:00:00'"
SIDE = "CASE WHEN ln % 2 = 1 THEN 'Radiant' ELSE 'Dire' END"
SLOT = "CAST(CASE WHEN ln % 2 = 1 THEN (ln - 1) // 2 ELSE 128 + (ln - 2) // 2 END AS VARCHAR)"
ACCOUNT = "CASE WHEN (ok + ln) % 10 <> 0 THEN CAST(pmin AS VARCHAR) END"
HERO = "CAST(pmax % 131 AS VARCHAR)"
WHO = (
    f"CAST(ok AS VARCHAR) AS match_id, {SLOT} AS player_slot, {ACCOUNT} AS account_id,"
    f" {HERO} AS hero_id, {SIDE} AS side"
)


def unit(x: str) -> str:
    return (
        f"CASE {x} % 7 WHEN 0 THEN 'npc_dota_hero_' || ({x} % 131)"
        " WHEN 1 THEN 'npc_dota_goodguys_tower1_mid' WHEN 2 THEN 'badguys_melee_rax_bot'"
        " WHEN 3 THEN 'npc_dota_creep_goodguys_melee' WHEN 4 THEN 'npc_dota_neutral_kobold'"
        " WHEN 5 THEN 'observer_ward' ELSE 'illusion_of_someone' END"
    )


def summed(name: str, key: str, amount: str, key_name: str, value_name: str) -> str:
    return f"""
{name} AS (
  SELECT {WHO}, k AS {key_name}, v AS {value_name}
  FROM (SELECT l_orderkey AS ok, l_linenumber AS ln, {key} AS k,
               CAST(sum({amount}) AS BIGINT) AS v FROM lineitem GROUP BY ALL)
  JOIN lines USING (ok, ln) WHERE v > 0)"""


def log(name: str, key: str, index: str, key_name: str) -> str:
    return f"""
{name} AS (
  SELECT {WHO}, pos AS {index}, k AS {key_name}, t AS time_sec,
         greatest(CAST(floor(t / 60.0) AS BIGINT), 0) AS minute
  FROM (SELECT event_id // 20 AS ok, event_id % 20 % 7 + 1 AS ln, {key} AS k,
               CASE WHEN floor(value) % 8 <> 0 THEN CAST(floor(value * 10) AS BIGINT) - 60 END AS t,
               row_number() OVER (PARTITION BY event_id // 20, event_id % 20 % 7
                                  ORDER BY event_id) - 1 AS pos FROM events)
  JOIN lines USING (ok, ln) WHERE k IS NOT NULL AND t IS NOT NULL)"""


BOUGHT = (
    "CASE WHEN floor(value) % 9 = 0 THEN NULL WHEN event_id % 17 = 0 THEN 'gem'"
    " ELSE CASE event_type WHEN 'click' THEN 'ward_observer' WHEN 'view' THEN 'ward_sentry'"
    " WHEN 'purchase' THEN 'dust' WHEN 'signup' THEN 'smoke_of_deceit'"
    " ELSE 'item_' || (event_id % 60) END END"
)
KILLED = "CASE WHEN floor(value) % 6 <> 0 THEN 'npc_dota_hero_' || (user_id % 131) END"
INFLICTOR = (
    "CASE l_partkey % 5 WHEN 0 THEN 'null' WHEN 1 THEN 'spell_' || (l_partkey % 40)"
    " WHEN 2 THEN 'item_' || (l_partkey % 60) WHEN 3 THEN 'odd_thing'"
    " ELSE 'spell_' || (l_suppkey % 40) END"
)
DAMAGE_KIND = "CASE id % 4 WHEN 0 THEN 'Magical' WHEN 1 THEN 'Pure' WHEN 2 THEN 'Physical' END"

TEXT = "CAST({0} AS VARCHAR) AS {1}"


def texts(pairs: str) -> str:
    return ", ".join(TEXT.format(*reversed(p.split("="))) for p in pairs.split(";"))


PLAYER_COLUMNS = f"""{WHO.replace(f", {SIDE} AS side", "")},
    CASE WHEN ok % 29 = 0 AND ln = 3 THEN NULL ELSE CAST(1 - ln % 2 AS VARCHAR) END AS team_number,
    CASE WHEN ok % 29 = 0 AND ln = 3 THEN NULL
         WHEN ln % 2 = 1 THEN m.radiant_win ELSE NOT m.radiant_win END AS team_win,
    qty % 20 AS kills, CASE WHEN smin % 13 <> 0 THEN CAST(ln - 1 AS BIGINT) END AS deaths,
    pmax % 25 AS assists,
    price % 5000 AS gold, price % 20000 AS gold_spent, price % 30000 AS net_worth,
    price % 900 AS gold_per_min, price % 800 AS xp_per_min, price % 40000 AS hero_damage,
    CASE WHEN qty % 3 <> 0 THEN price % 3000 END AS hero_healing,
    price % 7000 AS tower_damage, qty % 5 AS tower_kills, CAST(disc * 100 AS BIGINT) AS stuns100,
    price % 400 AS last_hits, price % 40 AS denies,
    CASE WHEN qty % 3 <> 0 THEN qty % 6 END AS camps_stacked, qty % 7 AS creeps_stacked,
    price % 100 AS neutral_kills, qty % 9 AS rune_pickups,
    CASE WHEN ln % 3 = 0 THEN qty % 4 WHEN qty % 2 = 1 THEN qty % 8 ELSE 0 END AS obs_placed,
    qty % 6 AS sen_placed, qty % 3 AS observer_kills, qty % 2 AS sentry_kills,
    qty % 4 AS purchase_ward_observer, qty % 5 AS purchase_ward_sentry,
    CASE WHEN smin % 7 <> 0 THEN 'P' || smin END AS personaname,
    CASE WHEN qty % 11 <> 0 THEN CAST(1 + price % 30 AS VARCHAR) END AS level,
    {texts("item_0=pmin % 260;item_1=(pmin + 37) % 260;item_2=(pmin + 74) % 260")},
    {texts("item_3=(pmin + 111) % 260;item_4=(pmin + 148) % 260;item_5=(pmin + 185) % 260")},
    {texts("item_neutral=pmax % 260")},
    CASE WHEN qty % 2 <> 0 THEN CAST(pmax % 50 AS VARCHAR) END AS backpack_0,
    {texts("backpack_1=pmax % 51;backpack_2=pmax % 52")}, CAST(NULL AS VARCHAR) AS backpack_3,
    {texts("leaver_status=qty % 2")}, qty % 2 = 0 AS randomed,
    CAST(ln = 1 AS BIGINT) AS firstblood_claimed, qty % 4 AS buyback_count"""

PRELUDE = f"""WITH
lines AS (
  SELECT l_orderkey AS ok, l_linenumber AS ln, count(*) AS n, min(l_partkey) AS pmin,
         max(l_partkey) AS pmax, min(l_suppkey) AS smin, max(l_suppkey) AS smax,
         CAST(sum(floor(l_quantity)) AS BIGINT) AS qty,
         CAST(sum(floor(l_extendedprice)) AS BIGINT) AS price,
         sum(CAST(l_discount AS DECIMAL(12,2))) AS disc
  FROM lineitem GROUP BY ALL),
s_matches AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS match_id,
    CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS radiant_win,
    CASE o_orderstatus WHEN 'F' THEN 'radiant' WHEN 'O' THEN 'dire' ELSE 'draw' END AS winner,
    CAST(floor(o_totalprice) AS BIGINT) % 5400 AS duration_sec,
    substr(o_orderpriority, 1, 1) AS game_mode,
    {texts("lobby_type=o_orderkey % 16;region=o_custkey % 5;patch=year(o_orderdate) - 1975")},
    strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS start_time,
    CASE WHEN o_orderkey % 17 <> 0 THEN CAST(floor(o_totalprice) AS BIGINT) % 50 END
      AS radiant_score,
    o_custkey % 50 AS dire_score,
    CASE WHEN o_custkey % 11 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS radiant_team_id,
    CASE WHEN o_orderkey % 13 <> 0
         THEN CAST((7 * o_custkey + o_orderkey) % 120 AS VARCHAR) END AS dire_team_id,
    o_custkey % 11 <> 0 AS has_radiant_team, o_orderkey % 13 <> 0 AS has_dire_team,
    {texts("leagueid=o_custkey % 27")},
    CAST(floor(o_totalprice) AS BIGINT) % 300 AS first_blood_time,
    CAST(10 AS BIGINT) AS human_players,
    CASE WHEN o_orderkey % 23 <> 0 THEN CAST(90 AS BIGINT) END AS pre_game_duration,
    {texts("replay_salt=o_orderkey * 31 % 1000;version=21")}, {LOADED} AS loaded_at
  FROM orders),
players0 AS (
  SELECT {PLAYER_COLUMNS}, {LOADED} AS loaded_at
  FROM lines JOIN s_matches m ON m.match_id = CAST(ok AS VARCHAR)),
s_players AS (
  SELECT *, CASE WHEN deaths > 0
                 THEN (2 * 100 * (kills + assists) + deaths) // (2 * deaths)
                 ELSE 100 * (kills + assists) END AS kda100
  FROM players0),
s_picks AS (
  SELECT CAST(ok AS VARCHAR) AS match_id, CAST(o AS VARCHAR) AS order_no, CAST(o AS BIGINT) AS order_no_int,
         CAST(h AS VARCHAR) AS hero_id, is_pick, team_number,
         CASE team_number WHEN '0' THEN 'Radiant' WHEN '1' THEN 'Dire' END AS active_team,
         CASE WHEN is_pick THEN {SLOT} END AS player_slot, {LOADED} AS loaded_at
  FROM (SELECT *, CASE WHEN is_pick THEN 2 * ln - 1 ELSE 2 * ln - 2 END AS o,
               CASE WHEN is_pick THEN pmax % 131 ELSE (pmin + ln) % 131 END AS h,
               CASE WHEN smax % 41 <> 0 THEN CAST(1 - ln % 2 AS VARCHAR) END AS team_number
        FROM (SELECT *, unnest([true, false]) AS is_pick FROM lines))
  WHERE ok % 37 <> 0),
members AS (
  SELECT l_orderkey AS ok, l_returnflag AS flag, l_linenumber AS ln, count(*) AS n,
         CAST(sum(l_partkey) AS BIGINT) AS parts, CAST(sum(l_suppkey) AS BIGINT) AS supps,
         CAST(sum(floor(l_extendedprice)) AS BIGINT) AS price
  FROM lineitem GROUP BY ALL),
fights0 AS (
  SELECT ok, flag, min(price) AS low, CAST(sum(n) AS BIGINT) AS lines,
         row_number() OVER (PARTITION BY ok ORDER BY flag) AS tf,
         to_json(list({{
           'damage': price % 900, 'healing': price % 70, 'deaths': n % 3, 'buybacks': n % 2,
           'xp_start': price % 3000, 'xp_end': price % 3000 + 10, 'xp_delta': supps % 300 - 100,
           'gold_delta': parts % 500 - 250,
           'ability_uses': MAP {{'spell_' || (parts % 40): CAST(ln AS BIGINT), 'spell_common': n}},
           'item_uses': MAP {{'item_used': n}}, 'ability_targets': CAST(NULL AS VARCHAR),
           'killed': CAST(NULL AS VARCHAR), 'deaths_pos': CAST(NULL AS VARCHAR)}} ORDER BY ln))
           AS players
  FROM members GROUP BY ok, flag),
s_fights AS (
  SELECT ok, flag, CAST(ok AS VARCHAR) AS match_id, CAST(tf AS VARCHAR) AS teamfight_id, s AS start_time,
         s + 30 + lines AS end_time, s + 20 AS last_death, lines AS deaths,
         CASE WHEN s IS NOT NULL THEN 30 + lines END AS duration_sec,
         CAST(players AS VARCHAR) AS players, {LOADED} AS loaded_at
  FROM (SELECT *, CASE WHEN (ok + lines) % 19 <> 0 THEN low % 3100 - 60 END AS s FROM fights0)),
f_members AS (
  SELECT f.*, m.* EXCLUDE (ok, flag), pos,
         CASE WHEN pos <= 5 THEN '0' ELSE '1' END AS team_number,
         CAST(CASE WHEN pos <= 5 THEN pos - 1 ELSE 122 + pos END AS VARCHAR) AS player_slot,
         CASE WHEN start_time < 0 THEN 'pre-game' WHEN start_time < 1200 THEN 'early (0-20m)'
              WHEN start_time < 2400 THEN 'mid (20-40m)' ELSE 'late (40m+)' END AS fight_phase
  FROM (SELECT *, row_number() OVER (PARTITION BY ok, flag ORDER BY ln) AS pos FROM members) m
  JOIN s_fights f USING (ok, flag)),
s_minutes AS (
  SELECT {WHO}, CAST(i * 60 AS DOUBLE) AS time_sec, i AS minute,
         CAST(floor(1000 * abs(CAST(embedding[i + 1] AS DOUBLE))) AS BIGINT) AS gold,
         i * 600 AS xp, i * 3 AS last_hits, i AS denies
  FROM (SELECT vec_id AS ok, label % 7 + 1 AS ln, embedding, unnest(range(len(embedding))) AS i
        FROM embeddings WHERE vec_id % 5 <> 0)
  JOIN lines USING (ok, ln) JOIN orders ON o_orderkey = ok),
s_upgrades AS (
  SELECT {WHO}, i AS upgrade_index, CAST((pmin * 3 + i * 7) % 300 AS VARCHAR) AS ability_id
  FROM (SELECT *, unnest(range(ln + 1)) AS i FROM lines)),
{log("s_bought", BOUGHT, "purchase_index", "item_internal_name").strip()},
{log("s_kills", KILLED, "kill_index", "victim_hero_name").strip()},
{summed("s_runes", "CAST(floor(l_quantity) AS BIGINT) % 12", "floor(l_quantity) % 12 % 5",
        "rune_key", "rune_count").strip()},
{summed("s_damage", unit("l_partkey"), "floor(l_extendedprice) % 1000", "target_key",
        "damage_amount").strip()},
{summed("s_taken", unit("l_suppkey"), "floor(l_quantity) - 1", "source_key",
        "damage_amount").strip()},
{summed("s_inflicted", INFLICTOR, "floor(l_extendedprice) % 700", "inflictor_key",
        "damage_amount").strip()},
c_heroes AS (
  SELECT CAST(1 + p_partkey % 127 AS VARCHAR) AS hero_id, min(p_name) AS localized_name,
         min(p_type) AS attack_type, min(p_brand) AS low, max(p_brand) AS high, count(*) AS n,
         CAST(sum(p_size) AS BIGINT) AS size
  FROM part GROUP BY 1),
s_heroes AS (
  SELECT hero_id, CASE WHEN CAST(hero_id AS INT) % 50 <> 7 THEN 'npc_dota_hero_' || hero_id END
           AS hero_name, localized_name,
         CASE CAST(hero_id AS INT) % 5 WHEN 0 THEN 'agi' WHEN 1 THEN 'all' WHEN 2 THEN 'int'
              WHEN 3 THEN 'str' ELSE 'odd' END AS primary_attr,
         attack_type, '["' || low || '","' || high || '"]' AS roles,
         '/heroes/' || hero_id || '.png?' AS img, low, high
  FROM c_heroes),
s_hero_stats AS (
  SELECT hero_id, n AS pro_pick, n // 2 AS pro_win, size % 50 AS pro_ban, pub_pick, pub_win,
         {rounded("100 * pub_win", "pub_pick", 2)} AS pub_win_rate
  FROM (SELECT *, CASE WHEN CAST(hero_id AS INT) % 9 = 0 THEN 0 ELSE size END AS pub_pick,
               size // 3 AS pub_win FROM c_heroes)),
h_names AS (
  SELECT hero_id, coalesce(hero_name, 'unknown') AS hero_name,
         localized_name AS hero_localized_name,
         'https://cdn.cloudflare.steamstatic.com/heroes/' || hero_id || '.png' AS img
  FROM s_heroes UNION ALL SELECT '0', 'unknown', 'Unknown', NULL),
c_items AS (
  SELECT 'item_' || id AS k, CASE WHEN id % 7 <> 0 THEN 'Item ' || nm END AS dname,
         CASE WHEN id % 5 <> 0 THEN '/items/' || id || '.png' END AS img, {DAMAGE_KIND} AS kind
  FROM (SELECT p_partkey % 60 AS id, min(p_name) AS nm FROM part GROUP BY 1)),
d_item AS (
  SELECT CAST(id AS VARCHAR) AS item_id, 'item_' || id AS item_internal_name,
         coalesce(dname, 'item_' || id) AS item_name,
         CASE WHEN dname IS NOT NULL
              THEN 'https://cdn.cloudflare.steamstatic.com' || i.img END AS img
  FROM (SELECT DISTINCT p_partkey % 250 AS id FROM part) LEFT JOIN c_items i ON k = 'item_' || id),
c_abilities AS (
  SELECT CASE WHEN id % 10 = 0 THEN 'special_bonus_unique_' || id WHEN id < 40
              THEN 'spell_' || id ELSE 'rest_' || id END AS k,
         CASE WHEN id = 5 THEN NULL WHEN id = 6 THEN ''
              WHEN id % 20 = 0 THEN '-{{s:bonus_value}} Gain ' || id
              WHEN id % 10 = 0 THEN '+{{s:bonus_value}}% Gain ' || id
              ELSE 'Spell ' || id END AS dname,
         CASE WHEN id % 3 <> 0 THEN '/abilities/' || id || '.png' END AS img, {DAMAGE_KIND} AS kind
  FROM (SELECT DISTINCT p_partkey % 280 AS id FROM part)),
c_ability_ids AS (
  SELECT CAST(id AS VARCHAR) AS ability_id,
         CASE id % 10 WHEN 0 THEN 'special_bonus_unique_' || id WHEN 1 THEN 'attribute_bonus'
              WHEN 2 THEN '' WHEN 3 THEN 'special_bonus_attributes'
              ELSE 'sp_ell_' || (id % 40) END AS internal
  FROM (SELECT DISTINCT p_partkey % 280 AS id FROM part)),
s_inflicted_type AS (
  SELECT s.* EXCLUDE (damage_amount),
         CASE WHEN inflictor_key = 'null' THEN 'Physical'
              ELSE coalesce(a.kind, i.kind, 'Other') END AS damage_type, damage_amount
  FROM s_inflicted s LEFT JOIN c_abilities a ON a.k = inflictor_key
  LEFT JOIN c_items i ON i.k = inflictor_key),
s_teams AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS team_id,
         CASE s_suppkey % 4 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE lower(s_name) END AS team_name,
         CASE s_suppkey % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 't' || s_suppkey END AS team_tag,
         CAST(CAST(s_acctbal AS DECIMAL(12,2)) AS DOUBLE) AS rating,
         CAST(s_nationkey AS BIGINT) AS wins,
         CASE WHEN s_suppkey % 6 <> 0 THEN CAST(s_nationkey + 1 AS BIGINT) END AS losses,
         'logo/' || s_suppkey AS logo_url
  FROM supplier),
s_pros AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS account_id, s_name AS player_name,
         CASE WHEN s_suppkey % 3 <> 0 THEN '80' END AS rank_tier,
         CAST(s_nationkey AS VARCHAR) AS team_id, 'avatar/' || s_suppkey AS avatar_medium
  FROM supplier),
t_sides AS (
  SELECT match_id, leagueid, radiant_win, u.*
  FROM (SELECT *, unnest([
      {{'side': 'Radiant', 'team_id': radiant_team_id, 'team_win': radiant_win,
        'team_score': radiant_score, 'opponent_score': dire_score}},
      {{'side': 'Dire', 'team_id': dire_team_id, 'team_win': NOT radiant_win,
        'team_score': dire_score, 'opponent_score': radiant_score}}]) AS u FROM s_matches)
  WHERE u.team_id IS NOT NULL),
t_names AS (
  SELECT team_id, coalesce(nullif(upper(team_name), ''), nullif(upper(team_tag), ''),
                           'TEAM ' || team_id) AS team_name, team_tag, rating, wins, losses, logo_url
  FROM s_teams
  UNION ALL BY NAME
  SELECT DISTINCT team_id, 'UNKNOWN' AS team_name FROM t_sides
  WHERE team_id NOT IN (SELECT team_id FROM s_teams)),
p_names AS (
  SELECT *, 'Pro' AS player_type FROM s_pros
  UNION ALL BY NAME
  SELECT account_id, arg_max(coalesce(personaname, '~none'), (match_id, player_slot)) AS shown,
         'Match Participant' AS player_type
  FROM s_players WHERE account_id NOT IN (SELECT account_id FROM s_pros) GROUP BY account_id),
people AS (
  SELECT account_id, coalesce(player_name, nullif(shown, '~none')) AS player_name, rank_tier,
         team_id, avatar_medium, player_type FROM p_names),
mom AS (
  SELECT ok, team_number, fight_phase, CAST(sum(parts % 500 - 250) AS BIGINT) AS gold_delta,
         CAST(sum(supps % 300 - 100) AS BIGINT) AS xp_delta,
         CAST(sum(n % 3) AS BIGINT) AS deaths, count(DISTINCT flag) AS fights
  FROM f_members WHERE fight_phase <> 'pre-game' GROUP BY ALL),
uses AS (
  SELECT match_id, teamfight_id, player_slot, u.*
  FROM (SELECT *, unnest([{{'ability_name': 'spell_' || (parts % 40), 'uses': CAST(ln AS BIGINT)}},
                          {{'ability_name': 'spell_common', 'uses': n}}]) AS u FROM f_members))
"""


def oracle(sql: str) -> str:
    return PRELUDE + sql
