"""Values that results depend on and that cannot be derived from the data.

Fixed values: labels, prefixes, patterns, prices and thresholds, kept together as plain text.
"""

# Slots below this number belong to the radiant side, the others to the dire side.
FIRST_DIRE_SLOT = 128
# Positions 1-5 of a fight's player list are radiant, the following ones dire.
PLAYERS_PER_SIDE = 5

RADIANT = "Radiant"
DIRE = "Dire"

# Id used by the data source for a hero it does not know.
UNKNOWN_HERO_ID = "0"
HERO_NAME_PREFIX = "npc_dota_hero_"

IMAGE_HOST = "https://cdn.cloudflare.steamstatic.com"
HERO_ICON_FOLDER = "https://cdn.cloudflare.steamstatic.com/apps/dota2/images/dota_react/heroes/icons/"

ATTRIBUTE_LABELS = {
    "agi": "Agility",
    "all": "Universal",
    "int": "Intelligence",
    "str": "Strength",
}

# (exclusive upper bound of the score difference, label); anything else is the last label.
SCORE_BUCKETS = [(5, "close"), (10, "moderate"), (20, "blowout")]
SCORE_BUCKET_REST = "rout"

# Fight phases by start minute.
PHASE_PREGAME = "pre-game"
PHASE_EARLY = "early (0-20m)"
PHASE_MID = "mid (20-40m)"
PHASE_LATE = "late (40m+)"

# Damage kinds that count as typed; key of plain attacks in the inflictor map.
DAMAGE_TYPES = ["Physical", "Magical", "Pure"]
PLAIN_ATTACK_KEY = "null"

# Unit categories in the order they are tried, with LIKE patterns.
UNIT_CATEGORIES = [
    ("Building", ["npc_dota_%tower%", "%_rax%", "%ancient%"]),
    ("Creep", ["npc_dota_creep%"]),
    ("Neutral", ["npc_dota_neutral%"]),
    ("Ward", ["%ward%"]),
]

# Support items: item name, output column, gold per piece.
SUPPORT_ITEMS = [
    ("ward_observer", "ward_observer_bought", 0),
    ("ward_sentry", "ward_sentry_bought", 50),
    ("dust", "dust_bought", 80),
    ("smoke_of_deceit", "smoke_bought", 50),
    ("gem", "gem_bought", 900),
]

# Talents.
TALENT_PREFIX = "special_bonus"
ATTRIBUTE_BONUS = "attribute_bonus"
ATTRIBUTE_BONUS_TALENT = "special_bonus_attributes"
ATTRIBUTE_BONUS_LABEL = "Attribute Bonus"
TALENT_TEMPLATE = r"^[+-]\s*\{s:[a-zA-Z0-9_]+\}\s*[%a-zA-Z]*\s*"

RUNE_NAMES = [
    "Double Damage",
    "Haste",
    "Illusion",
    "Invisibility",
    "Regeneration",
    "Bounty",
    "Wisdom",
    "Arcane",
    "Water",
    "Shield",
]

# League worklist: yearly finals are found by name, two ids the pattern misses are pinned.
YEARLY_FINAL_NAME = r"^The International (\d{4})$"
PINNED_LEAGUE_IDS = ["16899", "11625"]
WORKLIST_TIERS = ["premium", "professional"]

# Key fields tried in turn when appending to a resource array.
CANDIDATE_KEYS = ["name", "id", "hero_id", "account_id", "match_id", "leagueid", "team_id"]

# Bookkeeping field that a fetcher adds and the loader removes.
FETCH_STAMP = "timestamp_fetched"

# Calendar range of the date dimension.
CALENDAR_FIRST = "2000-01-01"
CALENDAR_LAST = "2050-12-31"

# Draft slots shown when no draft exists at all.
DEFAULT_DRAFT_SLOTS = 5

FRESHNESS_WARN_DAYS = 7
FRESHNESS_ERROR_DAYS = 30

# Declared checks: columns that are unique and never null, by table.
KEY_COLUMNS = [
    ("stg_leagues", "leagueid"),
    ("stg_teams", "team_id"),
    ("stg_players", "account_id"),
    ("stg_heroes", "hero_id"),
    ("stg_constants", "resource"),
    ("stg_hero_stats", "hero_id"),
    ("stg_matches", "match_id"),
    ("dim_hero", "hero_id"),
    ("dim_player", "account_id"),
    ("dim_team", "team_id"),
    ("dim_league", "leagueid"),
    ("dim_game_mode", "game_mode_id"),
    ("dim_lobby_type", "lobby_type_id"),
    ("dim_region", "region_id"),
    ("dim_date", "date"),
    ("dim_patch", "patch_id"),
    ("dim_item", "item_id"),
    ("dim_rune", "rune_key"),
    ("rune_lookup", "rune_key"),
    ("fact_matches", "match_id"),
    ("fact_hero_matchup_stats", "matchup_label"),
]

# Declared checks: columns that are never null, by table.
REQUIRED_COLUMNS = [
    ("rune_lookup", ["rune_name"]),
    ("stg_match_players", [
        "match_id",
        "player_slot",
    ]),
    ("stg_picks_bans", [
        "match_id",
        "order_no",
    ]),
    ("stg_teamfights", [
        "match_id",
        "teamfight_id",
    ]),
    ("stg_match_player_minute", [
        "match_id",
        "player_slot",
        "minute",
        "gold",
        "xp",
        "last_hits",
        "denies",
    ]),
    ("stg_match_player_skills", [
        "match_id",
        "player_slot",
        "upgrade_index",
        "ability_id",
    ]),
    ("stg_match_player_item_purchases", [
        "match_id",
        "player_slot",
        "purchase_index",
        "item_internal_name",
        "time_sec",
        "minute",
    ]),
    ("stg_match_player_kills", [
        "match_id",
        "player_slot",
        "kill_index",
        "victim_hero_name",
        "time_sec",
    ]),
    ("stg_match_player_runes", [
        "match_id",
        "player_slot",
        "rune_key",
        "rune_count",
    ]),
    ("stg_match_player_damage", [
        "match_id",
        "player_slot",
        "target_key",
        "damage_amount",
    ]),
    ("stg_match_player_damage_taken", [
        "match_id",
        "player_slot",
        "source_key",
        "damage_amount",
    ]),
    ("stg_match_player_damage_taken_type", [
        "match_id",
        "player_slot",
        "inflictor_key",
        "damage_type",
        "damage_amount",
    ]),
    ("dim_hero_role", [
        "hero_id",
        "role",
    ]),
    ("dim_date", [
        "day_of_month",
        "month",
        "year",
        "quarter",
    ]),
    ("dim_item", [
        "item_name",
    ]),
    ("fact_matches", [
        "start_date",
        "leagueid",
        "game_mode_id",
        "lobby_type_id",
        "score_bucket",
    ]),
    ("fact_team_matches", [
        "match_id",
        "side",
        "team_id",
    ]),
    ("fact_match_players", [
        "match_id",
        "side",
        "comp_sig",
    ]),
    ("fact_hero_matchups", [
        "match_id",
        "radiant_hero_id",
        "dire_hero_id",
        "matchup_label",
        "radiant_win",
    ]),
    ("fact_team_h2h", [
        "match_id",
        "team_a_id",
        "team_b_id",
        "team_a_name",
        "team_b_name",
        "team_a_win",
    ]),
    ("fact_hero_matchups_hero", [
        "match_id",
        "hero_id",
        "opponent_id",
        "hero_name",
        "opponent_name",
        "matchup_label",
        "hero_win",
    ]),
    ("fact_picks_bans", [
        "match_id",
    ]),
    ("fact_draft_sequence", [
        "match_id",
        "slot",
    ]),
    ("fact_teamfights", [
        "match_id",
        "teamfight_id",
        "fight_phase",
    ]),
    ("fact_teamfight_players", [
        "match_id",
        "teamfight_id",
        "player_slot",
    ]),
    ("fact_teamfight_ability_uses", [
        "match_id",
        "teamfight_id",
        "player_slot",
        "ability_name",
        "uses",
    ]),
    ("fact_phase_momentum", [
        "match_id",
        "team_number",
        "side",
        "fight_phase",
        "phase_ord",
        "gold_delta",
        "fights",
    ]),
    ("fact_match_player_minute", [
        "match_id",
        "player_slot",
        "side",
        "minute",
        "gold",
        "xp",
        "level",
        "last_hits",
        "denies",
    ]),
    ("fact_match_player_skills", [
        "match_id",
        "player_slot",
        "side",
        "upgrade_index",
        "ability_id",
        "ability_name",
        "is_talent",
        "minute",
        "learn_level",
    ]),
    ("fact_match_player_item_purchases", [
        "match_id",
        "player_slot",
        "side",
        "purchase_index",
        "item_internal_name",
        "time_sec",
        "minute",
        "item_name",
    ]),
    ("fact_match_player_runes", [
        "match_id",
        "player_slot",
        "rune_key",
        "rune_count",
    ]),
    ("fact_match_player_damage", [
        "match_id",
        "player_slot",
        "target_key",
        "damage_amount",
    ]),
    ("fact_match_player_damage_taken", [
        "match_id",
        "player_slot",
        "source_key",
        "damage_amount",
    ]),
    ("fact_match_team_minute", [
        "match_id",
        "side",
        "minute",
        "team_gold",
        "team_xp",
    ]),
    ("fact_hero_side", [
        "hero_id",
        "side",
        "hero_side_picks",
        "hero_side_wins",
        "hero_side_win_rate",
    ]),
    ("fact_hero_matchup_stats", [
        "matchup_games",
        "radiant_wins",
        "dire_wins",
        "radiant_win_rate",
        "dire_win_rate",
    ]),
]

# Declared checks: columns that are unique together.
GRAINS = [("fact_team_matches", ("match_id", "side"))]

# Declared checks: a table with a slot for each place of the longest draft, and the drafts.
DRAFT_GRIDS = [("fact_draft_sequence", "slot", "stg_picks_bans")]

# Declared checks: table, column, and the table and key it refers to.
REFERENCES = [
    ("dim_hero_role", "hero_id", "dim_hero", "hero_id"),
    ("fact_matches", "start_date", "dim_date", "date"),
    ("fact_matches", "leagueid", "dim_league", "leagueid"),
    ("fact_matches", "game_mode_id", "dim_game_mode", "game_mode_id"),
    ("fact_matches", "lobby_type_id", "dim_lobby_type", "lobby_type_id"),
    ("fact_matches", "region_id", "dim_region", "region_id"),
    ("fact_matches", "patch", "dim_patch", "patch_id"),
    ("fact_matches", "radiant_team_id", "dim_team", "team_id"),
    ("fact_matches", "dire_team_id", "dim_team", "team_id"),
    ("fact_team_matches", "match_id", "fact_matches", "match_id"),
    ("fact_team_matches", "team_id", "dim_team", "team_id"),
    ("fact_match_players", "match_id", "fact_matches", "match_id"),
    ("fact_match_players", "account_id", "dim_player", "account_id"),
    ("fact_match_players", "hero_id", "dim_hero", "hero_id"),
    ("fact_match_players", "item_0", "dim_item", "item_id"),
    ("fact_hero_matchups", "match_id", "fact_matches", "match_id"),
    ("fact_hero_matchups", "radiant_hero_id", "dim_hero", "hero_id"),
    ("fact_hero_matchups", "dire_hero_id", "dim_hero", "hero_id"),
    ("fact_team_h2h", "match_id", "fact_matches", "match_id"),
    ("fact_team_h2h", "team_a_id", "dim_team", "team_id"),
    ("fact_team_h2h", "team_b_id", "dim_team", "team_id"),
    ("fact_hero_matchups_hero", "match_id", "fact_matches", "match_id"),
    ("fact_hero_matchups_hero", "hero_id", "dim_hero", "hero_id"),
    ("fact_hero_matchups_hero", "opponent_id", "dim_hero", "hero_id"),
    ("fact_picks_bans", "match_id", "fact_matches", "match_id"),
    ("fact_picks_bans", "hero_id", "dim_hero", "hero_id"),
    ("fact_draft_sequence", "match_id", "fact_matches", "match_id"),
    ("fact_teamfights", "match_id", "fact_matches", "match_id"),
    ("fact_teamfight_players", "match_id", "fact_matches", "match_id"),
    ("fact_teamfight_players", "hero_id", "dim_hero", "hero_id"),
    ("fact_teamfight_players", "account_id", "dim_player", "account_id"),
    ("fact_teamfight_ability_uses", "match_id", "fact_matches", "match_id"),
    ("fact_teamfight_ability_uses", "hero_id", "dim_hero", "hero_id"),
    ("fact_teamfight_ability_uses", "account_id", "dim_player", "account_id"),
    ("fact_phase_momentum", "match_id", "fact_matches", "match_id"),
    ("fact_match_player_minute", "match_id", "fact_matches", "match_id"),
    ("fact_match_player_minute", "account_id", "dim_player", "account_id"),
    ("fact_match_player_minute", "hero_id", "dim_hero", "hero_id"),
    ("fact_match_player_skills", "match_id", "fact_matches", "match_id"),
    ("fact_match_player_skills", "account_id", "dim_player", "account_id"),
    ("fact_match_player_skills", "hero_id", "dim_hero", "hero_id"),
    ("fact_match_player_item_purchases", "match_id", "fact_matches", "match_id"),
    ("fact_match_player_item_purchases", "account_id", "dim_player", "account_id"),
    ("fact_match_player_item_purchases", "hero_id", "dim_hero", "hero_id"),
    ("fact_match_team_minute", "match_id", "fact_matches", "match_id"),
    ("fact_hero_side", "hero_id", "dim_hero", "hero_id"),
]

# Declared checks: tables with a side, and columns that count from 1.
SIDED_TABLES = [
    "fact_team_matches",
    "fact_match_players",
    "fact_phase_momentum",
    "fact_match_player_minute",
    "fact_match_player_skills",
    "fact_match_player_item_purchases",
    "fact_match_team_minute",
    "fact_hero_side",
]
NUMBERED_COLUMNS = [
    ("fact_draft_sequence", "dire_pick_seq"),
    ("fact_draft_sequence", "dire_ban_seq"),
    ("fact_draft_sequence", "radiant_pick_seq"),
    ("fact_draft_sequence", "radiant_ban_seq"),
]

# Declared checks: columns with a closed set of values.
ACCEPTED = [
    ("stg_matches", "winner", ("radiant", "dire", "draw")),
    ("stg_match_players", "team_number", ("0", "1")),
    ("fact_picks_bans", "team_number", ("0", "1")),
    ("fact_teamfights", "fight_phase", (PHASE_PREGAME, PHASE_EARLY, PHASE_MID, PHASE_LATE)),
]
