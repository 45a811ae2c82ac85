"""Career records and movement operators on hand-made panels."""

from pyspark.sql import functions as F

from tenurekit.operators import careers as C
from tenurekit.operators import movement as M

STATS = [
    # player, season, row_no, team, league, role, tier, country, games, win_rate, kda
    ("a", 6, 1, "T1", "LCK", "mid", "S", "South Korea", "10", "50%", "3.0"),
    ("a", 7, 1, "T2", "LPL", "Top", "A", "Korea", "38.5", "60%", "-"),
    ("a", 8, 1, "T2", "LPL", "mid", "A", "South Korea", "-", "40%", "5.0"),
    ("a", 8, 2, "T1", "LCK", "Top", "A", None, "2", None, "1.0"),
    ("b", 14, 1, None, None, None, None, None, None, None, None),
    ("c", 15, 1, "", "", "", "", "", "3", "13%", "2"),
]
SCHEMA = ("player string, season int, row_no long, team string, league string, role string, tier string, "
          "country string, games string, win_rate string, kda string")


def test_career_records(spark):
    df = spark.createDataFrame(STATS, SCHEMA)
    rec = {r.player_id: r.asDict() for r in C.career_records(df, latest_season=15).collect()}
    a = rec["a"]
    # role tie mid:2 vs Top:2 -> first seen wins (mid in S6)
    assert a["primary_role"] == "Mid"
    # league tie LCK:2 vs LPL:2 -> LCK first seen
    assert a["primary_league"] == "LCK" and a["primary_region"] == "LCK"
    assert a["nationality"] == "KR"
    assert a["career_length_years"] == 3.0 and a["career_length_months"] == 36
    assert a["num_seasons_active"] == 3 and a["num_teams"] == 2 and a["num_regions"] == 2
    assert a["total_games"] == 12            # '38.5' and '-' are skipped
    assert abs(a["avg_winrate"] - 0.5) < 1e-12
    assert abs(a["avg_kda"] - 3.0) < 1e-12
    # modal tier A (3 of 4) -> starting tier 2; ever tier 1 -> promoted
    assert a["starting_tier"] == 2 and a["promoted_tier2_to_tier1"] is True
    assert a["time_to_tier1_months"] == 12.0 and a["peak_tier"] == 1
    assert a["current_status"] == "Retired" and a["career_start_year"] == 2016
    b, c = rec["b"], rec["c"]
    assert b["current_status"] == "Inactive" and c["current_status"] == "Active"
    assert b["num_teams"] == 1 and b["num_regions"] == 1 and b["primary_league"] == "Unknown"
    assert b["primary_role"] == "Unknown" and b["nationality"] == "Unknown" and b["total_games"] == 0
    assert b["avg_winrate"] is None
    # '' counts as a team; blank league gives no region -> 1
    assert c["num_teams"] == 1 and c["num_regions"] == 1
    assert abs(c["avg_winrate"] - 0.13) < 1e-12


def test_model_frame_first_known(spark):
    rows = [("p", 7, 1, "", "Mid, Top", "5"), ("p", 8, 1, "LCK", "Jungle", "-"), ("p", 15, 1, "LPL", "Top", "2")]
    df = spark.createDataFrame(rows, "player string, season int, row_no long, league string, role string, games string")
    r = C.model_frame(df, max_season=15).collect()[0]
    assert (r.League, r.Role, r.Debut, r.Early_Era, r.Observed, r.Career_Seasons, r.Total_Games) == \
        ("LCK", "Mid", 7, 1, 0, 3, 7)


def test_careers_from_stints(spark):
    df = spark.createDataFrame([("x", "2019-01-01", "2019-03-01"), ("x", "2018-05-01", "2019-02-01")],
                               "player_title string, start string, end string")
    r = C.careers_from_stints(df).collect()[0]
    assert r.stints_count == 2 and r.career_days == float((__import__("datetime").date(2019, 3, 1)
                                                           - __import__("datetime").date(2018, 5, 1)).days)


APP = [
    # player, season, team, date, tier, league, enc
    ("p1", 9, "A", "2019-01-01", "A", "LCK", 1),
    ("p1", 9, "B", "2019-06-01", "S", "LCK", 2),       # promotion within a league
    ("p2", 9, "A", "2019-01-01", "S", "LEC", 1),
    ("p2", 9, "C", "2019-05-01", "S", "LCS", 2),       # transfer
    ("p3", 9, "A", "2019-01-01", "?", "LCK", 1),
    ("p3", 9, "B", "2019-02-01", "A", "LCK", 2),       # one known tier -> roster
    ("p4", 9, "A", "2019-01-01", "A", "LCK", 1),
    ("p4", 9, "A", "2019-03-01", "S", "LCK", 2),       # same team -> ''
    ("p5", 9, "B", "2019-07-01", "B", "LCK", 1),       # dates out of encounter order
    ("p5", 9, "C", "2019-02-01", "A", "LCK", 2),       # relegation A -> B by date
]


def test_detect_moves(spark):
    df = spark.createDataFrame(APP, "player string, season int, team string, date string, tier string, "
                                    "league string, enc long")
    got = {r.player: r.MidSeasonMove for r in M.detect_moves(df).collect()}
    assert got == {"p1": "Promotion", "p2": "Transfer", "p3": "Roster", "p4": "", "p5": "Relegation"}


def test_best_tier_and_all_teams(spark):
    df = spark.createDataFrame([(r[0], r[1], r[2], r[5], "Mid", r[4], r[6]) for r in APP],
                               "player string, season int, team string, league string, role string, tier string, enc long")
    got = {r.player: (r.Team, r.Tier, r.AllTeams) for r in M.best_tier_record(df).collect()}
    assert got["p1"] == ("B", "S", "A → B")
    assert got["p2"] == ("A", "S", "A → C")   # tie on tier: first encountered
    assert got["p4"] == ("A", "S", "A")


def test_tier_changes(spark):
    rows = [("p", 6, 1, "B"), ("p", 7, 1, "Z"), ("p", 8, 1, "A"), ("p", 8, 2, "C"), ("p", 9, 1, "C"), ("q", 6, 1, None)]
    df = spark.createDataFrame(rows, "player string, season int, row_no long, tier string")
    got = {(r.season, r.row_no): r.SeasonTierChange for r in M.tier_changes(df).collect() if r.player == "p"}
    # season 8's tier is its last row (C); 7 has no valid tier and is skipped
    assert got == {(6, 1): "", (7, 1): "", (8, 1): "Promoted", (8, 2): "Relegated", (9, 1): "Stable"}


def test_dedupe_first(spark):
    df = spark.createDataFrame([("p", "T", 9, "2019-02-01", 2), ("p", "T", 9, "2019-01-01", 5)],
                               "player string, team string, season int, date string, row_no long")
    r = M.dedupe_first(df, ["player", "team", "season"], ["date", "row_no"]).collect()
    assert len(r) == 1 and r[0].row_no == 5


def test_append_unseen_and_reorder(spark):
    from tenurekit.functions import clean
    df = spark.createDataFrame([("A → B", ["B", "C", "A", "D"]), ("", ["X"]), (None, ["Y", "Y"])],
                               "txt string, new array<string>")
    got = [r.v for r in df.select(clean.append_unseen("txt", F.col("new")).alias("v")).collect()]
    assert got == [["A", "B", "C", "D"], ["X"], ["Y"]]
    assert clean.reorder_columns(["a", "b", "c", "d"], ["c", "x", "a"]) == ["c", "a", "b", "d"]


def test_validate_requests(spark):
    from tenurekit.operators.score import validate
    ok = spark.createDataFrame([("lck", "mid", 7), ("XX", "Top", 16), ("LEC", "coach", None)],
                               "league string, role string, debut int")
    got = [(r.league_v, r.role_v, len(r.errors)) for r in validate(ok).collect()]
    assert got == [("LCK", "Mid", 0), ("XX", "Top", 2), ("LEC", "Coach", 2)]
    txt = spark.createDataFrame([("LCK", "Mid", "7")], "league string, role string, debut string")
    assert validate(txt).collect()[0].errors == ["'debut' must be an integer between 6 and 15"]
