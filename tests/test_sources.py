"""File sources: season CSVs (A1), sheet folders (A2), rule CSV (A3)."""

import os

from pyspark.sql import functions as F

from tenurekit.operators.careers import career_records
from tenurekit.operators.rules import assign_tier_region, load_league_rules
from tenurekit.sources import landing as L
from tenurekit.streaming.incremental import scratch_dir

HEADER = ",".join(L.SEASON_STAT_COLUMNS + L.ENRICHED_EXTRA)


def _line(player, games, wr, team, league, role, tier, country=""):
    vals = {c: "" for c in L.SEASON_STAT_COLUMNS + L.ENRICHED_EXTRA}
    vals.update({"Player": player, "Games": games, "Win rate": wr, "KDA": "3.0", "Team": team,
                 "League": league, "Role": role, "Tier": tier, "Country": country})
    return ",".join(vals[c] for c in L.SEASON_STAT_COLUMNS + L.ENRICHED_EXTRA)


def test_season_csvs(spark):
    d = scratch_dir(spark, "t-csv")
    os.makedirs(d)
    with open(os.path.join(d, "player_careers_S6.csv"), "w") as f:
        f.write(HEADER + "\n" + _line("113", "10", "50%", "T1", "LCK", "Mid", "S", "Korea") + "\n"
                + _line("Zed", "-", "13%", "T2", "LEC", "Top", "A") + "\n")
    with open(os.path.join(d, "player_careers_S8.csv"), "w") as f:
        f.write(HEADER + "\n" + _line("113", "38.5", "17.40%", "T3", "LCK", "Mid", "S") + "\n")
    paths = L.season_files(spark, d)
    assert [os.path.basename(p) for p in paths] == ["player_careers_S6.csv", "player_careers_S8.csv"]
    df = L.load_season_csvs(spark, paths)
    assert sorted(r.season for r in df.select("season").collect()) == [6, 6, 8]
    assert dict(df.dtypes)["Player"] == "string"          # '113' stays text
    rec = {r.player_id: r for r in career_records(
        df, entity="Player", team="Team", league="League", role="Role", tier="Tier", country="Country",
        games="Games", win_rate="Win rate", kda="KDA", row_order="_line", latest_season=15).collect()}
    assert rec["113"].career_length_years == 3.0 and rec["113"].num_seasons_active == 2
    assert rec["113"].total_games == 10 and rec["113"].num_teams == 2
    assert abs(rec["113"].avg_winrate - (0.5 + 0.174) / 2) < 1e-12
    assert rec["Zed"].total_games == 0 and rec["Zed"].nationality == "Unknown"


def test_sheet_dirs_and_rules_csv(spark):
    d = scratch_dir(spark, "t-sheets")
    for name in ["S6", "S7", "Notes", "player careers"]:
        os.makedirs(os.path.join(d, name))
    header = ",".join(L.SEASON_STAT_COLUMNS)
    for name, player in [("S6", "a"), ("S7", "b")]:
        with open(os.path.join(d, name, "part.csv"), "w") as f:
            f.write(header + "\n" + player + "," * (len(L.SEASON_STAT_COLUMNS) - 1) + "\n")
    with open(os.path.join(d, "player careers", "part.csv"), "w") as f:
        f.write("Player,Team\nb,T9\n")
    seasons, enr = L.load_sheet_dirs(spark, d)
    assert sorted((r.Player, r.season) for r in seasons.select("Player", "season").collect()) == [("a", 6), ("b", 7)]
    assert enr.count() == 1
    rules_path = os.path.join(d, "rules.csv")
    with open(rules_path, "w") as f:
        f.write("league_pattern,match_mode,tier,region\nLEC,exact,1,EU\nAcademy,,x,NA\n__DEFAULT__,default,2,Unknown\n")
    rules = load_league_rules(spark, rules_path)
    assert {(r.league_pattern, r.match_mode, r.tier) for r in rules.collect()} == {
        ("LEC", "exact", 1), ("Academy", "contains", 2), ("__DEFAULT__", "default", 2)}
    df = spark.createDataFrame([("LEC",), ("NA Academy",), ("Other",)], "league string")
    got = {r.league: (r.tier, r.region_m) for r in assign_tier_region(df, "league", rules).collect()}
    assert got == {"LEC": (1, "EU"), "NA Academy": (2, "NA"), "Other": (2, "Unknown")}
