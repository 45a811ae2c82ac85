"""End-to-end check on the one published golden pair: the 44-row roster
fixture and its published promotion summary (rule table as in FIXTURES.md)."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenurekit.operators import cohort
from tenurekit.operators.panel import build_longitudinal
from tenurekit.operators.rules import rules_frame
from tenurekit.sources.landing import ROSTER_SCHEMA

# The 44-row roster panel (player, team, role, league, year, split) in file
# order; is_starter is always blank.
ROSTER = [
    ('RiftStriker', 'AcadA', 'Mid', 'NA Academy', 2019, 'Spring'),
    ('RiftStriker', 'AcadA', 'Mid', 'NA Academy', 2020, 'Summer'),
    ('VoidRunner', 'AcadB', 'Jungle', 'NA Academy', 2019, 'Spring'),
    ('VoidRunner', 'AcadB', 'Jungle', 'NA Academy', 2021, 'Summer'),
    ('TideCaller', 'AcadC', 'Top', 'NA Academy', 2020, 'Spring'),
    ('TideCaller', 'AcadC', 'Top', 'NA Academy', 2022, 'Summer'),
    ('SteelBloom', 'AcadD', 'Support', 'Academy League', 2018, 'Spring'),
    ('SteelBloom', 'AcadD', 'Support', 'Academy League', 2023, 'Summer'),
    ('NovaDrift', 'AcadE', 'Bot', 'NA Academy', 2021, 'Spring'),
    ('EmberVeil', 'LFL1', 'Mid', 'LFL', 2020, 'Spring'),
    ('EmberVeil', 'LFL1', 'Mid', 'LFL', 2021, 'Summer'),
    ('FrostJaunt', 'PL1', 'Jungle', 'Prime League', 2019, 'Spring'),
    ('FrostJaunt', 'PL1', 'Jungle', 'Prime League', 2022, 'Summer'),
    ('ZenithLine', 'EM1', 'Top', 'EU Masters', 2017, 'Spring'),
    ('ZenithLine', 'EM1', 'Top', 'EU Masters', 2018, 'Summer'),
    ('CloudRazor', 'LDL1', 'Mid', 'LDL', 2019, 'Spring'),
    ('CloudRazor', 'LDL1', 'Mid', 'LDL', 2020, 'Summer'),
    ('MistWalker', 'CK1', 'Support', 'Challengers Korea', 2020, 'Spring'),
    ('SandFox', 'LCKCL1', 'Bot', 'LCK CL', 2021, 'Spring'),
    ('EchoRift', 'AcadF', 'Mid', 'NA Academy', 2018, 'Spring'),
    ('PrismFang', 'AcadG', 'Jungle', 'NA Academy', 2019, 'Spring'),
    ('AtlasChip', 'AcadH', 'Top', 'NA Academy', 2020, 'Spring'),
    ('CipherSun', 'AcadI', 'Support', 'NA Academy', 2021, 'Spring'),
    ('LunarJet', 'EM2', 'Mid', 'EU Masters', 2018, 'Spring'),
    ('LunarJet', 'EM2', 'Mid', 'EU Masters', 2019, 'Summer'),
    ('LunarJet', 'EM2', 'Mid', 'LEC', 2021, 'Spring'),
    ('SolarWind', 'LFL2', 'Jungle', 'LFL', 2019, 'Spring'),
    ('SolarWind', 'LFL2', 'Jungle', 'LEC', 2020, 'Summer'),
    ('TerraWisp', 'EM3', 'Top', 'EU Masters', 2019, 'Spring'),
    ('TerraWisp', 'EM3', 'Top', 'LEC', 2022, 'Spring'),
    ('AquaFlash', 'AcadJ', 'Support', 'NA Academy', 2018, 'Spring'),
    ('AquaFlash', 'AcadJ', 'Support', 'LCS', 2019, 'Summer'),
    ('Blazleon', 'LFL3', 'Bot', 'LFL', 2020, 'Spring'),
    ('Blazleon', 'LFL3', 'Bot', 'LEC', 2020, 'Summer'),
    ('GaleMint', 'PL2', 'Mid', 'Prime League', 2019, 'Spring'),
    ('GaleMint', 'PL2', 'Mid', 'LoL EMEA Championship', 2023, 'Spring'),
    ('VoltSkip', 'TCL1', 'Jungle', 'TCL', 2018, 'Spring'),
    ('VoltSkip', 'TCL1', 'Jungle', 'TCL', 2024, 'Summer'),
    ('NovaThorn', 'AcadK', 'Top', 'NA Academy', 2019, 'Spring'),
    ('NovaThorn', 'AcadK', 'Top', 'LCS', 2022, 'Summer'),
    ('SilkWarden', 'LDL2', 'Mid', 'LDL', 2018, 'Spring'),
    ('SilkWarden', 'LDL2', 'Mid', 'LPL', 2021, 'Spring'),
    ('DuskArrow', 'EM4', 'Support', 'EU Masters', 2020, 'Spring'),
    ('DuskArrow', 'EM4', 'Support', 'EU LCS', 2021, 'Summer')
]

FIXTURE_RULES = [
    ("LoL EMEA Championship", "contains", 1, "R?"),
    ("EU LCS", "contains", 1, "R?"),
    ("LEC", "exact", 1, "R?"),
    ("LCS", "exact", 1, "R?"),
    ("LPL", "exact", 1, "R?"),
    ("TCL", "exact", 1, "R?"),
    ("NA Academy", "contains", 2, "R?"),
    ("Academy League", "contains", 2, "R?"),
    ("LCK CL", "contains", 2, "R?"),
    ("__DEFAULT__", "default", 2, "Unknown"),
]


@pytest.fixture(scope="module")
def panel(spark):
    schema = T.StructType([*ROSTER_SCHEMA.fields, T.StructField("_line", T.LongType())])
    roster = spark.createDataFrame([(*r, None, i) for i, r in enumerate(ROSTER)], schema)
    rules = rules_frame(spark, FIXTURE_RULES)
    lon = build_longitudinal(roster, rules, 2025, debut_extra=("role",)).cache()
    return roster, lon


def test_counts(panel):
    roster, lon = panel
    assert roster.count() == 44
    assert lon.count() == 25
    by_league = cohort.rate_by_league(lon)
    assert by_league.count() == 8


def test_headline(panel):
    _, lon = panel
    h = cohort.cohort_headline(lon).collect()[0]
    assert h.n_tier2_debut == 24
    assert h.n_promoted_to_tier1 == 9
    assert h.n_never_t1 == 15
    assert h.promotion_rate_pct == 37.5
    assert h.median_seasons_to_tier1 == 3.0
    assert h.pct_promoted_within_2_seasons == 44.4


def test_histogram(panel):
    _, lon = panel
    hist = {r.seasons: r.n_players for r in cohort.promotion_histogram(lon).collect()}
    assert hist == {1: 3, 2: 0, 3: 4, 4: 1}


def test_by_league(panel):
    _, lon = panel
    rows = [(r.league, r.n, r.promoted) for r in cohort.top_leagues(cohort.rate_by_league(lon)).collect()]
    assert rows == [("NA Academy", 10, 2), ("EU Masters", 4, 3), ("LFL", 3, 2), ("LDL", 2, 1),
                    ("Prime League", 2, 1), ("Academy League", 1, 0), ("Challengers Korea", 1, 0),
                    ("LCK CL", 1, 0)]


def test_by_role(panel):
    _, lon = panel
    rows = [(r.role, r.n, r.promoted) for r in cohort.rate_by_role(lon).collect()]
    assert rows == [("Top", 5, 2), ("Jungle", 4, 1), ("Mid", 7, 3), ("Bot", 3, 1), ("Support", 5, 2)]


def test_promoted_order(panel):
    _, lon = panel
    rows = [(r.player, r.seasons_taken) for r in cohort.promoted_detail(lon).collect()]
    assert rows == [("Blazleon", 0), ("AquaFlash", 1), ("DuskArrow", 1), ("SolarWind", 1),
                    ("LunarJet", 3), ("NovaThorn", 3), ("SilkWarden", 3), ("TerraWisp", 3),
                    ("GaleMint", 4)]


def test_tier1_debut_and_censoring(panel):
    _, lon = panel
    t1 = [r.player for r in lon.where(F.col("debut_tier") == 1).collect()]
    assert t1 == ["VoltSkip"]
    assert lon.where(F.col("censored")).count() == 0
    labels = {r.player: (r.debut_lol_season, r.first_tier1_lol_season)
              for r in lon.where(F.col("player").isin("LunarJet", "VoltSkip")).collect()}
    assert labels == {"LunarJet": ("S8", "S11"), "VoltSkip": ("S8", "S8")}


def test_repartitioned_input_same_result(spark, panel):
    """Property: the result does not depend on input partitioning."""
    roster, lon = panel
    rules = rules_frame(spark, FIXTURE_RULES)
    shuffled = roster.repartition(7, "league")
    lon2 = build_longitudinal(shuffled, rules, 2025, tiebreak="_line")
    a = sorted(map(tuple, lon.drop("debut_role").collect()))
    b = sorted(map(tuple, lon2.collect()))
    assert a == b
