"""Sentences that stand in report payloads."""

TREND_READING = "A positive slope means that newer cohorts change teams more, or leave earlier; a negative one the opposite."
STABILITY_NOTES = [
    "Team changes are num_teams - 1 over the whole career.",
    "They stand in for the moves of the first seasons, which career rows do not show.",
    "Season-level movement rows give the stricter measure.",
]
