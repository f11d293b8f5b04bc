"""Dashboard queries: parameterised lists, cards and rankings over the stored tables."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame

from tenderloom.operators import competition as cp
from tenderloom.operators import dashboard as db
from tenderloom.operators import relevance as rl
from tenderloom.operators.changes import changed_recently
from tenderloom.operators.verdicts import verdict_selection


class Dashboard(NamedTuple):
    tenders: DataFrame
    cards: DataFrame
    selection: DataFrame
    competition: DataFrame
    firms: DataFrame


def dashboard(
    tenders: DataFrame, competition: DataFrame, links: DataFrame, change_log: DataFrame, verdicts: DataFrame,
    preferences: DataFrame, today, last_visit: str | None = None,
    list_options: dict | None = None, competition_options: dict | None = None,
) -> Dashboard:
    merged = rl.lww_preference_merge(preferences)
    watched = rl.active_preferences(merged, "watch")
    hidden = rl.active_preferences(merged, "hidden")
    disliked = rl.active_preferences(merged, "dislikes")
    common = rl.common_words(tenders)
    model = rl.dislike_model(disliked)

    def reasons(rows: DataFrame) -> DataFrame:
        return rl.irrelevance_reason(rows, rl.fingerprint(rows, common), model, disliked, watched)

    marked = db.with_marks(
        tenders, verdicts=verdicts, watched=watched, hidden=hidden,
        changed=changed_recently(change_log, today), reasons=reasons(tenders),
    )
    awards = cp.with_amendments(competition, links).join(reasons(competition), "id", "left")
    shown = cp.competition_filter(awards, **(competition_options or {}))
    return Dashboard(
        db.tender_order(db.tender_list_filter(marked, **(list_options or {}))),
        db.stat_cards(marked, today, last_visit),
        verdict_selection(tenders, verdicts, watched, hidden),
        cp.competition_order(shown),
        cp.top_firms(shown),
    )
