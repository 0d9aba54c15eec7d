"""The status, type, theme and category lists the views filter on, and their cut-off dates."""

from __future__ import annotations

from dataclasses import dataclass

DONE_STATUSES = ("Clôturé", "Maintenu")
CLOSED_STATUSES = ("Clôturé", "Abandonné")
SOCIAL_SECTOR = "Médico-social"
CARE_SECTORS = ("Médico-social", "Sanitaire")
ELDERLY_TARGET = "Etablissements et Services pour Personnes Agées"
THEMES = (
    "MS634D13", "MS634N1", "MS634E1", "MS634D12", "MS634R1", "MS634D11", "MS634D15", "MS634C10",
)
EXCLUDED_TYPES = (
    "Audit", "Audit franco-wallon", "Evaluation", "Visites de conformité", "Enquête administrative",
)
FACILITY_CATEGORIES = (
    448, 402, 396, 395, 370, 437, 255, 246, 198, 249, 238, 390, 188, 377,
    192, 183, 186, 195, 194, 196, 379, 445, 221, 190, 189, 182,
)
NURSING_HOME_CATEGORY = "500"
CURRENT_STATE = "ACTUEL"


@dataclass(frozen=True)
class Cutoffs:
    """Text dates the views compare with. All comparisons are on text, bounds included where ``between``."""

    visits_from: str = "2022-01-01"
    visits_to: str = "2024-12-31"
    planned_after: str = "2024-12-31 00:00:00"
    planned_iso_after: str = "2024-09-30"
    complaints_before: str = "2024-12-31"
    years_back: int = 3
