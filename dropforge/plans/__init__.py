"""The named views. Importing this package registers them all."""

from dropforge.plans import complaints, deaths, facilities, geography, missions, profiles, signals, sources
from dropforge.plans.constants import Cutoffs
from dropforge.plans.registry import VIEWS, Views

__all__ = [
    "VIEWS", "Cutoffs", "Views", "complaints", "deaths", "facilities", "geography", "missions", "profiles",
    "signals", "sources",
]
