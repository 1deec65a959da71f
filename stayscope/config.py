"""Vocabulary of a study: outcomes, prediction horizons, cohorts, feature sets."""

from __future__ import annotations

from dataclasses import dataclass

RETROSPECTIVE = 0


@dataclass(frozen=True)
class Outcome:
    """What counts as a positive, relative to the entity's latest episode.

    ``within_days is None`` means the terminal date falls inside the stay (both ends
    included). Otherwise it falls after the stay, with at most ``within_days`` and more
    than ``beyond_days`` full days in between.
    """

    name: str
    label: str
    within_days: int | None = None
    beyond_days: int | None = None

    @property
    def in_stay(self) -> bool:
        return self.within_days is None


@dataclass(frozen=True)
class Cohort:
    """One outcome at one horizon; ``hours == 0`` is the retrospective model."""

    outcome: Outcome
    hours: int

    @property
    def horizon(self) -> str:
        return "retro" if self.hours == RETROSPECTIVE else f"{self.hours}h"

    @property
    def name(self) -> str:
        return f"{self.outcome.name}_{self.horizon}"

    @property
    def label(self) -> str:
        suffix = "Retro" if self.hours == RETROSPECTIVE else f"{self.hours}Hr"
        return f"{self.outcome.label}{suffix}"


@dataclass(frozen=True)
class FeatureSet:
    """A named selection of feature families."""

    name: str
    families: tuple[str, ...]


# Outcome windows, horizons and output labels.
IN_STAY = Outcome("in_stay", "inICU")
WITHIN_30_DAYS = Outcome("in_30d", "in30d", within_days=30)
WITHIN_1_YEAR = Outcome("in_1y", "in1Yr", within_days=365, beyond_days=30)
OUTCOMES = (IN_STAY, WITHIN_30_DAYS, WITHIN_1_YEAR)
HORIZON_HOURS = (12, 24, 48, RETROSPECTIVE)

# Feature families and the sets built from them.
STATIC_FAMILIES = ("base", "scores", "flags")
EVENT_FAMILIES = ("diag", "med", "lab")
NOTE_FAMILY = "notes"
FEATURE_SETS = (
    FeatureSet("baseline", ("base", "scores")),
    FeatureSet("baseline_comorbidities", ("base", "scores", "flags")),
    FeatureSet("baseline_comorbidities_dynamic", ("base", "scores", "flags", "diag", "med", "lab")),
    FeatureSet("baseline_comorbidities_notes", ("base", "scores", "flags", "notes")),
    FeatureSet(
        "all_features", ("base", "scores", "flags", "diag", "med", "lab", "notes")
    ),
)


def cohort_specs(
    outcomes: tuple[Outcome, ...] = OUTCOMES, hours: tuple[int, ...] = HORIZON_HOURS
) -> list[Cohort]:
    """Every outcome at every horizon."""
    return [Cohort(o, h) for o in outcomes for h in hours]


def export_name(cohort: Cohort, feature_set: FeatureSet) -> str:
    """Directory name of one exported matrix or result."""
    return f"svlight_{cohort.label}_{feature_set.name}"


def active_feature_sets(
    flags: bool = True, events: bool = True, notes: bool = True
) -> list[FeatureSet]:
    """Feature sets that exist when whole families are switched off."""
    wanted = {
        "baseline": True,
        "baseline_comorbidities": flags,
        "baseline_comorbidities_dynamic": events,
        "baseline_comorbidities_notes": notes,
        "all_features": events and notes,
    }
    return [s for s in FEATURE_SETS if wanted[s.name]]
