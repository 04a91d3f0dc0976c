"""Ordered scales, the groups that report on them, and the known instruments."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Scale:
    """An ordered scale, worst level first; level ``i`` has ordinal ``i + 1``."""

    name: str
    levels: tuple[str, ...]

    @property
    def size(self) -> int:
        return len(self.levels)


@dataclass(frozen=True)
class Collapse:
    """Maps each level of ``source`` to the index of a level of ``target``."""

    source: Scale
    target: Scale
    mapping: tuple[int, ...]

    def __post_init__(self):
        if len(self.mapping) != self.source.size:
            raise ValueError("mapping needs one entry per source level")
        if set(self.mapping) != set(range(self.target.size)):
            raise ValueError("mapping must reach every target level")


@dataclass(frozen=True)
class Group:
    """A reporting group: a grade, or a grade and a language."""

    grade: str
    lang: str | None = None

    @property
    def label(self) -> str:
        return f"{self.grade} {self.lang}" if self.lang else self.grade

    @property
    def key(self) -> str:
        return self.label.replace(" ", "_")


@dataclass(frozen=True)
class Instrument:
    """Which groups report on which scale, and how gaps are read.

    ``null_as_zero``  a missing level counts as zero (otherwise it stays missing)
    ``zero_sd``       "keep" leaves mean and sd of a one-level group, "null_all" drops them
    ``export_levels`` order of the level blocks in the wide export, the scale's own if empty
    """

    name: str
    scale: Scale
    groups: tuple[Group, ...]
    null_as_zero: bool = False
    zero_sd: str = "keep"
    export_levels: tuple[str, ...] = ()

    @property
    def grades(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys(g.grade for g in self.groups))

    @property
    def language_chains(self) -> tuple[tuple[str, tuple[str, ...]], ...]:
        """Per grade its group labels, in the order in which they stand for the grade's learners."""
        return tuple((x, tuple(g.label for g in self.groups if g.grade == x)) for x in self.grades)


# Level names, grades and languages as they stand in the exports.
READING_5 = Scale("reading_5", (
    "Lower Emergent",
    "Higher Emergent",
    "Developing",
    "Transitioning",
    "Grade Level",
))
MATH_5 = Scale("math_5", (
    "Emerging Not Proficient",
    "Emerging - Low Proficient",
    "Developing - Nearly Proficient",
    "Transitioning - Proficient",
    "At Grade Level - Highly Proficient",
))
READING_3 = Scale("reading_3", ("Frustration", "Instructional", "Independent"))
READING_7 = Scale("reading_7", (
    "3LD Frustration",
    "3LD Instructional",
    "3LD Independent",
    "2LD Frustration",
    "2LD Instructional",
    "2LD Independent",
    "Grade Ready",
))
SEVEN_TO_THREE = Collapse(READING_7, READING_3, (0, 0, 1, 0, 1, 2, 2))

EARLY_READING_GROUPS = (
    Group("G1"),
    Group("G2", "MT"),
    Group("G2", "Fil"),
    Group("G3", "MT"),
    Group("G3", "Fil"),
    Group("G3", "Eng"),
)
LANGUAGES = ("Fil", "Eng")
KEY_STAGE_GRADES = {
    "ks1": ("G1", "G2", "G3"),
    "ks2": ("G4", "G5", "G6"),
    "ks3": ("G7", "G8", "G9", "G10"),
}
METADATA = ("School Name", "Region", "Division", "District")

# The order of the level blocks in the export of early reading.
EARLY_READING_EXPORT = ("Developing", "Transitioning", "Higher Emergent", "Lower Emergent", "Grade Level")

EARLY_READING = Instrument("early_reading", READING_5, EARLY_READING_GROUPS, export_levels=EARLY_READING_EXPORT)


def upper_reading(ks: str, scale: Scale = READING_3) -> Instrument:
    """Upper-grade reading of one key stage, on the 3- or the 7-level scale."""
    groups = tuple(Group(g, lang) for g in KEY_STAGE_GRADES[ks] for lang in LANGUAGES)
    return Instrument(f"upper_reading_{ks}", scale, groups, null_as_zero=True, zero_sd="null_all")


def mathematics(ks: str) -> Instrument:
    """Mathematics of one key stage; one group per grade."""
    return Instrument(f"mathematics_{ks}", MATH_5, tuple(Group(g) for g in KEY_STAGE_GRADES[ks]))
