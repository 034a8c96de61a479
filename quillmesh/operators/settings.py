"""Checks and transitions of settings, before any plan is made."""

from __future__ import annotations

from collections.abc import Collection, Iterable
from dataclasses import replace

from quillmesh.operators.ranks import Selection

TEXT_COLUMNS = ("title", "publisher", "issns", "field", "domain", "register_area", "register_field")


def checked_years(years: Iterable) -> list[int]:
    """Score years in order; none, a repeated one or one that is no whole number is an error."""
    given = list(years)
    odd = [y for y in given if type(y) is not int]
    if not given or odd:
        raise ValueError(f"score years must be whole numbers: {odd or 'none given'}")
    if len(set(given)) != len(given):
        raise ValueError("a score year is given twice")
    return sorted(given)


def sorted_by(s: Selection, column: str) -> Selection:
    """The selection sorted by a column: texts upwards and numbers downwards at first, the other way round when chosen again."""
    down = not s.descending if column == s.sort_key else column not in TEXT_COLUMNS
    return replace(s, sort_key=column, descending=down, page=0)


def with_metric(s: Selection, metric: str, can_average: bool) -> Selection:
    """Another metric under the settings that it shares; averages stay only where they can be had, the history rule where there is one."""
    ratio = metric.startswith("ratio")
    years = 0 if ratio else s.min_years if s.has_history_rule else Selection.min_years
    return replace(s, metric=metric, min_years=years, average=s.average and can_average, sort_key="score", descending=True, page=0)


def applied(s: Selection, preset: Selection, can_average: bool) -> Selection:
    """A preset's rules with what is searched and filtered kept."""
    return replace(preset, query=s.query, fields=s.fields, open_only=s.open_only, average=preset.average and can_average)


def shown_columns(s: Selection, optional: Collection[str] = ()) -> list[str]:
    """Columns of a table under a selection, in order; optional ones only if asked for."""
    percent = {"field": ["field_pct"], "total": ["pool_pct"], "both": ["field_pct", "pool_pct"]}.get(s.percentile, [])
    extra = ["issns", "publisher", "domain", "register_area", "register_field", "coverage", "without_references"]
    history = ["active_years"] if s.has_history_rule else []
    return ["journal_id", "title", "field", "score", *percent, f"works_{s.treatment}", *history, *[c for c in extra if c in optional]]
