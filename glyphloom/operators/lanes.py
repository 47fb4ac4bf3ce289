"""Review lanes of sources, from their assessment: identity before context before semantics before noise.

A lane follows from the rules of a source's signals and from the operations that its questions are bound to; all
of it is expressions over what ``classify.classified`` gives, so no source is read twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphloom.operators.classify import classified

#: Lanes by priority, and the reasons that go with them.
PRIORITY = {"identity": 3, "context": 2, "semantics": 1, "noise": 0}
REASONS = {
    "identity": "explicit_identity_or_lookup_evidence",
    "context": "insufficient_identity_evidence",
    "semantics": "meaning_is_not_identification",
    "noise": "no_eligible_evidence",
}
UNBOUND = "unbound_evidence_requires_context"
#: What tells which character is meant: by itself, or as the operation of a question.
_TELLING_RULES = ("label", "escape", "number", "name", "command", "shape", "lookup_failure", "image_request", "naming", "named", "names", "depiction", "typing")
_TELLING_OPERATIONS = ("identify", "name", "type", "keyboard", "origin", "appearance")


def _any_of(values: Column, wanted: tuple[str, ...]) -> Column:
    return F.arrays_overlap(values, F.array(*[F.lit(w) for w in wanted]))


def with_lane(assessed: DataFrame) -> DataFrame:
    """Assessments (signals, bindings, candidate, score) with lane, priority, reasons and discovery_score."""
    rules, operations = F.transform("signals", lambda s: s["rule"]), F.transform("bindings", lambda b: b["operation"])
    identity = _any_of(rules, _TELLING_RULES) | _any_of(operations, _TELLING_OPERATIONS)
    semantics = F.array_contains(operations, "meaning")
    sought = F.array_contains(operations, "find")
    unbound = F.col("candidate") & ~identity & ~semantics & ~sought
    lane = F.when(identity, "identity").when(sought | unbound, "context").when(semantics, "semantics").otherwise("noise")
    priority = F.create_map(*[x for k, v in PRIORITY.items() for x in (F.lit(k), F.lit(v))])
    reason = F.create_map(*[x for k, v in REASONS.items() for x in (F.lit(k), F.lit(v))])
    return assessed.withColumns({"lane": lane, "discovery_score": F.col("score")}).withColumns(
        {"priority": priority[F.col("lane")], "reasons": F.array_sort(F.filter(F.array(reason[F.col("lane")], F.when(unbound, F.lit(UNBOUND))), lambda r: r.isNotNull()))}
    )


def source_lanes(rows: DataFrame, role: str = "role") -> DataFrame:
    """``rows`` (Title, Body, Text, a role) with lane, priority, reasons and discovery_score."""
    return with_lane(classified(rows, role)).select(*rows.columns, "lane", "priority", "reasons", "discovery_score")
