"""Linking two person lists end to end."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators import linkage, metrics
from ..operators.skew import DEFAULT_POLICY, SkewPolicy
from ..session import cut_lineage
from . import modelling


@dataclass
class Linked:
    """Matches and their evaluation frames."""

    matches: DataFrame
    overall: DataFrame
    held_out: DataFrame | None = None
    weights: DataFrame | None = None
    coverage: DataFrame | None = None
    model: object | None = None


def link_by_rules(a: DataFrame, b: DataFrame, truth: DataFrame, normalize_names: bool = False) -> Linked:
    matches = linkage.match_by_rules(a, b, normalize_names)
    return Linked(matches, metrics.linkage_metrics(matches, truth, b))


def link_by_model(a: DataFrame, b: DataFrame, truth: DataFrame, policy: SkewPolicy = DEFAULT_POLICY) -> Linked:
    """Fit on candidate pairs, then take the best match of every record.

    `held_out` is measured on records not trained on; `overall` covers all records, training included.
    """
    fitted = modelling.train_lists(a, b, truth, policy=policy)
    score = linkage.LinearScore(dict(zip(fitted.model.names, fitted.model.weights, strict=True)), fitted.model.intercept)
    # Read more than once: the pairs are compared once.
    matches = cut_lineage(linkage.best_matches(a, b, score, policy=policy))
    return Linked(
        matches,
        metrics.end_to_end(matches, truth, b),
        fitted.metrics,
        fitted.weights,
        linkage.blocking_coverage(a, b, truth),
        fitted.model,
    )
