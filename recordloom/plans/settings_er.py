"""The standard resolution settings for company records."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from recordloom.operators.blocking import BlockingRule, block_on
from recordloom.operators.model import Comparison, exact_match, jaro_winkler_at
from recordloom.settings import CLUSTER_THRESHOLD, DETERMINISTIC_RECALL, MAX_RANDOM_PAIRS, PREDICT_THRESHOLD

NAME, CITY, STREET, ENTITY = "company_name_normalized", "city", "address_1", "entity_id"


@dataclass(frozen=True)
class ResolutionSettings:
    # Blocking, deterministic and training rules, compared columns.
    blocking: Sequence[BlockingRule] = (
        block_on(ENTITY),
        block_on(NAME),
        block_on((NAME, 4), CITY),
        block_on((NAME, 4), (STREET, 5)),
        block_on((NAME, 6)),
    )
    deterministic: Sequence[BlockingRule] = (
        block_on(ENTITY),
        block_on(NAME, CITY),
        block_on(NAME, (STREET, 5)),
    )
    training: Sequence[BlockingRule] = (block_on(NAME), block_on(ENTITY), block_on((NAME, 4)))
    comparisons: Sequence[Comparison] = field(
        default_factory=lambda: (
            exact_match(ENTITY, term_frequency=True),
            jaro_winkler_at(NAME, term_frequency=True),
            jaro_winkler_at(STREET, term_frequency=True),
            jaro_winkler_at(CITY),
        )
    )
    link_type: str = "link_and_dedupe"
    predict_threshold: float = PREDICT_THRESHOLD
    cluster_threshold: float = CLUSTER_THRESHOLD
    recall: float = DETERMINISTIC_RECALL
    max_random_pairs: int = MAX_RANDOM_PAIRS

    def as_dict(self) -> dict:
        return {
            "blocking": [r.name for r in self.blocking],
            "deterministic": [r.name for r in self.deterministic],
            "training": [r.name for r in self.training],
            "comparisons": [[c.column, list(c.thresholds), c.term_frequency] for c in self.comparisons],
            "link_type": self.link_type,
            "predict_threshold": self.predict_threshold,
            "cluster_threshold": self.cluster_threshold,
        }
