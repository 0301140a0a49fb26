"""The queries of the concept operators, and the SQL that checks them."""

from __future__ import annotations

from .plans import q_candidates, q_concepts, q_definition, q_models, q_text, q_validation, q_vectors

MODULES = [q_text, q_concepts, q_candidates, q_definition, q_validation, q_vectors, q_models]


def queries() -> dict:
    return {k: f for m in MODULES for k, f in m.Q.queries.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in MODULES for k, s in m.Q.sql.items()}
