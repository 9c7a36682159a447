"""Named queries over the benchmark tables, each with its SQL counterpart where one exists."""

from millrace.catalog.registry import ORACLES, QUERIES  # noqa: F401
from millrace.catalog import (  # noqa: F401  (importing registers the queries)
    q_cleaning,
    q_evaluation,
    q_images,
    q_joins,
    q_models,
    q_stages,
    q_stats,
    q_tables,
    q_transform,
)
