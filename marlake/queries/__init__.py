"""All named queries. Importing the package fills the registry."""

from marlake.queries import (  # noqa: F401
    layers,
    features,
    incremental,
    models,
    profiling,
    quality,
    replay,
    reports,
    series,
    storage,
)
from marlake.queries.registry import QUERIES, REFERENCE_SQL  # noqa: F401
