"""All named queries; importing this package registers them."""

from lodestep.catalog import demand_queries, gap_queries, similarity_queries, supply_queries, vector_queries  # noqa: F401
from lodestep.catalog.registry import ORACLES, QUERIES  # noqa: F401
