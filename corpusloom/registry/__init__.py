from corpusloom.registry import catalog_queries, search_queries, storage_queries, text_queries, tracking_queries
from corpusloom.registry.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
