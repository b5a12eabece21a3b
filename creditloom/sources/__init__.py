"""Reading and writing tables, and the schemas of the loan tables."""

from .schemas import SCHEMAS
from .tables import head_n, profile, read_table, score_table, write_scores

__all__ = ["SCHEMAS", "head_n", "profile", "read_table", "score_table", "write_scores"]
