"""Names shared by the query modules."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkframe.operators.grouping import attach, group_join, match_join, one_row, share_of
from larkframe.registry import query
from larkframe.tables import Tables

__all__ = ["Column", "DataFrame", "F", "Tables", "Window", "attach", "col", "group_join", "match_join", "one_row", "query", "r", "share_of"]

col = F.col


def r(c: Column, digits: int = 6) -> Column:
    """Rounded for comparison: the order of float addition varies with the partitioning."""
    return F.round(c, digits)
