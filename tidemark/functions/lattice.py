"""The type lattice INT64 < FLOAT64 < STRING."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schema import FLOAT64, INT64, STRING


def type_rank(data_type: Column) -> Column:
    return F.when(data_type == STRING, 2).when(data_type == FLOAT64, 1).otherwise(0)


def rank_type(rank: Column) -> Column:
    return F.when(rank == 2, STRING).when(rank == 1, FLOAT64).otherwise(INT64)


def widest(data_type: Column) -> Column:
    """Aggregate: widest type of a group."""
    return rank_type(F.max(type_rank(data_type)))


def wider(left: Column, right: Column) -> Column:
    """Widest of two types; a missing side does not count."""
    return rank_type(F.greatest(type_rank(left), type_rank(right)))


def widest_of(data_types) -> str:
    """Widest type of a Python collection."""
    found = set(data_types)
    return STRING if STRING in found else FLOAT64 if FLOAT64 in found else INT64
