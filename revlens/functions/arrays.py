"""Array expressions for topic vectors and distances."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

from revlens.fixed_values import TOPIC_COUNT


def first_argmax(values: Column) -> Column:
    """Zero-based position of the first maximum; 0 for NULL."""
    position = F.array_position(values, F.array_max(values)) - 1
    return F.coalesce(position, F.lit(0)).cast("int")


def even_probabilities() -> Column:
    return F.array_repeat(F.lit(1.0 / TOPIC_COUNT), TOPIC_COUNT)


def topic_probabilities(distribution: Column) -> Column:
    """A topic vector as an array; even shares where there is none."""
    return F.coalesce(vector_to_array(distribution), even_probabilities())


def dot(left: Column, right: Column) -> Column:
    products = F.zip_with(left, right, lambda a, b: a * b)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def squared_norm(values: Column) -> Column:
    return dot(values, values)


def squared_distance(left: Column, right: Column) -> Column:
    squares = F.zip_with(left, right, lambda a, b: (a - b) * (a - b))
    return F.aggregate(squares, F.lit(0.0), lambda total, x: total + x)
