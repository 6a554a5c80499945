"""What several test modules share."""


def one(spark, column):
    """Value of a column expression without input."""
    return spark.range(1).select(column.alias("c")).first()[0]
