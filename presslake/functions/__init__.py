"""Column -> Column functions. None of them needs a shuffle."""
