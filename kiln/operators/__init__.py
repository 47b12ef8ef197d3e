"""Operators over DataFrames: profiling, relational verbs, baskets, models, sequences."""
