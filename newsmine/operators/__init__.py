"""Operators over DataFrames: filing, features, learning, evaluation, reports."""
