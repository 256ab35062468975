"""Operators: DataFrame -> DataFrame steps (clean, quantiles, keys, star, checks,
profile, impute, mart)."""
