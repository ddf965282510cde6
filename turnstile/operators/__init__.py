"""DataFrame operators: clean, profile, impute, encode, sample, model."""
