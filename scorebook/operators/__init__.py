"""Operators: featurization, joins, exact split, exact-median imputation, model, metrics, registry, ranks."""
