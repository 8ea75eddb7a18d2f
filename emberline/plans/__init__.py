"""Whole jobs put together from the operators: feature build, training, evaluation."""
