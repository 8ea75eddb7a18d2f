"""The two heads: ignition classifier and log-area regressor, boosted and linear."""
