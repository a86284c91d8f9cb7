"""The layer transforms: silver and staging clean rows, gold aggregates them."""
