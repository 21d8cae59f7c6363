"""Mapping rules and the job that runs them."""
