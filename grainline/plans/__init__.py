"""Parameterised multi-step pipelines."""
