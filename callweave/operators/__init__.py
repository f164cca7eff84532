"""Operators: pure ``DataFrame -> DataFrame`` steps of the call workflow."""
