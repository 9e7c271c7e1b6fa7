"""Bindings of the generic operators to the driver tables, plus their SQL oracles."""
