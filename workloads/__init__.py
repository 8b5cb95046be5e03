"""The registered queries: stand-in tables, Spark queries and their SQL twins."""

from importlib import import_module

FAMILIES = ("tidy", "summary", "ordered", "modelling", "analyses", "whole")


def load_all() -> None:
    """Import every family, which registers its queries."""
    for family in FAMILIES:
        import_module(f"workloads.{family}")
