"""dielens: failure-pattern analytics for per-die test tables, on Spark DataFrames."""

from dielens.spec import ProbeSpec, RegisterSpec, resolve_spec

__all__ = ["ProbeSpec", "RegisterSpec", "resolve_spec"]
