"""Column-level building blocks (all JVM-side built-ins, no UDFs)."""

from tidemark.functions.columns import *  # noqa: F401,F403
