"""Column-level building blocks: canonical types, scalar expressions, comparisons."""
