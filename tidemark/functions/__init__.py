"""Column-level building blocks: predicates and scalar functions (all built-in, JVM-side)."""
