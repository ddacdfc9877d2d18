"""Column-level functions (all JVM-side built-ins, no Python UDFs)."""
