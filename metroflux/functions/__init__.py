"""Column-level helpers. Every function returns a ``Column`` built from
built-in Spark SQL functions, so it stays inside whole-stage codegen."""
