"""Query catalogue: named DataFrame queries over the driver's tables, each
with the DuckDB SQL that states the same result (the correctness oracle)."""

from .catalog import QUERIES, ORACLES  # noqa: F401
