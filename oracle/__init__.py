"""Independent SQL oracle (DuckDB dialect) for the registered queries.

Written separately from the Spark code: the only shared piece is the bridge
(star schema -> raw inputs), which is data preparation, not an operator.
"""
