"""keyline: keyed text lines (``<number>. <text>``) parsed, sorted, merged, numbered,
audited and generated with Spark DataFrames."""

__version__ = "0.1.0"
