"""Table operators: SCD-2, point-in-time lookup, rollup, data quality,
run-date slicing and skew-safe joins."""
