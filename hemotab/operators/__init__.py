"""Operators: crosstab (rollup x rollup), per-key collapse, test-result
flags, report periods and size-checked joins."""
