"""Column expressions and small shared frame helpers."""
