"""Expression builders.

Each function takes and returns Spark SQL expression text, so tags are plain data: they
can be defined without a session, read as SQL, and cost one parse per output column.
All of it stays in native, code-generated expressions.
"""
