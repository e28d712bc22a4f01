"""The plans applied to the benchmark tables: table mapping, registered queries and their SQL counterparts."""
