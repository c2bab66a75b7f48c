"""Operators of a training-data pipeline.

Each module holds one operator; ``queries`` applies them to the given tables
and ``oracles`` has the SQL of those that SQL can express.  Nothing outside
this folder imports it."""
