"""Operators of a training-data pipeline; nothing else in skyloom imports this."""
