"""Event studies over panel data, written as PySpark DataFrame transformations.

A *panel* is a long table ``source, entity, indicator, time, value``; *events*
are ``entity, event_at``. Every operator takes and returns DataFrames.
"""
