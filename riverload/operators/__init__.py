"""Operators: functions from DataFrame to DataFrame, without global state."""
