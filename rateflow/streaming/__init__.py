"""Picking up what has landed since the last run."""
