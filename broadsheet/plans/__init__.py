"""Compositions: the view of a run, its statistics, log analytics, and the registered queries."""
