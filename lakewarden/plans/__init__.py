"""Compositions: scenario runs, stored queries, and the registered workload."""
