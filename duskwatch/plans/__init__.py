"""Whole queries: alert assembly, the rule set, hunting, and the registered workload."""
