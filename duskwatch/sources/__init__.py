"""Readers and writers: log text, rules, watchlists, geo ranges, event and alert tables."""
