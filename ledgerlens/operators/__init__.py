"""Reusable relational steps: calendars, spine joins, key/value links, attribution."""
