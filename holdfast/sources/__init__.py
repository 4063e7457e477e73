"""Scans and sinks: account tables, request texts, file listings, stored models."""
