"""Scans: CSV feeds, object-store feeds, landing listings, and feeds derived from other tables."""
