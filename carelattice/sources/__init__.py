"""Readers and writers: text exports and the warehouse tables."""
