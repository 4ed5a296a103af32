"""Feeds, reference data, gold annotations and the fetching client."""
