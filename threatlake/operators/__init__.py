"""Dataflow operators: table sinks, guardrails, chunk merging, metrics."""
