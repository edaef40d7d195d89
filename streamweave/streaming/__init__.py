"""Structured Streaming forms of the operators.

``forms``      built-in stateful operators (window aggregates with
               watermarks, dedup, sessions) and the streaming pipelines;
``processors`` ``transformWithStateInPandas`` processors for the
               per-row keyed state of the reference (counts, alerts, folds,
               timers, TTL, map state);
``runner``     checkpointed, restartable queries with idempotent sinks;
``late``       the late-row router (side output of too-late rows).
"""
