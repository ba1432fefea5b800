"""Operators of a training-data pipeline (tokens, PII, sharding, dedup, decontamination, quality, licences, mixing)."""
