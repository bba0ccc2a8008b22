"""Operators of a training-data pipeline (mixing, dedup, tokenising, filtering, extraction, audits)."""
