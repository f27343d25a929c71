"""Operators for training corpora: filtering, deduplication, sharding, tokens and licences."""
