"""Matching of texts with skills and of two tables by what they share: extraction, pairs, text vectors, models, scores."""
