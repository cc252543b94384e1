"""Operators: cleaning, features, segments, lifetime value, recommendations, reports."""
