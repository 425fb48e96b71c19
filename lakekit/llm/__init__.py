"""Operators for preparing large text corpora; each module documents its method, its null rules and its bounds."""
