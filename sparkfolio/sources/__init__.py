"""Sparkfolio sources."""
