"""Sparkfolio functions."""
