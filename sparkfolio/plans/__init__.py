"""Sparkfolio plans."""
