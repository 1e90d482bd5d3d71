"""Sparkfolio streaming."""
