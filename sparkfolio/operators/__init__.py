"""Sparkfolio operators."""
