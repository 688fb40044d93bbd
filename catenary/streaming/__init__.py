"""Feeds as streams."""
