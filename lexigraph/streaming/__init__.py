"""Structured streaming."""
