"""Operators on texts for language models; nothing outside this subpackage imports it."""
