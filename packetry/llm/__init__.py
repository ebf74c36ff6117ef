"""Operators tagged llm. Nothing outside this subpackage imports it."""
