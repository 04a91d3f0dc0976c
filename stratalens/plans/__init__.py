"""Whole tables and rankings, put together from the operators."""
