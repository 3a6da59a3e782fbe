"""Operators for preparing text and event data for language models; nothing outside imports them."""
