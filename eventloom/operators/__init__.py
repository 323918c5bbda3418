"""Reusable DataFrame operators the marts are composed of."""
