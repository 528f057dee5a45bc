"""Reusable DataFrame operators the jobs are composed of."""
