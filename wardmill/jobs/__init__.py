"""Thin jobs: parameters, calls, writes."""
