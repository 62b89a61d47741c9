"""Reporting models, their checks, and the runs that build them."""
