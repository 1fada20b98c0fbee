"""Operators: set-based building blocks of the warehouse loads."""
