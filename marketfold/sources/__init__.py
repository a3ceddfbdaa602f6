"""Inputs and outputs: tables by name or path, target schemas and overwriting writes."""
