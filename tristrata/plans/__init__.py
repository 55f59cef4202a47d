"""Contracts and whole-layer transformations built from the operators."""
