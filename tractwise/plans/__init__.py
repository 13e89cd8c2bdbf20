"""The analysis, composed from the operators."""
