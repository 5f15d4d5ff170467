"""The report set, built from the operators."""
