"""End-to-end chains that combine the operators into business tables."""
