"""Price-history analytics as DataFrame operators."""
