"""The scoring rules over streaming input."""
