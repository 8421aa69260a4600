"""Media and market analytics as plain DataFrame functions."""
