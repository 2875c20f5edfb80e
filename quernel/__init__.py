"""Analytics jobs on tables and streams, written as plain DataFrame functions."""
