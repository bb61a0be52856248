"""Column functions: sequence numbers, times and payloads."""
