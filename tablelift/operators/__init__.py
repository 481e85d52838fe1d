"""Export operators: ranges, periods, metrics and validation."""
