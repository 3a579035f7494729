"""Report plans composed from the operators. Each takes DataFrames and an as-of date."""
