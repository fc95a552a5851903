"""Stack operators, grouped by what they do."""
