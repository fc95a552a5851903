"""Jobs on frames that arrive in batches."""
