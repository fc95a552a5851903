"""Reading stacks and keeping named datasets."""
