"""Column functions: no shuffle, no Python in the tasks."""
