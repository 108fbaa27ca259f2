"""The structured query and how it becomes a DataFrame."""
