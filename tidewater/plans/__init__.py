"""The shipped jobs and the registered query catalog."""
