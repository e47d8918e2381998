"""Layer chains and the registered query set."""
