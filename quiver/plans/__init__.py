"""End-to-end plans (the full clustering run) and the registered query set."""
