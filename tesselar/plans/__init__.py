"""Multi-step pipelines and the registered query set."""
