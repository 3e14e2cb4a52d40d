"""Multi-step jobs: rebuild, migrate, append, publish, inspect."""
