"""Lake, reference tables, history files and warehouse tables."""
