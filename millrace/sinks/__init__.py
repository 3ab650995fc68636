"""Writing results: CSV folders and warehouse tables."""
