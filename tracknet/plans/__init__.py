"""Session set-up, lineage control for loops, SQL access and the load pipeline."""
